"""Data-quality gates. Each check returns a findings DataFrame; nothing is raised until asked.

Findings share one schema, so checks on many tables are a union:
``(status, check, target, column_name, n_bad, n_total, rate, detail)``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake import config as cfg

PASS, WARN, FAIL = "PASS", "WARN", "FAIL"
FINDING = (
    "status string, check string, target string, column_name string, "
    "n_bad bigint, n_total bigint, rate double, detail string"
)


class GateError(RuntimeError):
    """A gate found something that must stop the pipeline."""


def union_findings(findings: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, findings)


def _finding(
    status: Column | str,
    check: str,
    target: str,
    n_bad: Column | None = None,
    n_total: Column | None = None,
    rate: Column | None = None,
    detail: Column | str = "",
    column_name: Column | None = None,
) -> list[Column]:
    def lit(value, kind: str) -> Column:
        if value is None or isinstance(value, str):
            value = F.lit(value)
        return value.cast(kind)

    return [
        lit(status, "string").alias("status"),
        F.lit(check).alias("check"),
        F.lit(target).alias("target"),
        lit(column_name, "string").alias("column_name"),
        lit(n_bad, "bigint").alias("n_bad"),
        lit(n_total, "bigint").alias("n_total"),
        lit(rate, "double").alias("rate"),
        lit(detail, "string").alias("detail"),
    ]


def note(spark: SparkSession, status: str, check: str, target: str, detail: str) -> DataFrame:
    """A finding that needs no data, such as a missing table."""
    return spark.createDataFrame([(status, check, target, None, None, None, None, detail)], FINDING)


# -- checks ------------------------------------------------------------------------


def row_count(df: DataFrame, target: str, expected: int | None) -> DataFrame:
    counted = df.agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    if expected is None:
        status: Column = F.lit(PASS)
        detail: Column = F.concat(n.cast("string"), F.lit(" rows, no reference"))
        off = F.lit(0)
    else:
        off = F.abs(n - F.lit(expected))
        status = F.when(off == 0, PASS).otherwise(FAIL)
        detail = F.concat(n.cast("string"), F.lit(f" rows, reference {expected}"))
    return counted.select(*_finding(status, "row-count", target, off, n, None, detail))


def row_counts(
    spark: SparkSession, tables: Mapping[str, DataFrame], expected: Mapping[str, int | None]
) -> DataFrame:
    """Counts against the registry; a registered table that is not there is a warning."""
    return union_findings(
        [
            row_count(tables[name], name, reference)
            if name in tables
            else note(spark, WARN, "row-count", name, "not profiled")
            for name, reference in expected.items()
        ]
    )


def key_uniqueness(df: DataFrame, target: str, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key. NULL keys form a group of their own."""
    if not keys:
        return note(df.sparkSession, PASS, "key-uniqueness", target, "no natural key claimed")
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    counted = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_distinct")
    )
    duplicates = F.col("n_rows") - F.col("n_distinct")
    return counted.select(
        *_finding(
            F.when(duplicates == 0, PASS).otherwise(FAIL),
            "key-uniqueness",
            f"{target}({', '.join(keys)})",
            duplicates,
            F.col("n_rows"),
            None,
            F.concat(duplicates.cast("string"), F.lit(" duplicate rows")),
        )
    )


def referential(
    child: DataFrame, parent: DataFrame, edge: cfg.Reference, max_orphan_rate: float = cfg.MAX_ORPHAN_RATE
) -> DataFrame:
    """Child values without a parent: any fails a full parent, a large share a partial one.

    Both sides are reduced to distinct ids before they meet, so the join sees each id once
    however skewed the child is, and reuses the partitioning of the two aggregates.
    """
    ids = child.groupBy(F.col(edge.child_column).alias("_id")).agg(F.count(F.lit(1)).alias("_rows"))
    known = parent.select(F.col(edge.parent_column).alias("_id")).distinct().withColumn("_known", F.lit(True))
    orphan = F.col("_known").isNull()
    counted = ids.join(known, "_id", "left").agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_ids"),
        F.coalesce(F.sum(F.when(orphan, F.col("_rows"))), F.lit(0)).alias("orphan_rows"),
        F.count_if(orphan).alias("orphan_ids"),
    )
    rate_ids = F.coalesce(F.try_divide(F.col("orphan_ids"), F.col("n_ids")), F.lit(0.0))
    rate_rows = F.coalesce(F.try_divide(F.col("orphan_rows"), F.col("n_rows")), F.lit(0.0))
    if edge.partial_parent:
        bad = F.when(rate_ids > max_orphan_rate, FAIL).otherwise(WARN)
    else:
        bad = F.lit(FAIL)
    detail = F.concat(
        F.col("orphan_rows").cast("string"), F.lit(" of "), F.col("n_rows").cast("string"),
        F.lit(" rows, row rate "), F.round(rate_rows, 4).cast("string"),
    )
    return counted.select(
        *_finding(
            F.when(F.col("orphan_rows") == 0, PASS).otherwise(bad),
            "referential",
            edge.target,
            F.col("orphan_ids"),
            F.col("n_ids"),
            F.round(rate_ids, 4),
            detail,
        ),
        F.col("orphan_rows").alias("n_orphan_rows"),
        F.col("n_rows").alias("n_child_rows"),
        F.round(rate_rows, 4).alias("orphan_rate_rows"),
    )


def panel_index(df: DataFrame, target: str, month: str, max_allowed: int = 0) -> DataFrame:
    """Months must not exceed ``max_allowed``: the cohorts count backwards from it."""
    counted = df.agg(
        F.min(month).alias("lo"),
        F.max(month).alias("hi"),
        F.count_if(F.col(month) > max_allowed).alias("above"),
        F.count(F.lit(1)).alias("n"),
    )
    span = F.concat(F.lit("range ["), F.col("lo").cast("string"), F.lit(", "), F.col("hi").cast("string"), F.lit("]"))
    return counted.select(
        *_finding(
            F.when(F.col("above") > 0, FAIL).otherwise(PASS),
            "panel-index",
            f"{target}.{month}",
            F.col("above"),
            F.col("n"),
            None,
            span,
        )
    )


NUMERIC = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType, T.ShortType, T.DecimalType)


def sentinel_scan(
    df: DataFrame,
    target: str,
    columns: Sequence[str] | None = None,
    sentinel: float = cfg.DAYS_SENTINEL,
    prefix: str = "DAYS_",
) -> DataFrame | None:
    """One WARN row per column that holds the sentinel, or one PASS row. None if nothing to scan.

    All columns are counted in a single aggregate; the result is as long as the column list.
    """
    if columns is None:
        columns = [
            f.name for f in df.schema.fields if f.name.startswith(prefix) and isinstance(f.dataType, NUMERIC)
        ]
    if not columns:
        return None
    counted = df.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.array(
            *[
                F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(c) == F.lit(sentinel)).alias("n_bad"))
                for c in columns
            ]
        ).alias("hits"),
    )
    dirty = F.filter("hits", lambda h: h["n_bad"] > 0)
    clean = F.array(F.struct(F.lit(None).cast("string").alias("column_name"), F.lit(0).cast("bigint").alias("n_bad")))
    rows = counted.select("n_total", F.inline(F.when(F.size(dirty) > 0, dirty).otherwise(clean)))
    return rows.select(
        *_finding(
            F.when(F.col("n_bad") > 0, WARN).otherwise(PASS),
            "days-sentinel",
            target,
            F.col("n_bad"),
            F.col("n_total"),
            F.round(F.try_divide(F.col("n_bad"), F.col("n_total")), 6),
            F.concat(F.lit(f"value {sentinel}: "), F.col("n_bad").cast("string"), F.lit(" rows")),
            F.col("column_name"),
        )
    )


def rows_preserved(clean: DataFrame, sources: Sequence[DataFrame], target: str) -> DataFrame:
    """Cleaning must not change row counts; a pooled table must have the rows of its parts."""
    got = clean.agg(F.count(F.lit(1)).alias("n"), F.lit(0).cast("bigint").alias("want"))
    want = [s.agg(F.lit(0).cast("bigint").alias("n"), F.count(F.lit(1)).alias("want")) for s in sources]
    totals = reduce(DataFrame.unionByName, [got, *want]).agg(F.sum("n").alias("n"), F.sum("want").alias("want"))
    off = F.abs(F.col("n") - F.col("want"))
    return totals.select(
        *_finding(
            F.when(off == 0, PASS).otherwise(FAIL),
            "rows-preserved",
            target,
            off,
            F.col("n"),
            None,
            F.concat(F.col("n").cast("string"), F.lit(" rows, sources have "), F.col("want").cast("string")),
        )
    )


def ingestion_gate(audit: DataFrame) -> DataFrame:
    """Row mismatch or unparsable rows of an ingestion audit, one finding per ingested table."""
    bad_rows = F.coalesce(F.col("n_corrupt"), F.lit(0))
    mismatch = F.coalesce(~F.col("row_count_ok"), F.lit(False))
    status = F.when(mismatch | (bad_rows > 0), FAIL).otherwise(PASS)
    detail = F.concat(
        F.col("n_rows").cast("string"), F.lit(" rows, expected "),
        F.coalesce(F.col("expected_rows").cast("string"), F.lit("any")),
        F.lit(", unparsable "), bad_rows.cast("string"),
    )
    return audit.filter(F.col("status") != "skipped").select(
        status.alias("status"),
        F.lit("ingestion").alias("check"),
        F.col("table").alias("target"),
        F.lit(None).cast("string").alias("column_name"),
        bad_rows.cast("bigint").alias("n_bad"),
        F.col("n_rows").alias("n_total"),
        F.lit(None).cast("double").alias("rate"),
        detail.alias("detail"),
    )


# -- report -------------------------------------------------------------------------


def status_counts(findings: DataFrame) -> DataFrame:
    return findings.groupBy("check").agg(
        *[F.count_if(F.col("status") == s).alias(f"n_{s.lower()}") for s in (PASS, WARN, FAIL)]
    )


def raise_on_fail(findings: DataFrame, strict: bool = False) -> None:
    """Raise for FAIL findings, and for WARN too when strict. Findings are few by construction."""
    blocking = [FAIL, WARN] if strict else [FAIL]
    rows = findings.filter(F.col("status").isin(blocking)).collect()
    if rows:
        lines = "\n".join("  - " + " ".join(str(v) for v in r if v is not None) for r in rows)
        raise GateError(f"{len(rows)} blocking findings:\n{lines}")
