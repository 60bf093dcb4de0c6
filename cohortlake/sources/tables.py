"""Table sinks and catalog access: overwrite, skip, append, clustered layout, comments."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.functions.space_filling import interleaved

OVERWRITE = "overwrite"
SKIP_EXISTING = "skip_existing"
MODES = (OVERWRITE, SKIP_EXISTING)

AUDIT = (
    "table string, target string, status string, n_rows bigint, n_corrupt bigint, expected_rows bigint, "
    "row_count_ok boolean, schema_fingerprint string, n_columns int, duration_sec double"
)


def read_table(spark: SparkSession, name: str, drop: Sequence[str] = ()) -> DataFrame:
    return spark.table(name).drop(*drop)


def overwrite_table(df: DataFrame, name: str, comment: str | None = None) -> DataFrame:
    """Replace data and schema of a managed table."""
    spark = df.sparkSession
    df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(name)
    if comment:
        comment_on(spark, name, comment)
    return spark.table(name)


def comment_on(spark: SparkSession, name: str, comment: str) -> None:
    quoted = comment.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"COMMENT ON TABLE {name} IS '{quoted}'")


def write_table(df: DataFrame, name: str, mode: str = OVERWRITE, comment: str | None = None) -> dict:
    """Write unless told to keep an existing table; returns the audit values."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    spark, started = df.sparkSession, time.monotonic()
    if mode == SKIP_EXISTING and spark.catalog.tableExists(name):
        return {"table": name, "status": "skipped", "n_rows": spark.table(name).count(), "duration_sec": 0.0}
    written = overwrite_table(df, name, comment)
    n_rows = written.count()
    return {
        "table": name,
        "status": "written",
        "n_rows": n_rows,
        "duration_sec": round(time.monotonic() - started, 1),
    }


def append_audit(spark: SparkSession, records: Sequence[dict], ddl: str, name: str) -> DataFrame:
    """Append one row per record, stamped with the run time. Missing fields are NULL.

    Rows are built by position from the DDL. A column the stored table lacks is added to it first.
    """
    audit = inline_rows(spark, records, ddl).withColumn("run_at", F.current_timestamp())
    if spark.catalog.tableExists(name):
        stored = spark.table(name).columns
        added = [f for f in audit.schema.fields if f.name not in stored]
        if added:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
        order = spark.table(name).columns
        for c in order:
            if c not in audit.columns:
                audit = audit.withColumn(c, F.lit(None).cast(spark.table(name).schema[c].dataType))
        audit.select(*order).write.insertInto(name)
    else:
        audit.write.saveAsTable(name)
    return audit


def inline_rows(spark: SparkSession, records: Sequence[dict], ddl: str) -> DataFrame:
    from pyspark.sql.types import StructType

    names = StructType.fromDDL(ddl).fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], ddl)


def append_files(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Read files written with different column sets as one table."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def clustered(df: DataFrame, keys: Sequence[str], partitions: int | None = None, spread: int = 64) -> DataFrame:
    """Range-partition and sort on the keys so that file statistics prune key look-ups.

    The partitioning also ranges over a hash of the row: rows of one very frequent key are cut
    into up to ``spread`` pieces instead of landing in one task. The hash depends on the row
    only, so a retried task produces the same split.
    """
    piece = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(spread))
    columns = [*[F.col(k) for k in keys], piece]
    ranged = df.repartitionByRange(partitions, *columns) if partitions else df.repartitionByRange(*columns)
    return ranged.sortWithinPartitions(*keys)


def clustered_on_all(df: DataFrame, keys: Sequence[str], partitions: int | None = None, bits: int = 6, spread: int = 64) -> DataFrame:
    """Range-partition and sort on a Z-order of the keys, so that file statistics prune look-ups on any of them.

    With :func:`clustered` the second key only orders rows within one value of the first; here each key is kept together
    about equally. Rows of one frequent combination are cut by a row hash as there.
    """
    own = [F.col(f"`{c}`") for c in df.columns]
    piece = F.pmod(F.xxhash64(*own), F.lit(spread))
    keyed = df.select(*own, interleaved(df, keys, bits).alias("_z"), piece.alias("_piece"))
    ranged = keyed.repartitionByRange(partitions, "_z", "_piece") if partitions else keyed.repartitionByRange("_z", "_piece")
    return ranged.sortWithinPartitions("_z").select(*own)


def overwrite_clustered(df: DataFrame, name: str, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    clustered(df, keys, partitions).write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Name and comment of the tables of a database; the listing is catalog metadata only."""
    rows = [(t.name, t.description) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "table_name string, comment string").orderBy("table_name")
