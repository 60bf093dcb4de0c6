"""Column profiles: null rates, distinct counts, descriptive statistics, value shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake.functions.quantiles import exact_quantiles


def _as_rows(structs: list[Column]) -> Column:
    return F.inline(F.array(*structs))


def column_profile(df: DataFrame, exact_distinct: bool = False) -> DataFrame:
    """``(column, data_type, n_rows, n_null, null_rate, n_distinct)`` for every column.

    The default counts distinct values with one sketch per column in a single aggregate. The
    exact mode turns cells into (column, value) pairs and groups them: more shuffle, but each
    column is spread over all tasks and frequent values collapse on the map side.
    """
    if exact_distinct:
        return _exact_profile(df)
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(df.columns):
        aggs += [F.count(F.col(c)).alias(f"v_{i}"), F.approx_count_distinct(F.col(c)).alias(f"d_{i}")]
    structs = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"v_{i}").alias("n_valid"),
            F.col(f"d_{i}").alias("n_distinct"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    rows = df.agg(*aggs).select("n_rows", _as_rows(structs))
    return _with_null_rate(rows)


def _with_null_rate(rows: DataFrame) -> DataFrame:
    n_null = F.col("n_rows") - F.col("n_valid")
    rate = F.coalesce(F.try_divide(n_null, F.col("n_rows")), F.lit(0.0))
    return rows.select(
        "column", "data_type", "n_rows", n_null.alias("n_null"), F.round(rate, 6).alias("null_rate"), "n_distinct"
    )


def _exact_profile(df: DataFrame) -> DataFrame:
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    cells = df.select(
        _as_rows([F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in df.columns])
    )
    values = cells.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    rows = values.groupBy("column").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("n_valid"),
        F.count("value").alias("n_distinct"),
    )
    type_of = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    return _with_null_rate(rows.withColumn("data_type", type_of[F.col("column")]))


def null_counts(df: DataFrame) -> DataFrame:
    """``(column, n_valid, n_null)``: complete and missing cells per column, one pass."""
    counted = df.agg(F.count(F.lit(1)).alias("all"), *[F.count(F.col(f"`{c}`")).alias(f"v{i}") for i, c in enumerate(df.columns)])
    structs = [
        F.struct(F.lit(c).alias("column"), F.col(f"v{i}").alias("n_valid"), (F.col("all") - F.col(f"v{i}")).alias("n_null"))
        for i, c in enumerate(df.columns)
    ]
    return counted.select(_as_rows(structs))


PERCENTILES = (0.25, 0.5, 0.75)


def describe(df: DataFrame, columns: Sequence[str], percentiles: Sequence[float] = PERCENTILES) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact interpolated percentiles, a row per column."""
    quantiles = exact_quantiles(df, {c: percentiles for c in columns})
    value = {c: F.col(c).cast("double") for c in columns}
    aggs = []
    for i, c in enumerate(columns):
        aggs += [
            F.count(value[c]).alias(f"count_{i}"),
            F.avg(value[c]).alias(f"mean_{i}"),
            F.stddev(value[c]).alias(f"std_{i}"),
            F.min(value[c]).alias(f"min_{i}"),
            F.max(value[c]).alias(f"max_{i}"),
        ]
    structs = [
        F.struct(
            F.lit(c).alias("column"),
            *[F.col(f"{stat}_{i}").alias(stat) for stat in ("count", "mean", "std", "min")],
            *[
                F.lit(q).cast("double").alias(percentile_name(p))
                for p, q in zip(percentiles, quantiles[c])
            ],
            F.col(f"max_{i}").alias("max"),
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*aggs).select(_as_rows(structs))


def percentile_name(p: float) -> str:
    return f"p{p * 100:g}".replace(".", "_")


def describe_text(df: DataFrame, column: str) -> DataFrame:
    """Count, distinct values, most frequent value and its count of a text column.

    Ties go to the smallest value, so the result does not depend on partitioning.
    """
    values = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )
    top = F.min_by(F.struct("value", "n"), F.struct((-F.col("n")).alias("rank"), F.col("value").alias("tie")))
    return values.agg(
        F.lit(column).alias("column"), F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), top.alias("t")
    ).select("column", F.coalesce("count", F.lit(0)).alias("count"), "unique",
             F.col("t.value").alias("top"), F.col("t.n").alias("freq"))


def value_counts(df: DataFrame, column: str, keep_null: bool = False) -> DataFrame:
    """Rows and share per value; the share is over the non-NULL rows unless NULL is kept.

    The total is a scalar subquery, so the groups are never gathered in one task.
    """
    rows = df if keep_null else df.filter(F.col(column).isNotNull())
    total = rows.agg(F.count(F.lit(1))).scalar()
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.try_divide(F.col("n"), total))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values, NULL included."""
    return df.select(column).distinct()


def data_quality_report(df: DataFrame, target: str | None = None) -> DataFrame:
    """Null profile plus extremes and, given a 0/1 target, its mean with and without the value."""
    fields = [f for f in df.schema.fields if f.name != target and not isinstance(f.dataType, T.BooleanType)]
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i, f in enumerate(fields):
        c = F.col(f.name)
        aggs += [F.count(c).alias(f"v_{i}"), F.min(c).alias(f"lo_{i}"), F.max(c).alias(f"hi_{i}")]
        if target:
            aggs += [
                F.avg(F.when(c.isNull(), F.col(target))).alias(f"tn_{i}"),
                F.avg(F.when(c.isNotNull(), F.col(target))).alias(f"tv_{i}"),
            ]
    structs = [
        F.struct(
            F.lit(f.name).alias("column"),
            (F.col("n_rows") - F.col(f"v_{i}")).alias("n_null"),
            F.col(f"lo_{i}").cast("string").alias("min"),
            F.col(f"hi_{i}").cast("string").alias("max"),
            *(
                [F.col(f"tn_{i}").alias("target_if_null"), F.col(f"tv_{i}").alias("target_if_present")]
                if target
                else []
            ),
        )
        for i, f in enumerate(fields)
    ]
    return df.agg(*aggs).select("n_rows", _as_rows(structs))
