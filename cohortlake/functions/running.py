"""Running totals over a sorted axis without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bucketed(df: DataFrame, key: str, edges: Sequence[float], name: str) -> DataFrame:
    """Integer bucket of ``key`` between sorted inner edges, by binary search; NULL and NaN give NULL.

    Bucket ``i`` is ``[edges[i-1], edges[i])``; values on an edge belong to the bucket above it.
    """
    inner = sorted(set(edges))
    if not inner:
        return df.withColumn(name, F.when(F.col(key).isNotNull(), F.lit(0)))
    splits = [float("-inf"), *inner, float("inf")]
    tool = Bucketizer(splits=splits, inputCol="_key", outputCol="_bucket", handleInvalid="keep")
    placed = tool.transform(df.withColumn("_key", F.col(key).cast("double")))
    kept = F.when(F.col("_bucket") < len(splits) - 1, F.col("_bucket").cast("int"))
    return placed.withColumn(name, kept).drop("_key", "_bucket")


def running_totals(df: DataFrame, key: str, columns: Sequence[str], pieces: int = 200) -> DataFrame:
    """Add ``cum_<column>``, the sum over all rows with a smaller or equal ``key``, and ``total_<column>``.

    ``key`` must be unique and numeric; NaN comes after all numbers and NULL last, as pieces of their own. A sketch cuts the axis into ``pieces`` ranges; each range
    is summed on its own, and the totals of the ranges before it (a table of ``pieces`` rows) are
    added on top.
    """
    probs = [i / pieces for i in range(1, pieces)]
    cuts = df.approxQuantile(key, probs, 0.5 / pieces) if probs else []
    last = len(cuts) + 1
    missing = F.when(F.col(key).isNull(), last + 1).when(F.isnan(F.col(key).cast("double")), last)
    parts = bucketed(df, key, cuts, "_piece").withColumn("_piece", F.coalesce(missing, "_piece"))
    totals = parts.groupBy("_piece").agg(*[F.sum(c).alias(f"_sum_{c}") for c in columns])
    earlier = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "_piece",
        *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_before_{c}") for c in columns],
        *[F.sum(f"_sum_{c}").over(everything).alias(f"total_{c}") for c in columns],
    )
    inside = Window.partitionBy("_piece").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    # The offsets are at most ``pieces`` rows long.
    joined = parts.join(F.broadcast(offsets), "_piece")

    def upto(c: str) -> Column:
        return F.sum(c).over(inside) + F.col(f"_before_{c}")

    out = joined.withColumns({f"cum_{c}": upto(c) for c in columns})
    return out.drop("_piece", *[f"_before_{c}" for c in columns])
