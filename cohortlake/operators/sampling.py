"""Point-in-time joins, stratified splits and weighted down-sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.functions import columns as fx
from cohortlake.functions.quantiles import exact_quantiles
from cohortlake.functions.running import bucketed


def join_features(target: DataFrame, features: DataFrame, keys: Sequence[str], point: str = "obs_point") -> DataFrame:
    """Features computed for exactly the target's observation point."""
    shared = [c for c in features.columns if c in target.columns and c not in (*keys, point)]
    return target.join(features.drop(*shared), [*keys, point], "left")


def as_of_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, time: str, values: Sequence[str], pieces: int = 64
) -> DataFrame:
    """Latest right-hand values with ``time <= at`` for each left row; NULL if there is none.

    No pair of rows is ever built: both sides shrink to one row per key and time value, the
    values are carried forward along the axis, and the left rows look them up by equality. The
    axis (numeric, date or timestamp) is cut into ``pieces``; each is filled on its own from the
    end of the piece before it, so a key with very many time values is spread over many tasks.
    Rows with the same key and time resolve to the largest values.
    """
    packed = F.struct(*[F.col(v) for v in values])
    known = right.groupBy(*keys, F.col(time).alias(at)).agg(F.max(packed).alias("_known"))
    asked = left.select(*keys, at).distinct()
    axis = asked.join(known, [*keys, at], "full_outer")

    number = F.col(at)
    if dict(left.dtypes)[at] in ("date", "timestamp_ntz"):
        number = number.cast("timestamp")
    probs = [i / pieces for i in range(1, pieces)]
    times = right.select(F.col(time).alias(at)).select(number.cast("double").alias("_t"))
    cuts = times.approxQuantile("_t", probs, 0.5 / pieces) if probs else []
    placed = bucketed(axis.withColumn("_t", number.cast("double")), "_t", cuts, "_piece").drop("_t")

    # At most ``pieces`` rows per key: the last known values of each piece, then of all before it.
    has_value = F.col("_known").isNotNull()
    ends = placed.groupBy(*keys, "_piece").agg(F.max_by("_known", F.when(has_value, F.col(at))).alias("_end"))
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*keys, "_piece", F.last("_end", ignorenulls=True).over(before).alias("_carried"))

    inside = Window.partitionBy(*keys, "_piece").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    filled = placed.withColumn("_last", F.last("_known", ignorenulls=True).over(inside)).join(
        carried, [*keys, "_piece"], "left"
    )
    resolved = filled.select(*keys, at, F.coalesce("_last", "_carried").alias("_known"))
    return left.join(resolved, [*keys, at], "left").select(*left.columns, *[F.col(f"_known.{v}") for v in values])


def stratified_split(
    df: DataFrame, key: str, stratum: str, strata: Sequence, train_share: float = 0.7, seed: int = 42, name: str = "split"
) -> DataFrame:
    """'train' / 'test' with the same share in every stratum.

    Rows are ordered by a hash of their key; the share's exact quantile of that hash within each
    stratum is the threshold. Same data and seed, same split. Rows of no given stratum, NULL included, are one more.
    """
    digest = fx.hash_bucket(key, seed, 2**31 - 1).cast("double")
    marked = df.withColumn("_h", digest)
    inside = [F.coalesce(F.col(stratum) == s, F.lit(False)) for s in strata]
    rest = F.lit(True)
    for condition in inside:
        rest = rest & ~condition
    groups = [*inside, rest]
    per_stratum = marked.select(*[F.when(g, F.col("_h")).alias(f"h{i}") for i, g in enumerate(groups)])
    cuts = exact_quantiles(per_stratum, {f"h{i}": [train_share] for i in range(len(groups))})
    threshold = F.lit(None).cast("double")
    for i, g in enumerate(groups):
        cut = cuts[f"h{i}"][0]
        if cut is not None:
            threshold = F.when(g, F.lit(cut)).otherwise(threshold)
    side = F.when(F.col("_h") <= threshold, "train").when(threshold.isNotNull(), "test")
    return marked.withColumn(name, side).drop("_h")


def down_sample(
    df: DataFrame, key: str, target: str, keep_percent: int, seed: int = 42, weight: str = "weight"
) -> DataFrame:
    """Keep every bad and a hash sample of the goods; the weight restores the bad rate."""
    is_bad = F.col(target) == 1
    kept = df.filter(is_bad | (fx.hash_bucket(key, seed, 100) < keep_percent))
    return kept.withColumn(weight, F.when(is_bad, 1.0).otherwise(100.0 / keep_percent))
