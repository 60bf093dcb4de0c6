"""Risk buckets, the strategy tree with its rule table, and policy overrides."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.functions.running import bucketed
from cohortlake.operators.models import tree_vectors

# Lower score edge of each bucket, riskiest first.
BUCKETS = {"E": None, "D": 500.0, "C": 550.0, "B": 600.0, "A2": 650.0, "A1": 700.0}
# Actions from lenient to strict; an override may only move right.
ACTIONS = ("proactive increase", "increase on request", "hold", "restrict cash", "decrease", "restrict all")


def risk_bucket(df: DataFrame, score: str = "score", buckets: Mapping[str, float | None] = BUCKETS) -> DataFrame:
    names = list(buckets)
    edges = [e for e in buckets.values() if e is not None]
    placed = bucketed(df, score, edges, "_slot")
    label = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("_slot") + 1)
    return placed.withColumn("bucket", F.when(F.col("_slot").isNotNull(), label)).drop("_slot")


def bucket_report(df: DataFrame, score: str = "score", target: str = "target", min_share: float = 0.05) -> DataFrame:
    """Share, bad rate, cumulative bad capture per bucket; whether it is large enough and in order."""
    per_bucket = df.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col(target).cast("bigint")).alias("bads"),
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
    )
    # One row per bucket from here on.
    order = Window.orderBy("min_score")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    everyone = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rate = F.try_divide(F.col("bads"), F.col("n"))
    share = F.try_divide(F.col("n"), F.sum("n").over(everyone))
    return per_bucket.select(
        "bucket",
        "n",
        "min_score",
        "max_score",
        share.alias("share"),
        rate.alias("bad_rate"),
        F.try_divide(F.sum("bads").over(upto), F.sum("bads").over(everyone)).alias("cum_bad_capture"),
        (share >= min_share).alias("is_large_enough"),
        (rate < F.lag(rate).over(order)).alias("is_ranked"),
    )


def with_overrides(df: DataFrame, action: str, overrides: Sequence[tuple[Column, str]], actions: Sequence[str] = ACTIONS) -> DataFrame:
    """Apply hard rules after the tree. The result is the strictest of all that apply."""
    level = F.array_position(F.array(*[F.lit(a) for a in actions]), F.col(action)).cast("int")
    levels = [level]
    for condition, forced in overrides:
        strict = F.lit(actions.index(forced) + 1)
        levels.append(F.when(F.coalesce(condition, F.lit(False)), strict).otherwise(F.lit(0)))
    final = F.greatest(*levels) if len(levels) > 1 else level
    named = F.element_at(F.array(*[F.lit(a) for a in actions]), final)
    return df.withColumns({"final_action": named, "is_overridden": final > level})


def fit_tree(
    df: DataFrame, features: Sequence[str], target: str = "target", max_depth: int = 4, min_leaf_share: float = 0.02
) -> DecisionTreeRegressionModel:
    """A shallow tree whose leaves hold at least a minimum share of the rows.

    Variance of a 0/1 target splits exactly as Gini impurity does, but keeps leaves apart that
    differ in bad rate and would all be called good by a classifier.
    """
    vectors = tree_vectors(df, features)
    tree = DecisionTreeRegressor(
        featuresCol="_x",
        labelCol=target,
        maxDepth=max_depth,
        minWeightFractionPerNode=min_leaf_share,
        impurity="variance",
        leafCol="_leaf",
        seed=42,
    )
    return tree.fit(vectors)


def leaf_table(model: DecisionTreeRegressionModel, df: DataFrame, features: Sequence[str], target: str = "target") -> DataFrame:
    """Rows, share, bad rate and feature ranges per leaf: the rule table."""
    vectors = tree_vectors(df, features)
    placed = model.transform(vectors).withColumn("leaf", F.col("_leaf").cast("int"))
    ranges = [agg(f).alias(f"{label}_{f}") for f in features for label, agg in (("min", F.min), ("max", F.max))]
    leaves = placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.avg(target).alias("bad_rate"), *ranges)
    share = F.try_divide(F.col("n"), F.sum("n").over(Window.partitionBy()))
    return leaves.withColumn("share", share)
