"""Scorecard validation: separation, stability, calibration, gains, vintage curves.

Everything starts from one row per score point, so costs follow the number of points.
``target`` is 1 for bad; a higher score means less risk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.functions import columns as fx
from cohortlake.functions.running import bucketed, running_totals
from cohortlake.operators.binning import quantile_edges
from cohortlake.sources.workspace import materialise


def score_points(df: DataFrame, score: str = "score", target: str = "target") -> DataFrame:
    """``(score, n, bads, goods)``: rows with the same score collapse on the map side."""
    known = df.filter(F.col(score).isNotNull() & F.col(target).isNotNull())
    return known.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col(target).cast("bigint")).alias("bads"),
        F.sum((1 - F.col(target)).cast("bigint")).alias("goods"),
    )


def separation(df: DataFrame, score: str = "score", target: str = "target") -> DataFrame:
    """KS, AUC, Gini and divergence in one row. Ties count half in the AUC.

    Rows of a NaN score count as one score above all numbers; the divergence, made of means, is NaN then.
    """
    # Stored once: the cut points, the piece totals and the curve all read it.
    points = materialise(score_points(df, score, target), "score_points")
    curve = running_totals(points, "score", ["bads", "goods"])
    gap_here = F.abs(
        F.try_divide(F.col("cum_bads"), F.col("total_bads")) - F.try_divide(F.col("cum_goods"), F.col("total_goods"))
    )
    # A bad is ranked wrongly below every good with a smaller score, half wrongly at the same one.
    parts = curve.agg(
        F.sum("n").alias("n"),
        F.sum("bads").alias("n_bads"),
        F.sum("goods").alias("n_goods"),
        F.sum(F.col("bads") * (F.col("cum_goods") - F.col("goods") / 2)).alias("wrong"),
        F.max(gap_here).alias("ks"),
        *_moments("bads"),
        *_moments("goods"),
    )
    auc = 1 - F.try_divide(F.col("wrong"), F.col("n_bads").cast("double") * F.col("n_goods"))
    gap = F.pow(_mean("goods") - _mean("bads"), 2)
    return parts.select(
        "n",
        "n_bads",
        "ks",
        auc.alias("auc"),
        (2 * auc - 1).alias("gini"),
        F.try_divide(2 * gap, _variance("goods") + _variance("bads")).alias("divergence"),
    )


def _moments(weight: str) -> list[Column]:
    w, s = F.col(weight), F.col("score")
    return [F.sum(w * s).alias(f"s1_{weight}"), F.sum(w * s * s).alias(f"s2_{weight}")]


def _mean(weight: str) -> Column:
    return F.try_divide(F.col(f"s1_{weight}"), F.col(f"n_{weight}"))


def _variance(weight: str) -> Column:
    return F.try_divide(F.col(f"s2_{weight}"), F.col(f"n_{weight}")) - F.pow(_mean(weight), 2)


# -- bands -----------------------------------------------------------------------------------


def with_band(df: DataFrame, value: str, bands: int = 10, edges: Sequence[float] | None = None, name: str = "band") -> DataFrame:
    """Band 1..n by exact quantile edges (or given ones); equal values stay in one band."""
    inner = quantile_edges(df, [value], bands)[value] if edges is None else edges
    return bucketed(df, value, inner, name).withColumn(name, F.col(name) + 1)


def gains(df: DataFrame, score: str = "score", target: str = "target", bands: int = 10) -> DataFrame:
    """Gains and lift by score band, riskiest band first, with a rank-order flag."""
    banded = with_band(df.filter(F.col(score).isNotNull()), score, bands)
    per_band = banded.groupBy("band").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col(target).cast("bigint")).alias("bads"),
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
    )
    # One row per band from here on.
    order = Window.orderBy("band")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    everyone = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rate = fx.safe_ratio("bads", "n")
    base = F.try_divide(F.sum("bads").over(everyone), F.sum("n").over(everyone))
    return per_band.select(
        "band",
        "n",
        "bads",
        "min_score",
        "max_score",
        rate.alias("bad_rate"),
        F.try_divide(F.sum("n").over(upto), F.sum("n").over(everyone)).alias("cum_population"),
        F.try_divide(F.sum("bads").over(upto), F.sum("bads").over(everyone)).alias("cum_bad_capture"),
        F.try_divide(rate, base).alias("lift"),
        (rate < F.lag(rate).over(order)).alias("is_ranked"),
    )


def bad_rate_by_band(df: DataFrame, value: str, target: str = "target", bands: int = 10) -> DataFrame:
    """Bad rate per band of a feature and whether it moves one way; NULL values form band 0."""
    per_band = (
        with_band(df, value, bands)
        .groupBy(F.coalesce("band", F.lit(0)).alias("band"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg(target).alias("bad_rate"))
    )
    step = F.col("bad_rate") - F.lag("bad_rate").over(Window.orderBy("band"))
    real = F.col("band") > 1
    return per_band.withColumn("step", F.when(real, step))


def observed_direction(by_band: DataFrame) -> DataFrame:
    """'+' if the bad rate never falls with the feature, '-' if it never rises, else '?'."""
    moves = by_band.agg(F.count_if(F.col("step") > 0).alias("up"), F.count_if(F.col("step") < 0).alias("down"))
    sign = (
        F.when((F.col("down") == 0) & (F.col("up") > 0), "+")
        .when((F.col("up") == 0) & (F.col("down") > 0), "-")
        .otherwise("?")
    )
    return moves.select("up", "down", sign.alias("direction"))


def calibration(df: DataFrame, pd: str = "pd", target: str = "target", bands: int = 10, tolerance: float = 0.2) -> DataFrame:
    """Mean predicted against observed bad rate per band."""
    per_band = with_band(df, pd, bands).groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.avg(pd).alias("predicted"), F.avg(target).alias("observed")
    )
    off = F.try_divide(F.col("predicted") - F.col("observed"), F.col("observed"))
    return per_band.select("band", "n", "predicted", "observed", off.alias("relative_error"), (F.abs(off) <= tolerance).alias("is_ok"))


# -- stability --------------------------------------------------------------------------------


def psi_table(expected: DataFrame, actual: DataFrame, category: str, floor: float = 1e-6) -> DataFrame:
    """Shares of both samples per category, and each one's part of the index.

    Categories missing on one side take a share of ``floor``. NULL is a category.
    """

    def shares(df: DataFrame, name: str) -> DataFrame:
        counts = df.groupBy(F.coalesce(F.col(category).cast("string"), F.lit("(missing)")).alias("category")).agg(
            F.count(F.lit(1)).alias("n")
        )
        return counts.select("category", F.try_divide(F.col("n"), df.agg(F.count(F.lit(1))).scalar()).alias(name))

    both = shares(expected, "expected").join(shares(actual, "actual"), "category", "full_outer")
    e = F.greatest(F.coalesce("expected", F.lit(0.0)), F.lit(floor))
    a = F.greatest(F.coalesce("actual", F.lit(0.0)), F.lit(floor))
    return both.select("category", e.alias("expected"), a.alias("actual"), ((a - e) * F.log(a / e)).alias("psi"))


def psi(expected: DataFrame, actual: DataFrame, value: str, bands: int = 10) -> DataFrame:
    """Index of a numeric variable over quantile bands of the expected sample, with its verdict."""
    edges = quantile_edges(expected, [value], bands)[value]
    table = psi_table(with_band(expected, value, edges=edges), with_band(actual, value, edges=edges), "band")
    total = F.sum("psi")
    verdict = F.when(total < 0.10, "stable").when(total <= 0.25, "monitor").otherwise("unusable")
    return table.agg(total.alias("psi"), verdict.alias("verdict"))


def psi_by_period(
    expected: DataFrame, actual: DataFrame, value: str, period: str, bands: int = 10, floor: float = 1e-6
) -> DataFrame:
    """Index of each period of ``actual`` against the expected sample, all periods in one pass."""
    edges = quantile_edges(expected, [value], bands)[value]

    def banded(df: DataFrame) -> DataFrame:
        return with_band(df, value, edges=edges).withColumn("band", F.coalesce("band", F.lit(0)))

    base = banded(expected).groupBy("band").agg(F.count(F.lit(1)).alias("n"))
    base = base.select("band", F.try_divide(F.col("n"), expected.agg(F.count(F.lit(1))).scalar()).alias("_e"))
    seen = banded(actual).groupBy(period, "band").agg(F.count(F.lit(1)).alias("n"))
    # One row per period and band from here on.
    totals = seen.groupBy(period).agg(F.sum("n").alias("_total"))
    grid = totals.withColumn("band", F.explode(F.sequence(F.lit(0), F.lit(len(edges) + 1))))
    filled = grid.join(seen, [period, "band"], "left").join(F.broadcast(base), "band", "left")
    e = F.greatest(F.coalesce("_e", F.lit(0.0)), F.lit(floor))
    a = F.greatest(F.coalesce(F.try_divide(F.col("n"), F.col("_total")), F.lit(0.0)), F.lit(floor))
    return filled.groupBy(period).agg(
        F.max("_total").alias("n"), F.sum((a - e) * F.log(a / e)).alias("psi")
    )


def indeterminate_check(df: DataFrame, score: str = "score") -> DataFrame:
    """Mean score of bads, indeterminates and goods; the middle one must lie between."""

    def mean(condition: Column) -> Column:
        return F.avg(F.when(condition, F.col(score)))

    means = df.agg(
        mean(F.col("target") == 1).alias("bads"),
        mean(F.col("is_indeterminate")).alias("indeterminates"),
        mean((F.col("target") == 0) & ~F.col("is_indeterminate")).alias("goods"),
    )
    between = (F.col("bads") < F.col("indeterminates")) & (F.col("indeterminates") < F.col("goods"))
    return means.withColumn("is_between", between)


def vintage_curves(df: DataFrame, vintage: str, months_on_book: str, bad_month: str) -> DataFrame:
    """Cumulative bad rate by month on book.

    One input row per loan: ``bad_month`` is its first bad month on book or NULL,
    ``months_on_book`` the last month observed (it bounds the curve of the vintage).
    """
    size = df.groupBy(vintage).agg(F.count(F.lit(1)).alias("n"), F.max(months_on_book).alias("_last"))
    hits = df.filter(F.col(bad_month).isNotNull()).groupBy(vintage, F.col(bad_month).alias("month")).agg(
        F.count(F.lit(1)).alias("new_bads")
    )
    grid = size.select(vintage, "n", F.explode(F.sequence(F.lit(1), F.col("_last").cast("int"))).alias("month"))
    upto = Window.partitionBy(vintage).orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    cumulative = F.sum(F.coalesce("new_bads", F.lit(0))).over(upto)
    joined = grid.join(hits, [vintage, "month"], "left")
    return joined.select(
        vintage, "month", "n", cumulative.alias("cum_bads"), F.try_divide(cumulative, F.col("n")).alias("cum_bad_rate")
    )
