"""Two scores over the same rows: the gap of their Gini coefficients and how far it is chance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.functions.running import running_totals
from cohortlake.sources.workspace import materialise


def placements(pairs: DataFrame, score: str) -> DataFrame:
    """Per value of a score, the share of goods it ranks above (for a bad), and of bads below (for a good); ties half.

    ``score, of_bad, of_good``: from midranks by running totals over the score's distinct values.
    """
    points = materialise(
        pairs.groupBy(F.col(score).alias("at")).agg(
            F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("bads"), F.sum(F.when(F.col("bad"), 0).otherwise(F.col("n"))).alias("goods")
        ),
        "placements",
    )
    curve = running_totals(points, "at", ["bads", "goods"])
    above = F.col("total_goods") - F.col("cum_goods") + F.col("goods") / 2
    below = F.col("cum_bads") - F.col("bads") / 2
    return curve.select(
        F.col("at").alias(score), F.try_divide(above, F.col("total_goods")).alias(f"{score}_of_bad"), F.try_divide(below, F.col("total_bads")).alias(f"{score}_of_good")
    )


def gini_gap(df: DataFrame, score_a: str, score_b: str, target: str = "target") -> DataFrame:
    """One row: both Gini coefficients on the rows that have both scores, their gap (b less a), its error and z.

    A higher score means less risk, ``target`` is 1 for bad. Every row's placement among the other class under each score
    gives the coefficients as means, and the gap's variance from the placements' differences, so that the scores' common
    rows are not taken for independent samples. Rows equal in both scores and target are one weighted row from the start,
    so ties make the work smaller. Rows without a score or target are left out; NaN is one value above all numbers. With
    fewer than two rows of a class the error is NULL.
    """
    a, b = F.col(f"`{score_a}`").cast("double"), F.col(f"`{score_b}`").cast("double")
    known = df.where(a.isNotNull() & b.isNotNull() & F.col(f"`{target}`").isNotNull())
    pairs = materialise(
        known.groupBy(a.alias("a"), b.alias("b"), (F.col(f"`{target}`") == 1).alias("bad")).agg(F.count(F.lit(1)).alias("n")), "score_pairs"
    )
    placed = pairs.join(placements(pairs, "a"), "a").join(placements(pairs, "b"), "b")
    va = F.when(F.col("bad"), F.col("a_of_bad")).otherwise(F.col("a_of_good"))
    vb = F.when(F.col("bad"), F.col("b_of_bad")).otherwise(F.col("b_of_good"))
    n, gap = F.col("n"), vb - va

    def total(bad: bool, value):
        return F.sum(F.when(F.col("bad") == bad, n * value).otherwise(0))

    sums = placed.agg(
        *[total(k, F.lit(1)).cast("long").alias(f"n_{name}") for k, name in ((True, "bads"), (False, "goods"))],
        *[total(k, x).alias(f"{c}_{name}") for k, name in ((True, "bads"), (False, "goods")) for c, x in (("a", va), ("b", vb), ("d", gap), ("dd", gap * gap))],
    )

    def variance(name: str):
        m = F.col(f"n_{name}")
        spread = F.greatest(F.col(f"dd_{name}") - F.col(f"d_{name}") * F.col(f"d_{name}") / m, F.lit(0.0))
        return F.when(m > 1, spread / (m - 1) / m)

    auc_a, auc_b = F.try_divide(F.col("a_bads"), F.col("n_bads")), F.try_divide(F.col("b_bads"), F.col("n_bads"))
    error = 2 * F.sqrt(variance("bads") + variance("goods"))
    return sums.select(
        "n_bads", "n_goods", (2 * auc_a - 1).alias("gini_a"), (2 * auc_b - 1).alias("gini_b"), (2 * (auc_b - auc_a)).alias("gap"),
        error.alias("gap_error"), F.try_divide(2 * (auc_b - auc_a), error).alias("z"),
    )
