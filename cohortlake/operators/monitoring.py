"""Monitoring tables: shares, stability and bad rates of every feature, score band and action by period."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MISSING = "(missing)"


def band_of(value: str, edges: Sequence[float]) -> Column:
    """The band's number from 1, as text; an edge belongs to the band above it. NULL and NaN are a band of their own."""
    v = F.col(f"`{value}`").cast("double")
    number = sum(((v >= e).cast("int") for e in sorted(set(edges))), F.lit(1))
    return F.when(v.isNull() | F.isnan(v), MISSING).otherwise(number.cast("string"))


def monitoring(
    df: DataFrame,
    period: str,
    bands: Mapping[str, Sequence[float]],
    base: Column,
    *,
    categories: Sequence[str] = (),
    target: str = "target",
    pd: str = "pd",
    floor: float = 1e-6,
) -> DataFrame:
    """``period, feature, band``: rows, share, share in the base sample, stability index, observed and expected bad rate.

    ``bands`` are the inner edges of numeric features, the score among them; ``categories`` are features whose values are
    the bands, such as the action taken. ``base`` tells the development rows, whichever period they are in. A row of NULL
    band sums a feature up: its index is the sum over all bands, also those that the period lacks. A share below ``floor``
    counts as that in the index. Bad rates are over rows whose target is known, expected ones over rows with a
    probability; where there are none they are NULL. A NULL period is a period. No base rows: every base share is 0.

    The table is read once, into counts by period, sample, feature and band, combined before they are shuffled; the
    totals over bands and the base sample are grouping sets of those counts.
    """
    of = [F.struct(F.lit(f).alias("feature"), band_of(f, e).alias("band")) for f, e in bands.items()]
    of += [F.struct(F.lit(f).alias("feature"), F.coalesce(F.col(f"`{f}`").cast("string"), F.lit(MISSING)).alias("band")) for f in categories]
    t, p = F.col(f"`{target}`"), F.col(f"`{pd}`")
    rows = df.select(
        F.col(f"`{period}`").alias("period"), F.coalesce(base, F.lit(False)).alias("is_base"), t.alias("t"), p.alias("p"), F.inline(F.array(*of))
    )
    counts = rows.groupBy("period", "is_base", "feature", "band").agg(
        F.count(F.lit(1)).alias("n"), F.count("t").alias("n_t"), F.sum("t").alias("bads"), F.count("p").alias("n_p"), F.sum("p").alias("expected")
    )
    sums = [F.sum(c).alias(c) for c in ("n", "n_t", "bads", "n_p", "expected")]
    period_, is_base, feature, band = (F.col(c) for c in ("period", "is_base", "feature", "band"))
    every = counts.groupingSets(
        [[period_, feature, band], [period_, feature], [is_base, feature, band], [is_base, feature]], period_, is_base, feature, band
    ).agg(F.grouping_id().alias("_set"), *sums)
    # Bits of the grouping id: period 8, sample 4, feature 2, band 1; a set bit is summed over.
    by_band, by_period = every.where("_set = 4"), every.where("_set = 5").select("period", "feature", F.col("n").alias("n_all"))
    of_base = every.where("_set = 8 AND is_base").select("feature", "band", F.col("n").alias("n_base"))
    base_all = every.where("_set = 9 AND is_base").select("feature", F.col("n").alias("n_base_all"))
    known = every.where("_set = 8").select("feature", "band").distinct()
    grid = by_period.join(known, "feature").join(of_base, ["feature", "band"], "left").join(base_all, "feature", "left")
    seen = by_band.select(F.col("period").alias("_p"), F.col("feature").alias("_f"), F.col("band").alias("_b"), "n", "n_t", "bads", "n_p", "expected")
    same = F.col("period").eqNullSafe(F.col("_p")) & (F.col("feature") == F.col("_f")) & (F.col("band") == F.col("_b"))
    filled = grid.join(seen, same, "left").na.fill(0, ["n", "n_t", "n_p", "n_base"])
    share, base_share = F.try_divide(F.col("n"), F.col("n_all")), F.coalesce(F.try_divide(F.col("n_base"), F.col("n_base_all")), F.lit(0.0))
    a, e = F.greatest(share, F.lit(floor)), F.greatest(base_share, F.lit(floor))
    bands_ = filled.select(
        "period", "feature", "band", "n", "n_t", "bads", "n_p", "expected", share.alias("share"), base_share.alias("base_share"), ((a - e) * F.log(a / e)).alias("psi")
    )
    totals = bands_.groupBy("period", "feature").agg(
        F.lit(None).cast("string").alias("band"), *sums, F.sum("share").alias("share"), F.sum("base_share").alias("base_share"), F.sum("psi").alias("psi")
    )
    return bands_.unionByName(totals).select(
        "period", "feature", "band", "n", "share", "base_share", "psi",
        F.try_divide(F.col("bads"), F.col("n_t")).alias("bad_rate"), F.try_divide(F.col("expected"), F.col("n_p")).alias("expected_bad_rate"),
    )
