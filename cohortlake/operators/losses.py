"""Default events, recovery and exposure, expected loss, cut-offs, swap sets, stress."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake import config as cfg
from cohortlake.functions import columns as fx
from cohortlake.functions.running import bucketed


def default_events(
    panel: DataFrame,
    cols: cfg.PanelColumns = cfg.PanelColumns(),
    bad_from: int = 90,
    workout: int = cfg.WORKOUT_MONTHS,
) -> DataFrame:
    """One row per defaulted account: default month, balances at default and after the workout.

    The default month is found first (a small table: only accounts that ever default); the panel
    is then read again for those accounts and their workout months only.
    """
    month = F.col(cols.month)
    first = (
        panel.filter(F.col(cols.dpd) >= bad_from).groupBy(*cols.keys).agg(F.min(month).alias("default_month"))
    )
    rows = panel.select(*cols.keys, cols.month, cols.balance, cols.limit).join(first, cols.keys, "inner")
    after = month - F.col("default_month")
    return rows.groupBy(*cols.keys, "default_month").agg(
        F.max(F.when(after == 0, F.col(cols.balance))).alias("balance_at_default"),
        F.max(F.when(after == 0, F.col(cols.limit))).alias("limit_at_default"),
        F.max(F.when(after == workout, F.col(cols.balance))).alias("balance_after_workout"),
        F.max(after).alias("months_after_default"),
    )


def with_recovery(df: DataFrame, workout: int = cfg.WORKOUT_MONTHS) -> DataFrame:
    """Balance-reduction recovery in [0, 1] where the workout is observed in full."""
    covered = F.col("months_after_default") >= workout
    paid_down = fx.safe_ratio(F.col("balance_at_default") - F.col("balance_after_workout"), F.col("balance_at_default"))
    rate = F.when(covered & (F.col("balance_at_default") > 0), fx.clip(paid_down, 0.0, 1.0))
    return df.withColumns({"is_covered": covered, "recovery_rate": rate, "lgd": 1 - rate})


def exposure_measures(
    balance_default: str, limit_obs: str, balance_obs: str, cap: float = cfg.EAD_RATIO_CAP
) -> dict[str, Column]:
    """Exposure over limit (capped) and the classical conversion factor as a diagnostic."""
    limit, start = F.col(limit_obs), F.col(balance_obs)
    ratio = F.when(limit > 0, fx.safe_ratio(F.col(balance_default), limit))
    ccf = fx.safe_ratio(F.col(balance_default) - start, limit - start)
    return {"ead_ratio": fx.clip(ratio, 0.0, cap), "ccf": ccf, "ccf_in_bounds": ccf.between(0, 1)}


def recovery_stages(df: DataFrame, *segment: str) -> DataFrame:
    """Two-stage loss per segment: share with any recovery, mean recovery if any, their product."""
    known = df.filter(F.col("recovery_rate").isNotNull())
    some = F.col("recovery_rate") > 0
    grouped = known.groupBy(*segment).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(some.cast("int")).alias("p_recovery"),
        F.avg(F.when(some, F.col("recovery_rate"))).alias("recovery_if_any"),
    )
    expected = F.col("p_recovery") * F.coalesce("recovery_if_any", F.lit(0.0))
    return grouped.withColumn("lgd", 1 - expected)


def loan_losses(df: DataFrame, recovered: str, funded: str, principal_repaid: str) -> DataFrame:
    """Loan-level form: recovered share of the funded amount, exposure = principal still out."""
    rate = fx.clip(fx.safe_ratio(recovered, funded), 0.0, 1.0)
    return df.withColumns({"recovery_rate": rate, "lgd": 1 - rate, "ead": F.col(funded) - F.col(principal_repaid)})


# -- expected loss ------------------------------------------------------------------------


def expected_loss(
    df: DataFrame,
    pd: str = "pd",
    lgd: str = "lgd",
    ead: str = "ead",
    outstanding: str = "balance",
    undrawn: str | None = None,
) -> DataFrame:
    """``el`` per row; missing components take the flat assumptions and are flagged."""
    drawn = F.coalesce(F.col(outstanding), F.lit(0.0))
    assumed = drawn if undrawn is None else drawn + F.lit(cfg.CCF_FALLBACK) * F.coalesce(F.col(undrawn), F.lit(0.0))
    used_lgd = F.coalesce(F.col(lgd), F.lit(cfg.LGD_FALLBACK))
    used_ead = F.coalesce(F.col(ead), assumed)
    return df.withColumns(
        {
            "is_modelled": F.col(lgd).isNotNull() & F.col(ead).isNotNull(),
            "el": F.col(pd) * used_lgd * used_ead,
            "el_flat": F.col(pd) * F.lit(cfg.LGD_FALLBACK) * assumed,
        }
    )


def contribution(
    df: DataFrame,
    balance: str = "balance",
    spend: str = "spend",
    margin: float = 0.12,
    interchange: float = 0.01,
    funding: float = 0.03,
    servicing: float = 20.0,
) -> DataFrame:
    """Revenue minus funding, servicing and expected loss; every rate is a parameter."""
    held, spent = F.coalesce(balance, F.lit(0.0)), F.coalesce(spend, F.lit(0.0))
    revenue = held * margin + spent * interchange
    cost = held * funding + F.lit(servicing)
    return df.withColumns({"revenue": revenue, "cost": cost, "contribution": revenue - cost - F.col("el")})


def cutoff_sweep(df: DataFrame, cutoffs: Sequence[float], score: str = "score", target: str = "target") -> DataFrame:
    """Approval at each cut-off. Rows are summed per interval; cumulating takes a row per cut-off."""
    edges = sorted(set(float(c) for c in cutoffs))
    per_interval = (
        bucketed(df.filter(F.col(score).isNotNull()), score, edges, "_slot")
        .groupBy("_slot")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col(target).cast("bigint")).alias("bads"),
            F.sum("el").alias("el"),
            F.sum("contribution").alias("contribution"),
        )
    )
    spark = df.sparkSession
    slots = spark.createDataFrame([(0, None), *[(i + 1, e) for i, e in enumerate(edges)]], "_slot int, cutoff double")
    filled = slots.join(per_interval, "_slot", "left").fillna(0, ["n", "bads", "el", "contribution"])
    above = Window.orderBy(F.col("_slot").desc()).rowsBetween(Window.unboundedPreceding, 0)
    everyone = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    swept = filled.select(
        "cutoff",
        F.sum("n").over(above).alias("n_approved"),
        F.sum("bads").over(above).alias("bads_approved"),
        F.sum("el").over(above).alias("el"),
        F.sum("contribution").over(above).alias("contribution"),
        F.sum("n").over(everyone).alias("_n"),
        F.sum("bads").over(everyone).alias("_bads"),
    ).filter(F.col("cutoff").isNotNull())
    return swept.select(
        "cutoff",
        "n_approved",
        fx.safe_ratio("n_approved", "_n").alias("approval_rate"),
        fx.safe_ratio("bads_approved", "n_approved").alias("bad_rate"),
        fx.safe_ratio(F.col("_bads") - F.col("bads_approved"), F.col("_bads")).alias("bad_capture"),
        "el",
        "contribution",
    )


def swap_set(df: DataFrame, incumbent: Column, challenger: Column, target: str = "target") -> DataFrame:
    """The 2 x 2 of both decisions with volume and bad rate."""
    side = (
        F.when(incumbent & challenger, "both approve")
        .when(challenger, "swap in")
        .when(incumbent, "swap out")
        .otherwise("both decline")
    )
    return df.groupBy(side.alias("decision")).agg(F.count(F.lit(1)).alias("n"), F.avg(target).alias("bad_rate"))


def stress(df: DataFrame, group: str, multipliers: Sequence[float] = (1.0, 1.5, 2.0), pd: str = "pd") -> DataFrame:
    """Expected loss and contribution per group with the default probability scaled up to at most 1."""
    scaled = df.select("*", F.explode(F.array(*[F.lit(float(m)) for m in multipliers])).alias("multiplier"))
    stressed_el = F.col("el") * fx.safe_ratio(F.least(F.col(pd) * F.col("multiplier"), F.lit(1.0)), F.col(pd))
    out = scaled.withColumn("_el", F.coalesce(stressed_el, F.lit(0.0)))
    return out.groupBy(group, "multiplier").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("_el").alias("el"),
        F.sum(F.col("contribution") + F.col("el") - F.col("_el")).alias("contribution"),
    )
