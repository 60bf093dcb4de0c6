"""Features from tradelines held elsewhere: scores, mix, debt, delinquency, credit seeking."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake import config as cfg
from cohortlake.functions import columns as fx


@dataclass(frozen=True)
class TradelineColumns:
    """Column roles of the tradeline table."""

    customer: str = "SK_ID_CURR"
    tradeline: str = "SK_ID_BUREAU"
    kind: str = "CREDIT_TYPE"
    state: str = "CREDIT_ACTIVE"
    opened_day: str = "DAYS_CREDIT"
    debt: str = "AMT_CREDIT_SUM_DEBT"
    limit: str = "AMT_CREDIT_SUM_LIMIT"
    overdue: str = "AMT_CREDIT_SUM_OVERDUE"
    prolonged: str = "CNT_CREDIT_PROLONG"


# Tradeline kinds and states of the published extract.
REVOLVING = ("Credit card",)
MORTGAGE = ("Mortgage",)
INSTALMENT = ("Consumer credit", "Car loan", "Microloan")
ACTIVE, CLOSED, BAD_DEBT = "Active", "Closed", "Bad debt"


def score_features(df: DataFrame, scores: Sequence[str] = ("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3")) -> DataFrame:
    """Mean, minimum, sample deviation and number missing over the external scores of a row."""
    cols = [F.col(c) for c in scores]
    n = sum((c.isNotNull().cast("int") for c in cols), F.lit(0))
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cols), F.lit(0.0))
    mean = F.try_divide(total, n)
    squares = sum((F.coalesce(F.pow(c - mean, 2), F.lit(0.0)) for c in cols), F.lit(0.0))
    return df.withColumns(
        {
            "ext_score_mean": mean,
            "ext_score_min": F.least(*cols),
            "ext_score_std": F.when(n > 1, F.sqrt(squares / (n - 1))),
            "ext_score_n_missing": F.lit(len(scores)) - n,
        }
    )


def tradeline_features(
    df: DataFrame,
    cols: TradelineColumns = TradelineColumns(),
    revolving: Sequence[str] = REVOLVING,
    mortgage: Sequence[str] = MORTGAGE,
    instalment: Sequence[str] = INSTALMENT,
    days_per_month: float = cfg.DAYS_PER_MONTH,
) -> DataFrame:
    """Counts, mix, ages, utilisation and debt per customer.

    Rows first collapse to one per customer and kind, which is also what the mix entropy needs;
    every measure is then a sum or extreme over those few rows.
    """
    c, state = F.col, F.col(cols.state)
    age = -c(cols.opened_day)
    use = F.when(c(cols.limit) > 0, fx.safe_ratio(cols.debt, cols.limit))
    per_kind = df.groupBy(cols.customer, F.col(cols.kind).alias("kind")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(state == ACTIVE).alias("active"),
        F.count_if(state == CLOSED).alias("closed"),
        F.count_if(state == BAD_DEBT).alias("bad_debt"),
        F.max(age).alias("oldest"),
        F.min(age).alias("newest"),
        F.sum(age).alias("age_sum"),
        F.count(age).alias("age_n"),
        F.count_if(age <= 6 * days_per_month).alias("new_6m"),
        F.count_if(age <= 12 * days_per_month).alias("new_12m"),
        F.sum(cols.debt).alias("debt"),
        F.sum(cols.limit).alias("limit"),
        F.max(use).alias("max_use"),
        F.count_if(use > 0.9).alias("maxed"),
        F.sum(cols.overdue).alias("overdue"),
        F.count_if(c(cols.prolonged) > 0).alias("prolonged"),
    )
    kind = F.col("kind")
    named = [*revolving, *mortgage, *instalment]

    def of(kinds: Sequence[str], value: str) -> Column:
        return F.sum(F.when(kind.isin(*kinds), F.col(value)))

    def count_of(kinds: Sequence[str]) -> Column:
        return F.coalesce(of(kinds, "n"), F.lit(0))

    n = F.sum("n")
    # Entropy of the mix: ln N - sum(n ln n) / N.
    entropy = F.log(n) - F.sum(F.col("n") * F.log("n")) / n
    return per_kind.groupBy(cols.customer).agg(
        n.alias("n_tradelines_total"),
        F.sum("active").alias("n_tradelines_active"),
        F.sum("closed").alias("n_tradelines_closed"),
        count_of(revolving).alias("n_revolving"),
        count_of(instalment).alias("n_installment"),
        count_of(mortgage).alias("n_mortgage"),
        (n - count_of(named)).alias("n_other"),
        F.try_divide(count_of(revolving), n).alias("pct_revolving_of_total"),
        entropy.alias("trade_mix_entropy"),
        (F.max("oldest") / days_per_month).alias("oldest_tradeline_months"),
        (F.try_divide(F.sum("age_sum"), F.sum("age_n")) / days_per_month).alias("avg_tradeline_age_months"),
        (F.min("newest") / days_per_month).alias("newest_tradeline_months"),
        F.sum("new_6m").alias("n_tradelines_opened_6m"),
        F.sum("new_12m").alias("n_tradelines_opened_12m"),
        fx.safe_ratio(of(revolving, "debt"), of(revolving, "limit")).alias("bureau_util_revolving"),
        F.sum("debt").alias("bureau_total_debt"),
        F.sum("limit").alias("bureau_total_limit"),
        F.max("max_use").alias("max_single_tradeline_util"),
        F.sum("maxed").alias("n_maxed_tradelines"),
        F.sum("overdue").alias("bureau_amt_overdue"),
        F.sum("bad_debt").alias("bureau_n_bad_debt"),
        F.sum("prolonged").alias("bureau_n_prolonged"),
    )


def delinquency_features(
    status_panel: DataFrame,
    tradelines: DataFrame,
    cols: TradelineColumns = TradelineColumns(),
    month: str = "months_balance_aligned",
    now: int = -1,
) -> DataFrame:
    """Delinquency per customer from the decoded status panel, two hops away.

    The panel has no customer: it is reduced to one row per tradeline before the join, so the
    join moves tradelines rather than tradeline-months.
    """
    age, bucket = F.lit(now) - F.col(month), F.col("status_bucket")
    counts = {}
    for months in (12, 24):
        inside = (age >= 0) & (age < months)
        counts[f"bureau_n_30dpd_{months}m"] = F.count_if(inside & (bucket == 1))
        counts[f"bureau_n_60dpd_{months}m"] = F.count_if(inside & (bucket == 2))
        counts[f"bureau_n_90plus_{months}m"] = F.count_if(inside & (bucket >= 3))
    recent = (age >= 0) & (age < 12)
    per_tradeline = status_panel.filter(age >= 0).groupBy(cols.tradeline).agg(
        *[expr.alias(name) for name, expr in counts.items()],
        F.min(F.when(bucket >= 1, age)).alias("since"),
        F.max(bucket).alias("worst"),
        F.max(F.when(recent, bucket)).alias("worst_12m"),
    )
    owners = tradelines.select(cols.tradeline, cols.customer)
    return (
        per_tradeline.join(owners, cols.tradeline)
        .groupBy(cols.customer)
        .agg(
            *[F.sum(name).alias(name) for name in counts],
            F.min("since").alias("bureau_months_since_last_delinq"),
            F.max("worst").alias("bureau_max_bucket_ever"),
            F.max("worst_12m").alias("bureau_worst_status_12m"),
        )
    )


def inquiry_features(df: DataFrame, month: str, quarter: str, year: str) -> DataFrame:
    """Cumulative inquiry counts from the disjoint month, quarter and year fields, and their velocity."""
    m, q, y = (F.coalesce(F.col(c), F.lit(0)) for c in (month, quarter, year))
    return df.withColumns(
        {"n_inquiries_1m": m, "n_inquiries_3m": m + q, "n_inquiries_12m": m + q + y}
    ).withColumn("inquiry_velocity", fx.safe_ratio("n_inquiries_3m", "n_inquiries_12m"))


def debt_to_income(df: DataFrame, debt: str = "bureau_total_debt", income: str = "AMT_INCOME_TOTAL") -> DataFrame:
    return df.withColumn("dti_bureau", fx.safe_ratio(debt, income))
