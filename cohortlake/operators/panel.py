"""Account-by-month panels: alignment, pooling, window filters and trailing windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake import config as cfg

# Column order of the pooled panel of the monthly extract.
POOLED_KEYS = ("SK_ID_PREV", "SK_ID_CURR", "MONTHS_BALANCE")
POOLED_DERIVED = ("product_type", "has_valid_limit", "utilisation", "is_overlimit", "overlimit_amount")
POOLED_SHARED = ("NAME_CONTRACT_STATUS", "SK_DPD", "SK_DPD_DEF")
POOLED_CARD_ONLY = (
    "AMT_BALANCE",
    "AMT_CREDIT_LIMIT_ACTUAL",
    "AMT_DRAWINGS_ATM_CURRENT",
    "AMT_DRAWINGS_CURRENT",
    "AMT_DRAWINGS_OTHER_CURRENT",
    "AMT_DRAWINGS_POS_CURRENT",
    "AMT_INST_MIN_REGULARITY",
    "AMT_PAYMENT_CURRENT",
    "AMT_PAYMENT_TOTAL_CURRENT",
    "AMT_RECEIVABLE_PRINCIPAL",
    "AMT_RECIVABLE",
    "AMT_TOTAL_RECEIVABLE",
    "CNT_DRAWINGS_ATM_CURRENT",
    "CNT_DRAWINGS_CURRENT",
    "CNT_DRAWINGS_OTHER_CURRENT",
    "CNT_DRAWINGS_POS_CURRENT",
    "CNT_INSTALMENT_MATURE_CUM",
)
POOLED_POS_ONLY = ("CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE")
POOLED_COLUMNS = (*POOLED_KEYS, *POOLED_DERIVED, *POOLED_SHARED, *POOLED_CARD_ONLY, *POOLED_POS_ONLY)


# -- pooling ----------------------------------------------------------------


def limit_measures(df: DataFrame, cols: cfg.PanelColumns = cfg.PanelColumns()) -> DataFrame:
    """Utilisation and overlimit measures of a revolving product.

    Without a positive limit, utilisation and the overlimit flag are undefined (NULL) while the
    overlimit amount is zero.
    """
    balance, limit = F.col(cols.balance), F.col(cols.limit)
    valid = limit > 0
    over = balance > limit
    return df.withColumns(
        {
            cols.has_valid_limit: valid,
            cols.utilisation: F.when(valid, F.try_divide(balance, limit)),
            cols.is_overlimit: F.when(valid, over),
            cols.overlimit_amount: F.when(valid & over, balance - limit).otherwise(F.lit(0.0)),
        }
    )


def no_limit_measures(df: DataFrame, cols: cfg.PanelColumns = cfg.PanelColumns()) -> DataFrame:
    """The same measures for a product without a limit: all NULL, never zero."""
    return df.withColumns(
        {
            cols.has_valid_limit: F.lit(None).cast("boolean"),
            cols.utilisation: F.lit(None).cast("double"),
            cols.is_overlimit: F.lit(None).cast("boolean"),
            cols.overlimit_amount: F.lit(None).cast("double"),
        }
    )


def align_panel(
    df: DataFrame,
    product: str,
    revolving: bool,
    cols: cfg.PanelColumns = cfg.EXTRACT_PANEL,
    output: Sequence[str] = POOLED_COLUMNS,
) -> DataFrame:
    """Bring one product's panel to the shared column list; what it lacks is a NULL double."""
    tagged = df.withColumn(cols.product, F.lit(product))
    measured = limit_measures(tagged, cols) if revolving else no_limit_measures(tagged, cols)
    lacking = [c for c in output if c not in measured.columns]
    return measured.withColumns({c: F.lit(None).cast("double") for c in lacking}).select(*output)


def pool_panels(card: DataFrame, pos: DataFrame, cols: cfg.PanelColumns = cfg.EXTRACT_PANEL) -> DataFrame:
    return align_panel(card, cfg.PRODUCT_CARD, True, cols).unionByName(
        align_panel(pos, cfg.PRODUCT_POS, False, cols)
    )


def with_limit_measures(df: DataFrame, cols: cfg.PanelColumns = cfg.PanelColumns()) -> DataFrame:
    """Limit measures for a panel that is pooled already: only card rows get values."""
    measured = limit_measures(df, cols)
    is_card = F.col(cols.product) == cfg.PRODUCT_CARD
    names = [cols.has_valid_limit, cols.utilisation, cols.is_overlimit, cols.overlimit_amount]
    return measured.withColumns({c: F.when(is_card, F.col(c)) for c in names})


# -- window filters ---------------------------------------------------------


def months_between(df: DataFrame, window: tuple[int, int], month: str = "month_idx") -> DataFrame:
    return df.filter(F.col(month).between(*window))


def state_at(df: DataFrame, month_value: int, state: dict[str, str], key: str, month: str = "month_idx") -> DataFrame:
    """Columns as of one month, renamed: ``{"dpd": "dpd_at_obs"}``."""
    return df.filter(F.col(month) == month_value).select(key, *[F.col(c).alias(a) for c, a in state.items()])


def history_until(df: DataFrame, obs_point: int, month: str = "month_idx") -> DataFrame:
    return df.filter(F.col(month) <= obs_point)


def future_after(df: DataFrame, obs_point: int, month: str = "month_idx") -> DataFrame:
    return df.filter(F.col(month) > obs_point)


def day_bounds(obs_point: int | Column, months: int, days_per_month: float = cfg.DAYS_PER_MONTH):
    """Half-open day range ``[low, high)`` of the trailing month window."""
    return (obs_point - (months - 1)) * days_per_month, (obs_point + 1) * days_per_month


def days_in_window(df: DataFrame, obs_point: int, months: int, day: str) -> DataFrame:
    low, high = day_bounds(obs_point, months)
    return df.filter((F.col(day) >= F.lit(low)) & (F.col(day) < F.lit(high)))


# -- trailing windows for every month ----------------------------------------


def trailing_all_months(
    df: DataFrame, months: int, cols: cfg.PanelColumns = cfg.PanelColumns(), suffix: str | None = None
) -> DataFrame:
    """Trailing-window row count, worst delinquency, mean and total balance as of each month.

    Rows are first reduced to one per account and month with mergeable parts, so the window sees
    at most one row per month of the axis however many rows an account has.
    """
    n = suffix or f"{months}m"
    monthly = df.groupBy(*cols.keys, cols.month).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.max(cols.dpd).alias("_dpd"),
        F.sum(cols.balance).alias("_balance"),
        F.count(cols.balance).alias("_balance_rows"),
    )
    w = Window.partitionBy(*cols.keys).orderBy(cols.month).rangeBetween(-(months - 1), 0)
    total, filled = F.sum("_balance").over(w), F.sum("_balance_rows").over(w)
    return monthly.select(
        *cols.keys,
        cols.month,
        F.sum("_rows").over(w).alias(f"n_months_{n}"),
        F.max("_dpd").over(w).alias(f"max_dpd_{n}"),
        total.alias(f"bal_sum_{n}"),
        F.try_divide(total, filled).alias(f"bal_avg_{n}"),
    )


