"""Raw-to-clean operators: sentinels, capping, decoding, payment and loan-field derivations.

All are narrow projections; the only aggregates are the scalars a threshold or fill needs.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake import config as cfg
from cohortlake.functions import columns as fx
from cohortlake.functions.quantiles import exact_quantiles

# Indicator names that carry a business meaning.
INDICATOR_NAMES = {"DAYS_EMPLOYED": "is_not_employed", "DAYS_FIRST_DRAWING": "never_drawn"}
CAP_RULES = {"AMT_INCOME_TOTAL": cfg.CAP_PERCENTILE}
NARROW_PREFIX = "DAYS_"


# -- sentinels --------------------------------------------------------------


def needs_indicator(hits: int, n_rows: int, min_share: float = cfg.INDICATOR_MIN_SHARE) -> bool:
    return n_rows > 0 and hits >= min_share * n_rows


def indicator_name(column: str, names: Mapping[str, str] = INDICATOR_NAMES) -> str:
    return names.get(column) or column.lower() + "_is_missing"


def sentinel_columns(findings: DataFrame, table: str | None = None) -> dict[str, dict[str, int]]:
    """``{table: {column: hits}}`` out of a sentinel-scan report (one row per dirty column)."""
    dirty = findings.filter((F.col("check") == "days-sentinel") & F.col("column_name").isNotNull())
    if table is not None:
        dirty = dirty.filter(F.col("target") == table)
    out: dict[str, dict[str, int]] = {}
    for row in dirty.select("target", "column_name", "n_bad").collect():
        out.setdefault(row["target"], {})[row["column_name"]] = row["n_bad"]
    return out


def scrub_sentinels(
    df: DataFrame,
    hits: Mapping[str, int],
    n_rows: int,
    sentinel: float = cfg.DAYS_SENTINEL,
    min_share: float = cfg.INDICATOR_MIN_SHARE,
) -> tuple[DataFrame, list[str]]:
    """Blank the sentinel in the reported columns; flag it where it is frequent.

    The flag is taken from the unscrubbed value, so a NULL source gives a NULL flag.
    """
    present = [c for c in hits if c in df.columns]
    flagged = [c for c in present if needs_indicator(hits[c], n_rows, min_share)]
    flags = {indicator_name(c): F.col(c) == F.lit(sentinel) for c in flagged}
    scrubbed = {c: fx.null_if(c, sentinel) for c in present}
    # One projection: flags read the original columns.
    return df.withColumns({**flags, **scrubbed}), list(flags)


def narrow_days_to_int(df: DataFrame, prefix: str = NARROW_PREFIX) -> DataFrame:
    doubles = [
        f.name for f in df.schema.fields if f.name.startswith(prefix) and isinstance(f.dataType, T.DoubleType)
    ]
    return df.withColumns({c: F.col(c).cast("int") for c in doubles})


def cap_outliers(
    df: DataFrame,
    rules: Mapping[str, float] = CAP_RULES,
    exact: bool = False,
    relative_error: float = 0.001,
    null_becomes_cap: bool = False,
) -> tuple[DataFrame, dict[str, float]]:
    """Cap each column at its percentile and add ``<column>_was_capped``.

    NULL stays NULL; ``null_becomes_cap`` reproduces a bare ``least(value, cap)``.
    """
    present = {c: p for c, p in rules.items() if c in df.columns}
    if exact:
        caps = {c: q[0] for c, q in exact_quantiles(df, {c: [p] for c, p in present.items()}).items()}
    else:
        caps = {c: (df.approxQuantile(c, [p], relative_error) or [None])[0] for c, p in present.items()}
    caps = {c: t for c, t in caps.items() if t is not None}

    def capped(c: str) -> Column:
        cap = F.lit(caps[c])
        if null_becomes_cap:
            return F.least(F.col(c), cap)
        return F.when(F.col(c) > cap, cap).otherwise(F.col(c))

    flags = {f"{c.lower()}_was_capped": F.col(c) > F.lit(t) for c, t in caps.items()}
    return df.withColumns({**flags, **{c: capped(c) for c in caps}}), caps


# -- status panel -----------------------------------------------------------

DELINQUENT_FROM = 1
NINETY_PLUS_FROM = 4
STATUS_MONTH_SHIFT = 1


def decode_status_panel(
    df: DataFrame, status: str = "STATUS", month: str = "MONTHS_BALANCE", shift: int = STATUS_MONTH_SHIFT
) -> DataFrame:
    """Bucket, aligned month and flags of a status-coded monthly panel.

    Month 0 of the status panel is month -1 of the account panels, hence the shift.
    """
    code = fx.normalised_status(status)
    bucket = fx.status_bucket(status)
    return df.withColumns(
        {
            "status_bucket": bucket,
            f"{month.lower()}_aligned": align_month(F.col(month), shift),
            "is_closed": code == "C",
            "is_status_unknown": code == "X",
            "is_delinquent": bucket >= DELINQUENT_FROM,
            "is_90_plus": bucket >= NINETY_PLUS_FROM,
        }
    )


def align_month(month: Column, shift: int = STATUS_MONTH_SHIFT) -> Column:
    return month - F.lit(shift)


# -- payments ---------------------------------------------------------------

SHORT_PAYMENT_TOLERANCE = 0.99


def derive_payments(df: DataFrame, cols: cfg.PaymentColumns = cfg.PaymentColumns()) -> DataFrame:
    due, paid = F.col(cols.due_day), F.col(cols.paid_day)
    owed, got = F.col(cols.amount_due), F.col(cols.amount_paid)
    return df.withColumns(
        {
            cols.days_late: paid - due,
            cols.is_late: paid > due,
            cols.shortfall: owed - got,
            cols.is_short: got < owed * F.lit(SHORT_PAYMENT_TOLERANCE),
        }
    )


# -- fills ------------------------------------------------------------------


def fill_from(df: DataFrame, column: str, other: str) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), F.col(other)))


def fill_with_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL -> column mean. The means are scalar subqueries, evaluated once and distributed."""
    return df.withColumns(
        {c: F.coalesce(F.col(c), df.select(F.avg(c)).scalar()) for c in columns}
    )


def fill_with_zero(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.fillna(0, subset=list(columns))


def negatives_to_max(df: DataFrame, column: str) -> DataFrame:
    """Replace negative values by the column maximum (repairs a wrong-century parse)."""
    c = F.col(column)
    return df.withColumn(column, F.when(c < 0, df.select(F.max(column)).scalar()).otherwise(c))


def null_mask(df: DataFrame) -> DataFrame:
    return df.select([F.col(c).isNull().alias(c) for c in df.columns])


def subset(df: DataFrame, columns: Sequence[str], predicate: Column) -> DataFrame:
    return df.filter(predicate).select(*columns)
