"""Column expressions: parsers, decoders, guarded arithmetic and hashes.

Every function takes and returns a ``Column`` built from Spark SQL expressions.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

MEAN_MONTH_DAYS = 30.436875


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# -- guarded arithmetic -----------------------------------------------------


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """``numerator / denominator`` with NULL for a zero denominator."""
    return F.try_divide(as_col(numerator), as_col(denominator))


def clip(value: Column | str, low: float, high: float) -> Column:
    """Bound to ``[low, high]``; NULL stays NULL (``least`` alone would skip it)."""
    c = as_col(value)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def marginal_slope(y: Column, x: Column) -> Column:
    """Covariance over pairs divided by the variance of *all* x, paired or not."""
    return F.try_divide(F.covar_pop(x, y), F.var_pop(x))


def pairwise_slope(y: Column, x: Column) -> Column:
    """Least-squares slope over the pairs where both sides are present."""
    return F.regr_slope(y, x)


# -- sentinels and statuses -------------------------------------------------

# Status code to delinquency bucket; X (unknown) decodes to NULL.
STATUS_BUCKETS = {"C": 0, "X": None, "0": 0, "1": 1, "2": 2, "3": 3, "4": 4, "5": 5}


def normalised_status(status: Column | str) -> Column:
    return F.upper(F.trim(as_col(status)))


def lookup(key: Column, mapping: Mapping[str, int | None]) -> Column:
    """Integer lookup through a literal map; unknown keys give NULL."""
    entries = chain.from_iterable((F.lit(k), F.lit(v).cast("int")) for k, v in mapping.items())
    return F.try_element_at(F.create_map(*entries), key)


def status_bucket(status: Column | str) -> Column:
    return lookup(normalised_status(status), STATUS_BUCKETS)


def null_if(value: Column | str, sentinel: float) -> Column:
    c = as_col(value)
    return F.when(c == F.lit(sentinel), F.lit(None)).otherwise(c)


# -- string scalars ---------------------------------------------------------


def employment_years(text: Column | str) -> Column:
    """'10+ years' -> 10, '1 year' -> 1, '< 1 year' and 'n/a' -> 0, other text -> NULL."""
    c = F.trim(as_col(text))
    digits = F.regexp_replace(c, r"\+? years?$", "")
    return F.when(c.isin("< 1 year", "n/a"), F.lit(0)).otherwise(digits.try_cast("int"))


def term_months(text: Column | str) -> Column:
    """' 36 months' -> 36."""
    return F.trim(F.regexp_replace(as_col(text), " months", "")).try_cast("int")


MONTH_NAMES = "janfebmaraprmayjunjulaugsepoctnovdec"


def parse_month_year(text: Column | str, pivot: int = 69) -> Column:
    """First day of a 'Mon-YY' or 'Mon-YYYY' month; anything else gives NULL.

    Two-digit years from ``pivot`` upward belong to the 1900s, lower ones to the 2000s.
    """
    c = F.trim(as_col(text))
    at = F.instr(F.lit(MONTH_NAMES), F.lower(F.substring(c, 1, 3)))
    well_formed = c.rlike(r"^[A-Za-z]{3}-([0-9]{2}|[0-9]{4})$") & (at % 3 == 1)
    digits = F.regexp_extract(c, "([0-9]+)$", 1).try_cast("int")
    short_year = F.when(digits >= pivot, digits + 1900).otherwise(digits + 2000)
    year = F.when(F.length(c) == 6, short_year).otherwise(digits)
    return F.when(well_formed, F.make_date(year, ((at + 2) / 3).cast("int"), F.lit(1)))


def months_since(day: Column | str, as_of: str = "2017-12-01") -> Column:
    """Whole months from ``day`` to ``as_of``, rounded half to even."""
    elapsed = F.datediff(F.lit(as_of).cast("date"), as_col(day))
    return F.bround(elapsed / F.lit(MEAN_MONTH_DAYS), 0)


# -- hashes -----------------------------------------------------------------


def row_hash(columns: Iterable[str]) -> Column:
    """SHA-256 over the columns as text; NULL is spelled out so its position counts."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns]
    return F.sha2(F.concat_ws("||", *parts), 256)


def hash_bucket(key: Column | str, seed: int | str, buckets: int) -> Column:
    """Reproducible bucket in ``[0, buckets)``; any engine with MD5 can recompute it."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), as_col(key).cast("string")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.lit(buckets)).cast("int")
