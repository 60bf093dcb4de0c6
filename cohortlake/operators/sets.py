"""Set differences: values or rows present on one side only."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def values_missing(left: DataFrame, right: DataFrame, column: str, right_column: str | None = None) -> DataFrame:
    """Distinct values of ``left`` that never occur in ``right``.

    Both sides are made distinct first: the anti join then meets every value once.
    """
    other = right.select(F.col(right_column or column).alias(column)).distinct()
    return left.select(column).distinct().join(other, column, "left_anti")


def values_outside(df: DataFrame, column: str, known: Iterable[str]) -> DataFrame:
    """Distinct non-NULL values not in a fixed list."""
    return df.filter(~F.col(column).isin(*known)).select(column).distinct()


def deduplicate(df: DataFrame, keys: list[str], keep: str, *tie_breakers: str) -> DataFrame:
    """One row per key: the one with the largest ``keep``, then the largest tie breakers.

    ``max_by`` pre-aggregates on the map side, so a key repeated very often is not sorted in
    one task as a row-number window would.
    """
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(*[F.col(c) for c in (keep, *tie_breakers)])
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)
