"""An order of rows in which every one of several columns stays together in files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_number(column: str, kind: T.DataType) -> Column:
    """A double that keeps the column's order: of text by its first six bytes, of days and instants by their count."""
    c = F.col(f"`{column}`")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    return c.cast("double")


def rank_cuts(df: DataFrame, columns: Sequence[str], bits: int) -> dict[str, list[float]]:
    """Values that cut each column into ``2 ** bits`` parts of like size; one sketch pass. A frequent value is cut repeatedly,
    so that it takes up as many parts as its rows would. The cuts only shape the layout; sketched ones do.
    """
    numbers = df.select(*[as_number(c, df.schema[c].dataType).alias(f"k{i}") for i, c in enumerate(columns)])
    parts = 1 << bits
    found = numbers.approxQuantile(numbers.columns, [i / parts for i in range(1, parts)], 0.25 / parts)
    return {c: sorted(cuts) for c, cuts in zip(columns, found)}


def part_of(v: Column, cuts: Sequence[float]) -> Column:
    """How many cuts are at or below the value, by halving; NULL is in the first part, NaN in the last."""

    def within(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(v >= cuts[mid], within(mid + 1, hi)).otherwise(within(lo, mid))

    return F.when(v.isNull(), 0).otherwise(within(0, len(cuts)))


def interleaved(df: DataFrame, columns: Sequence[str], bits: int = 6) -> Column:
    """The columns' parts as one number that takes a bit of each in turn, highest first (a Z-order curve).

    Ranks and not values are cut, so a skewed column is divided as finely as an even one.
    """
    if bits * len(columns) > 62:
        raise ValueError(f"{len(columns)} columns of {bits} bits do not fit into a long")
    cuts = rank_cuts(df, columns, bits)
    key = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        part = part_of(as_number(c, df.schema[c].dataType), cuts[c]).cast("long")
        for b in range(bits):
            bit = F.shiftright(part, b).bitwiseAND(F.lit(1).cast("long"))
            key = key.bitwiseOR(F.shiftleft(bit, b * len(columns) + len(columns) - 1 - i))
    return key
