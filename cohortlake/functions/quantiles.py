"""Exact quantiles by narrowing the range that holds each rank, a counted histogram at a time.

A pass counts the rows per cell of the axis and keeps each cell's least and greatest value. The cells that hold the wanted
ranks become the next, narrower ranges. Cells are first steps of the logarithm, then equal parts of a range, and single
values once few rows are left; a cell of one value, however frequent, is settled by its count. All columns and ranks share
a pass, and the driver sees a bounded number of cells, never rows.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells for each step of the natural logarithm, for each later range, and the rows of a range that are told apart by value.
STEPS = 32
PARTS = 2048
FEW = 5_000


@dataclass(frozen=True)
class Cell:
    """Rows of one column between two values that both occur; ``before`` rows of the column are smaller."""

    column: int
    low: float
    high: float
    before: int
    n: int

    @property
    def settled(self) -> bool:
        return self.low == self.high or math.isnan(self.low)

    @property
    def by_value(self) -> bool:
        width = self.high / 2 - self.low / 2
        return self.n <= FEW or width == 0 or math.isinf(width)


def _log_cell(v: Column) -> Column:
    """A number that never falls as the value grows: NaN above infinity above all numbers, zero between the signs."""
    size = F.when(F.abs(v) == float("inf"), 30_000).otherwise(F.floor(F.log(F.abs(v)) * STEPS) + 25_000 - 1)
    return F.when(F.isnan(v), 40_000).when(v == 0, 0).when(v > 0, size).otherwise(-size).cast("double")


def _part(v: Column, cell: Cell) -> Column:
    if cell.by_value:
        return v
    low, width = cell.low / 2, cell.high / 2 - cell.low / 2
    return F.floor((v / 2 - F.lit(low)) / F.lit(width) * PARTS).cast("double")


def _counted(rows: DataFrame) -> list[list]:
    found = rows.groupBy("i", "cell").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()
    return sorted([[r["i"], r["cell"], r["n"], r["low"], r["high"]] for r in found], key=lambda r: (r[0], r[1]))


def _first_cells(df: DataFrame, columns: Sequence[str]) -> dict[int, list[Cell]]:
    values = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").cast("double").alias("v")) for i, c in enumerate(columns)])
    rows = df.select(F.inline(values)).where("v IS NOT NULL").select("i", "v", _log_cell(F.col("v")).alias("cell"))
    out: dict[int, list[Cell]] = {}
    for i, _, n, low, high in _counted(rows):
        cells = out.setdefault(i, [])
        cells.append(Cell(i, low, high, cells[-1].before + cells[-1].n if cells else 0, n))
    return out


def _narrower(df: DataFrame, columns: Sequence[str], wide: Sequence[Cell]) -> dict[Cell, list[Cell]]:
    # The ranges of a column do not overlap: a value is in one of them at most.
    per_column = []
    for i in sorted({c.column for c in wide}):
        v, which, cell = F.col(f"`{columns[i]}`").cast("double"), F.lit(None).cast("int"), F.lit(None).cast("double")
        for k, c in enumerate(wide):
            if c.column == i:
                inside = v.between(c.low, c.high)
                which, cell = F.when(inside, k).otherwise(which), F.when(inside, _part(v, c)).otherwise(cell)
        per_column.append(F.struct(which.alias("i"), v.alias("v"), cell.alias("cell")))
    rows = df.select(F.inline(F.array(*per_column))).where("i IS NOT NULL")
    out: dict[Cell, list[Cell]] = {}
    for k, _, n, low, high in _counted(rows):
        cells = out.setdefault(wide[k], [])
        before = cells[-1].before + cells[-1].n if cells else wide[k].before
        cells.append(Cell(wide[k].column, low, high, before, n))
    return out


def _holding(cells: Sequence[Cell], rank: int) -> Cell:
    ends = list(accumulate([c.n for c in cells], initial=cells[0].before))[1:]
    return cells[bisect_right(ends, rank)]


def exact_quantiles(df: DataFrame, wanted: Mapping[str, Sequence[float]]) -> dict[str, list[float | None]]:
    """Linear-interpolation quantiles per column, computed exactly; NULL is left out, NaN is above all numbers.

    An empty column gives ``None``. Values next to each other in a cell stay in order from cell to cell, so a rank is
    always found; the passes end when each wanted rank's cell holds one value.
    """
    columns = list(wanted)
    first = _first_cells(df, columns)
    ranks = {}
    for i, c in enumerate(columns):
        n = sum(cell.n for cell in first.get(i, ()))
        for p in wanted[c] if n else ():
            at = (n - 1) * p
            ranks |= {(i, math.floor(at)): None, (i, math.ceil(at)): None}
    held = {key: _holding(first[key[0]], key[1]) for key in ranks}
    while wide := sorted({c for c in held.values() if not c.settled}, key=lambda c: (c.column, c.before)):
        found = _narrower(df, columns, wide)
        held = {key: c if c.settled else _holding(found[c], key[1]) for key, c in held.items()}

    def quantile(i: int, p: float) -> float | None:
        n = sum(cell.n for cell in first.get(i, ()))
        if not n:
            return None
        at = (n - 1) * p
        a, b = held[i, math.floor(at)].low, held[i, math.ceil(at)].low
        return a if a == b else a + (at - math.floor(at)) * (b - a)

    return {c: [quantile(i, p) for p in wanted[c]] for i, c in enumerate(columns)}
