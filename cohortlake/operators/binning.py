"""Continuous variables to monotone bins, and the WoE transform."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake import config as cfg
from cohortlake.functions.quantiles import exact_quantiles
from cohortlake.functions.running import bucketed

PREBINS = 20
MISSING = -1


@dataclass(frozen=True)
class Bin:
    """``[low, high)`` with its counts; the missing bin has no bounds."""

    low: float
    high: float
    n: int
    bads: int
    missing: bool = False

    @property
    def bad_rate(self) -> float:
        return self.bads / self.n

    def plus(self, other: Bin) -> Bin:
        return Bin(min(self.low, other.low), max(self.high, other.high), self.n + other.n, self.bads + other.bads)


@dataclass(frozen=True)
class BinRule:
    max_bins: int = cfg.MAX_N_BINS
    min_share: float = cfg.MIN_BIN_SHARE
    min_bads: int = cfg.MIN_BIN_EVENTS


def quantile_edges(
    df: DataFrame, variables: Sequence[str], bins: int, exact: bool = True
) -> dict[str, list[float]]:
    """Inner edges of equal-frequency bins, duplicates removed; a sketch will do where they get merged."""
    probs = [i / bins for i in range(1, bins)]
    if exact:
        found = exact_quantiles(df, {v: probs for v in variables})
    else:
        found = dict(zip(variables, df.approxQuantile(list(variables), probs, 0.0005)))
    return {v: sorted({e for e in edges if e is not None}) for v, edges in found.items()}


def bin_counts(df: DataFrame, edges: Mapping[str, Sequence[float]], target: str) -> DataFrame:
    """``(variable, bin, n, bads)`` of all variables in one aggregate; NULL is bin -1."""
    placed = df
    for v, inner in edges.items():
        placed = bucketed(placed, v, inner, f"_bin_{v}")
    pairs = F.inline(
        F.array(
            *[
                F.struct(F.lit(v).alias("variable"), F.coalesce(f"_bin_{v}", F.lit(MISSING)).alias("bin"))
                for v in edges
            ]
        )
    )
    return (
        placed.filter(F.col(target).isNotNull())
        .select(pairs, F.col(target).alias("_bad"))
        .groupBy("variable", "bin")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("_bad").alias("bads"))
    )


def fit_bins(
    df: DataFrame, variables: Sequence[str], target: str, rule: BinRule = BinRule(), prebins: int = PREBINS
) -> dict[str, list[Bin]]:
    """Monotone bins per variable: counted on the cluster, merged from at most ``prebins`` rows each.

    ``target`` is 1 for bad. Fit on the training rows only.
    """
    edges = quantile_edges(df, variables, prebins, exact=False)
    counted: dict[str, dict[int, tuple[int, int]]] = {v: {} for v in variables}
    for r in bin_counts(df, edges, target).collect():
        counted[r["variable"]][r["bin"]] = (r["n"], r["bads"])
    out = {}
    for v in variables:
        bounds = [-math.inf, *edges[v], math.inf]
        present = [
            Bin(bounds[i], bounds[i + 1], *counted[v][i]) for i in range(len(bounds) - 1) if i in counted[v]
        ]
        closed = _close_gaps(present)
        missing = [Bin(math.nan, math.nan, *counted[v][MISSING], missing=True)] if MISSING in counted[v] else []
        out[v] = merge_monotone(closed, rule) + missing
    return out


def _close_gaps(bins: list[Bin]) -> list[Bin]:
    """Let neighbours meet where a prebin held no row, so that every value has a bin."""
    lows = [-math.inf, *[b.low for b in bins[1:]]]
    highs = [*lows[1:], math.inf]
    return [Bin(lo, hi, b.n, b.bads) for lo, hi, b in zip(lows, highs, bins)]


def merge_monotone(bins: list[Bin], rule: BinRule = BinRule()) -> list[Bin]:
    """Merge neighbours until sizes, event counts, bin count and a monotone bad rate hold.

    The direction with the smaller loss of bins is kept.
    """
    if not bins:
        return []
    total = sum(b.n for b in bins)
    directions = [_merge_towards(bins, rule, total, sign) for sign in (1, -1)]
    return max(directions, key=lambda d: (len(d), _spread(d)))


def _spread(bins: list[Bin]) -> float:
    return abs(bins[-1].bad_rate - bins[0].bad_rate)


def _merge_towards(bins: list[Bin], rule: BinRule, total: int, sign: int) -> list[Bin]:
    merged: list[Bin] = []
    for b in bins:
        merged.append(b)
        while len(merged) > 1 and sign * (merged[-1].bad_rate - merged[-2].bad_rate) <= 0:
            last = merged.pop()
            merged[-1] = merged[-1].plus(last)
    # Merging neighbours of a monotone sequence keeps it monotone.
    while len(merged) > 1:
        weak = [i for i, b in enumerate(merged) if b.n < rule.min_share * total or b.bads < rule.min_bads]
        if not weak and len(merged) <= rule.max_bins:
            break
        if weak:
            i = min(weak, key=lambda j: merged[j].n)
            near = [j for j in (i - 1, i) if 0 <= j < len(merged) - 1]
        else:
            near = list(range(len(merged) - 1))
        j = min(near, key=lambda k: abs(merged[k].bad_rate - merged[k + 1].bad_rate))
        merged[j : j + 2] = [merged[j].plus(merged[j + 1])]
    return merged


# -- WoE over bins -----------------------------------------------------------------------


def woe_of(bins: Sequence[Bin], smoothing: float = 0.5) -> list[float]:
    """ln(share of goods / share of bads) per bin; smoothing keeps empty classes finite."""
    goods = [b.n - b.bads + smoothing for b in bins]
    bads = [b.bads + smoothing for b in bins]
    return [math.log((g / sum(goods)) / (b / sum(bads))) for g, b in zip(goods, bads)]


def information_value(bins: Sequence[Bin], smoothing: float = 0.5) -> float:
    goods = [b.n - b.bads + smoothing for b in bins]
    bads = [b.bads + smoothing for b in bins]
    pairs = zip(goods, bads, woe_of(bins, smoothing))
    return sum((g / sum(goods) - b / sum(bads)) * w for g, b, w in pairs)


def by_bin(variable: str, bins: Sequence[Bin], values: Sequence[float], unseen: float = 0.0) -> Column:
    """The value of the bin a row falls into: a short literal CASE, no join. NaN is missing, as in ``bin_counts``.

    ``unseen`` is for a missing value that training never saw: it carries no evidence, which is WoE 0.
    """
    c = F.nanvl(F.col(variable).cast("double"), F.lit(None).cast("double"))
    expr = F.when(F.lit(False), F.lit(None).cast("double"))
    for b, value in zip(bins, values):
        if b.missing:
            expr = expr.when(c.isNull(), F.lit(float(value)))
        else:
            low = F.lit(True) if b.low == -math.inf else c >= F.lit(b.low)
            high = F.lit(True) if b.high == math.inf else c < F.lit(b.high)
            expr = expr.when(c.isNotNull() & low & high, F.lit(float(value)))
    return F.coalesce(expr, F.lit(float(unseen)))


def woe_transform(df: DataFrame, fitted: Mapping[str, Sequence[Bin]], suffix: str = "_woe") -> DataFrame:
    return df.withColumns({f"{v}{suffix}": by_bin(v, bins, woe_of(bins)) for v, bins in fitted.items()})


def iv_band(iv: Column | str) -> Column:
    """Strength of an information value; above the alarm level it is suspected leakage."""
    c = F.col(iv) if isinstance(iv, str) else iv
    return (
        F.when(c < cfg.IV_DROP_BELOW, "drop")
        .when(c < 0.10, "weak")
        .when(c < 0.30, "medium")
        .when(c <= cfg.IV_LEAKAGE_ALARM, "strong")
        .otherwise("investigate")
    )


def bin_table(spark, fitted: Mapping[str, Sequence[Bin]]) -> DataFrame:
    rows = []
    for v, bins in fitted.items():
        iv = information_value(bins)
        for i, (b, w) in enumerate(zip(bins, woe_of(bins))):
            low, high = (None, None) if b.missing else (b.low, b.high)
            rows.append((v, i, low, high, b.missing, b.n, b.bads, b.bad_rate, w, iv))
    ddl = (
        "variable string, bin int, low double, high double, is_missing boolean, n bigint, bads bigint, "
        "bad_rate double, woe double, iv double"
    )
    return spark.createDataFrame(rows, ddl).withColumn("band", iv_band("iv"))
