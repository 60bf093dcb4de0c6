"""Log-odds to score points, the points table and reason codes."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake import config as cfg
from cohortlake.operators.binning import Bin, by_bin, woe_of


@dataclass(frozen=True)
class Scale:
    """``base_score`` at ``base_odds`` good to bad; ``pdo`` points double the odds."""

    pdo: float = cfg.PDO
    base_score: float = cfg.BASE_SCORE
    base_odds: float = cfg.BASE_ODDS

    @property
    def factor(self) -> float:
        return self.pdo / math.log(2)

    @property
    def offset(self) -> float:
        return self.base_score - self.factor * math.log(self.base_odds)


def score_of_pd(pd: Column | str, scale: Scale = Scale()) -> Column:
    """Score of a probability of default strictly between 0 and 1; NULL outside."""
    p = F.col(pd) if isinstance(pd, str) else pd
    odds = F.when((p > 0) & (p < 1), (1 - p) / p)
    return F.lit(scale.offset) + F.lit(scale.factor) * F.log(odds)


def pd_of_score(score: Column | str, scale: Scale = Scale()) -> Column:
    s = F.col(score) if isinstance(score, str) else score
    return 1 / (1 + F.exp((s - F.lit(scale.offset)) / F.lit(scale.factor)))


def points(
    fitted: Mapping[str, Sequence[Bin]], coefficients: Mapping[str, float], intercept: float, scale: Scale = Scale()
) -> dict[str, list[float]]:
    """Points per variable and bin; a model of the bad log-odds on WoE has negative coefficients."""
    share = intercept / len(coefficients)
    return {
        v: [-(b * w + share) * scale.factor + scale.offset / len(coefficients) for w in woe_of(fitted[v])]
        for v, b in coefficients.items()
    }


def neutral_points(bins: Sequence[Bin], values: Sequence[float]) -> float:
    """Points at WoE 0: points are linear in WoE, so two bins of different WoE give the line."""
    pairs = sorted(zip(woe_of(bins), values))
    (w0, p0), (w1, p1) = pairs[0], pairs[-1]
    return p0 if w0 == w1 else p0 - w0 * (p1 - p0) / (w1 - w0)


def with_points(df: DataFrame, fitted: Mapping[str, Sequence[Bin]], table: Mapping[str, Sequence[float]]) -> DataFrame:
    """``<variable>_points`` per variable and their sum ``score``; a missing value unseen in training has the points of WoE 0."""
    given = {f"{v}_points": by_bin(v, fitted[v], values, neutral_points(fitted[v], values)) for v, values in table.items()}
    scored = df.withColumns(given)
    total = sum((F.col(c) for c in given), F.lit(0.0))
    return scored.withColumn("score", total)


def reason_codes(df: DataFrame, best: Mapping[str, float], top: int = 3, name: str = "reasons") -> DataFrame:
    """The ``top`` variables furthest below their best attainable points, worst first."""
    gaps = F.array(
        *[
            F.struct((F.col(f"{v}_points") - F.lit(float(b))).alias("gap"), F.lit(v).alias("variable"))
            for v, b in best.items()
        ]
    )
    short = F.filter(F.array_sort(gaps), lambda g: g["gap"] < 0)
    return df.withColumn(name, F.transform(F.slice(short, 1, top), lambda g: g["variable"]))


def sign_check(coefficients: Mapping[str, float]) -> list[str]:
    """Variables whose coefficient has the other sign than most of the weight."""
    main = sum(math.copysign(1, b) for b in coefficients.values())
    return [v for v, b in coefficients.items() if b * main < 0]
