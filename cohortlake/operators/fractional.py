"""Logistic regression of a target anywhere in [0, 1], by Newton steps of one pass each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.functions.gram import gram

_LEAST_WEIGHT = 1e-300
#: Sums over many like rows are known to a share of about 1e-11; no smaller change of the loss is taken for one.
_ROUNDING = 1e-9


def log_odds(intercept: float, coefficients: Mapping[str, float]) -> Column:
    return sum((F.lit(b) * F.col(f"`{f}`") for f, b in coefficients.items()), F.lit(float(intercept)))


def mean_of(eta: Column) -> Column:
    """The logistic function, without overflow for large negative log odds."""
    e = F.exp(-F.abs(eta))
    return F.when(eta >= 0, 1 / (1 + e)).otherwise(e / (1 + e))


@dataclass(frozen=True)
class Moments:
    """What one pass over the data says at given coefficients: loss, score equations and information of ``terms``."""

    terms: tuple[str, ...]
    loss: float
    score: np.ndarray
    information: np.ndarray

    def of(self, terms: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        at = [self.terms.index(t) for t in terms]
        return self.score[at], self.information[np.ix_(at, at)]

    def only(self, terms: Sequence[str]) -> Moments:
        return Moments(tuple(terms), self.loss, *self.of(terms))

    @property
    def left(self) -> float:
        """The largest score, each against the square root of its information."""
        return float(np.max(np.abs(self.score) / np.sqrt(np.diag(self.information) + 1)))


#: The intercept among the terms.
ONE = "(intercept)"


def moments(df: DataFrame, terms: Sequence[str], target: str, eta: Column, weight: str | None = None) -> Moments:
    """Loss, score and information of the terms, also of terms that ``eta`` does not use, in one pass."""
    y, w = F.col(f"`{target}`").cast("double"), F.lit(1.0) if weight is None else F.col(f"`{weight}`").cast("double")
    # One projection after the other, so that each of these is worked out once a row.
    at = df.select("*", eta.alias("_eta")).select("*", F.exp(-F.abs("_eta")).alias("_e"))
    at = at.select("*", F.when(F.col("_eta") >= 0, 1 / (1 + F.col("_e"))).otherwise(F.col("_e") / (1 + F.col("_e"))).alias("_p"))
    p = F.col("_p")
    at = at.select("*", F.sqrt(F.greatest(w * p * (1 - p), F.lit(_LEAST_WEIGHT))).alias("_root"))
    root = F.col("_root")
    loss = w * (F.greatest(F.col("_eta"), F.lit(0.0)) - y * F.col("_eta") + F.log1p("_e"))
    x = [F.lit(1.0) if t == ONE else F.col(f"`{t}`").cast("double") for t in terms]
    outside = F.when((y < 0) | (y > 1) | (w < 0), 1.0).otherwise(0.0)
    sums = gram(at, [*[root * c for c in x], w * (y - p) / root, F.sqrt(F.greatest(loss, F.lit(0.0))), outside])
    if sums[-1, -1]:
        raise ValueError(f"{int(sums[-1, -1])} rows have a target outside [0, 1] or a negative weight")
    n = len(terms)
    return Moments(tuple(terms), float(sums[n + 1, n + 1]), sums[:n, n], sums[:n, :n])


def solve(information: np.ndarray, score: np.ndarray) -> np.ndarray:
    """The Newton step, on terms brought to one scale; terms without information, or repeating others, do not move."""
    scale = np.sqrt(np.diag(information))
    scale[scale == 0] = 1.0
    return np.linalg.lstsq(information / np.outer(scale, scale), score / scale, rcond=1e-12)[0] / scale


@dataclass(frozen=True)
class FractionalFit:
    features: tuple[str, ...]
    intercept: float
    coefficients: dict[str, float]
    loss: float
    score: tuple[float, ...]
    information: np.ndarray
    spread: np.ndarray | None
    steps: int
    converged: bool

    @cached_property
    def log_odds(self) -> Column:
        return log_odds(self.intercept, self.coefficients)

    def mean(self) -> Column:
        return mean_of(log_odds(self.intercept, self.coefficients))

    @property
    def aic(self) -> float:
        return 2 * self.loss + 2 * (len(self.features) + 1)

    @property
    def robust_errors(self) -> dict[str, float]:
        """Standard errors that do not assume a 0/1 target: the information around the squared residuals (sandwich)."""
        inverse = np.linalg.pinv(self.information)
        errors = np.sqrt(np.diag(inverse @ self.spread @ inverse))
        return dict(zip((ONE, *self.features), errors.tolist()))


def fit_fractional(
    df: DataFrame, features: Sequence[str], target: str, weight: str | None = None, tolerance: float = 1e-10, max_steps: int = 60,
    start: tuple[Mapping[str, float], Moments] | None = None, robust: bool = True,
) -> FractionalFit:
    """Coefficients at which the score equations are zero, with robust errors.

    Each step is one pass that sums products of columns; only those sums reach the driver. A step that raises the loss by
    more than rounding can is halved. Rows without a target are left out; a missing feature or weight is an error, as is a
    target outside [0, 1]. Under complete separation the coefficients have no end: the steps stop at ``max_steps`` and
    ``converged`` is false. ``start`` are coefficients (absent terms are zero) and the moments already known there.
    Without ``robust`` the pass for the robust errors is left out.
    """
    known = df.where(F.col(f"`{target}`").isNotNull())
    terms = (ONE, *features)

    def at(b: np.ndarray) -> Column:
        return log_odds(b[0], dict(zip(features, b[1:].tolist())))

    if start is None:
        beta = np.zeros(len(terms))
        here = moments(known, terms, target, at(beta), weight)
    else:
        beta, here = np.array([start[0].get(t, 0.0) for t in terms]), start[1].only(terms)
    steps, converged = 0, False
    while steps < max_steps:
        if here.left <= tolerance * max(np.sqrt(here.loss), 1.0):
            converged = True
            break
        step = solve(here.information, here.score)
        for _ in range(30):
            there = moments(known, terms, target, at(beta + step), weight)
            steps += 1
            rise, nearer = there.loss - here.loss, there.left < here.left
            if rise <= here.loss * (_ROUNDING if nearer else 1e-12) + 1e-12:
                break
            step = step / 2
        if not nearer and rise >= -_ROUNDING * here.loss:  # rounding is all that is left to remove
            converged = bool(np.abs(here.score).max() <= 1e-6 * max(1.0, here.loss))
            break
        beta, here = beta + step, there
    fit = FractionalFit(
        tuple(features), float(beta[0]), dict(zip(features, beta[1:].tolist())), here.loss, tuple(here.score.tolist()),
        here.information, None, steps, converged,
    )
    return with_spread(fit, df, target, weight) if robust else fit


def with_spread(fit: FractionalFit, df: DataFrame, target: str, weight: str | None = None) -> FractionalFit:
    """The fit with the squares of its residuals, which robust errors need, in one pass."""
    known = df.where(F.col(f"`{target}`").isNotNull()).select("*", log_odds(fit.intercept, fit.coefficients).alias("_eta"))
    w = F.lit(1.0) if weight is None else F.col(f"`{weight}`").cast("double")
    known = known.select("*", (w * (F.col(f"`{target}`") - mean_of(F.col("_eta")))).alias("_left"))
    return replace(fit, spread=gram(known, [F.col("_left"), *[F.col("_left") * F.col(f"`{f}`") for f in fit.features]]))
