"""Loss given default and exposure at default, modelled row by row.

A recovery rate has a point mass at zero and one at one, so loss is fitted in two stages: whether anything comes back,
and how much of it if so, both by logistic regression, the second of a share. Exposure is fitted as a share of the limit
up to a cap above one, since the textbook conversion factor explodes where balances are near their limits.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake import config as cfg
from cohortlake.functions import columns as fx
from cohortlake.operators.fractional import FractionalFit, fit_fractional


def _complete(features: Sequence[str]) -> Column:
    """Whether a row has every feature, as numbers."""
    known = F.lit(True)
    for f in features:
        c = F.col(f"`{f}`")
        known = known & c.isNotNull() & ~F.isnan(c.cast("double"))
    return known


@dataclass(frozen=True)
class LossModel:
    """``P(recovery > 0)`` and ``E[recovery | recovery > 0]``; the loss is one minus their product."""

    any_recovery: FractionalFit
    recovery_if_any: FractionalFit

    def score(self, df: DataFrame, observable: Column | None = None, fallback: float = cfg.LGD_FALLBACK) -> DataFrame:
        """Every row with ``p_recovery, recovery_if_any, lgd, is_modelled``.

        Rows that lack a feature, or for which ``observable`` does not hold (products without balances), take the stated
        constant and are marked as not modelled.
        """
        features = dict.fromkeys([*self.any_recovery.features, *self.recovery_if_any.features])
        modelled = _complete(list(features)) if observable is None else _complete(list(features)) & F.coalesce(observable, F.lit(False))
        p, share = F.when(modelled, self.any_recovery.mean()), F.when(modelled, self.recovery_if_any.mean())
        own = ["p_recovery", "recovery_if_any", "lgd", "is_modelled"]
        return df.drop(*own).select(
            "*", p.alias(own[0]), share.alias(own[1]), F.coalesce(1 - p * share, F.lit(fallback)).alias(own[2]), modelled.alias(own[3])
        )


def fit_loss(df: DataFrame, features: Sequence[str], recovery: str = "recovery_rate", second: Sequence[str] | None = None) -> LossModel:
    """Both stages on the rows whose workout is fully observed (``recovery`` is not NULL) and that have every feature.

    ``second`` are the features of the amount, by default those of the event. Without a single recovery there is no
    second stage to fit, which is an error.
    """
    second = list(features if second is None else second)
    known = df.where(F.col(f"`{recovery}`").isNotNull() & _complete([*features, *second])).withColumn(
        "_any", (F.col(f"`{recovery}`") > 0).cast("double")
    )
    some = known.where("_any = 1")
    if some.isEmpty():
        raise ValueError("nothing was recovered: the amount cannot be fitted")
    return LossModel(fit_fractional(known, features, "_any"), fit_fractional(some, second, recovery))


@dataclass(frozen=True)
class ExposureModel:
    """Share of the limit that is drawn at default, between 0 and ``cap``."""

    share: FractionalFit
    cap: float

    def score(self, df: DataFrame, limit: str, outstanding: str, undrawn: str | None = None) -> DataFrame:
        """Every row with ``ead_ratio, ead, is_ead_modelled``.

        Rows without a positive limit or a feature take the outstanding balance, and of ``undrawn``, if given, the flat
        conversion factor; their ratio is NULL.
        """
        modelled = _complete(self.share.features) & F.coalesce(F.col(f"`{limit}`") > 0, F.lit(False))
        ratio = F.when(modelled, self.cap * self.share.mean())
        flat = F.coalesce(F.col(f"`{outstanding}`").cast("double"), F.lit(0.0))
        if undrawn is not None:
            flat = flat + F.lit(cfg.CCF_FALLBACK) * F.coalesce(F.col(f"`{undrawn}`").cast("double"), F.lit(0.0))
        own = ["ead_ratio", "ead", "is_ead_modelled"]
        return df.drop(*own).select(
            "*", ratio.alias(own[0]), F.coalesce(ratio * F.col(f"`{limit}`"), flat).alias(own[1]), modelled.alias(own[2])
        )


def fit_exposure(
    df: DataFrame, features: Sequence[str], balance_at_default: str, limit: str, cap: float = cfg.EAD_RATIO_CAP
) -> ExposureModel:
    """The share ``balance_at_default / limit``, cut at ``cap``, on rows with a positive limit and every feature."""
    ratio = fx.clip(fx.safe_ratio(F.col(f"`{balance_at_default}`"), F.col(f"`{limit}`")), 0.0, cap)
    known = df.where((F.col(f"`{limit}`") > 0) & F.col(f"`{balance_at_default}`").isNotNull() & _complete(features))
    return ExposureModel(fit_fractional(known.withColumn("_share", ratio / cap), features, "_share"), cap)


def terms_table(spark, fits: dict[str, FractionalFit]) -> DataFrame:
    """One row per model and term: estimate, robust error, and what its score equation leaves."""
    rows = []
    for name, fit in fits.items():
        estimates = {"(intercept)": fit.intercept, **fit.coefficients}
        errors = fit.robust_errors
        rows += [(name, t, float(b), errors[t], float(s)) for (t, b), s in zip(estimates.items(), fit.score)]
    return spark.createDataFrame(rows, "model string, term string, estimate double, robust_error double, score_left double")
