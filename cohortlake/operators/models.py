"""Logistic scorecard and challenger on Spark ML, with the selection statistics around them."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake import config as cfg
from cohortlake.operators.fractional import ONE, FractionalFit, Moments, fit_fractional, log_odds, moments, with_spread


#: Where trees see a missing value: below every other, so that it can have a branch of its own.
MISSING_VALUE = -1.0e30


def _vectors(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """For linear statistics: a missing value is an error, as leaving rows out would go unseen. Transform to WoE first."""
    return VectorAssembler(inputCols=list(features), outputCol="_x", handleInvalid="error").transform(df)


def tree_vectors(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """For trees: every row, NULL and NaN as a value below all others."""
    filled = {}
    for i, f in enumerate(features):
        c = F.col(f"`{f}`").cast("double")
        filled[f"_f{i}"] = F.when(c.isNull() | F.isnan(c), F.lit(MISSING_VALUE)).otherwise(c)
    assembler = VectorAssembler(inputCols=list(filled), outputCol="_x", handleInvalid="error")
    return assembler.transform(df.withColumns(filled)).drop(*filled)


def correlation_matrix(df: DataFrame, features: Sequence[str]) -> np.ndarray:
    """Pearson matrix: the Gram matrix is summed on the executors, p x p numbers come back."""
    return Correlation.corr(_vectors(df, features).select("_x"), "_x").first()[0].toArray()


def correlated_pairs(df: DataFrame, features: Sequence[str], above: float = 0.70) -> list[tuple[str, str, float]]:
    matrix = correlation_matrix(df, features)
    return [
        (features[i], features[j], float(matrix[i, j]))
        for i in range(len(features))
        for j in range(i)
        if abs(matrix[i, j]) > above
    ]


def variance_inflation(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Diagonal of the inverse correlation matrix."""
    inverse = np.linalg.pinv(correlation_matrix(df, features))
    return {f: float(inverse[i, i]) for i, f in enumerate(features)}


@dataclass(frozen=True)
class LogisticFit:
    features: tuple[str, ...]
    intercept: float
    coefficients: dict[str, float]
    p_values: dict[str, float]
    aic: float

    def log_odds(self):
        return sum((F.lit(b) * F.col(f) for f, b in self.coefficients.items()), F.lit(self.intercept))

    def score(self, df: DataFrame, name: str = "pd") -> DataFrame:
        """Probability of bad as a plain expression: scoring needs no model object."""
        return df.withColumn(name, 1 / (1 + F.exp(-self.log_odds())))


def fit_logistic(df: DataFrame, features: Sequence[str], target: str = "target", weight: str | None = None) -> LogisticFit:
    """Binomial GLM with standard errors; fractional targets in [0, 1] are accepted."""
    glm = GeneralizedLinearRegression(
        family="binomial", link="logit", featuresCol="_x", labelCol=target, maxIter=50, regParam=0.0
    )
    if weight:
        glm = glm.setWeightCol(weight)
    model = glm.fit(_vectors(df, features))
    p = model.summary.pValues
    return LogisticFit(
        tuple(features),
        float(model.intercept),
        {f: float(b) for f, b in zip(features, model.coefficients)},
        {f: float(v) for f, v in zip(features, p)},
        float(model.summary.aic),
    )


@dataclass(frozen=True)
class Step:
    """A feature taken: its score statistic (chi-squared with one degree) and the criterion of the model with it."""

    feature: str
    statistic: float
    p_value: float
    aic: float


@dataclass(frozen=True)
class Selection:
    """The fit at the end (None: no feature was taken), what was taken in order, and why it ended there.

    ``stopped`` is ``max_features``, ``no_candidate`` (all taken, or their families full), ``not_significant`` or ``aic``.
    """

    fit: FractionalFit | None
    steps: tuple[Step, ...]
    stopped: str

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(i + 1, s.feature, s.statistic, s.p_value, s.aic, self.stopped) for i, s in enumerate(self.steps)]
        return spark.createDataFrame(rows, "step int, feature string, statistic double, p_value double, aic double, stopped string")


def score_statistics(at: Moments, chosen: Sequence[str], candidates: Sequence[str]) -> dict[str, float]:
    """Each candidate's score statistic given the chosen terms; candidates that these determine have none."""
    inside = [at.terms.index(t) for t in (ONE, *chosen)]
    inverse = np.linalg.pinv(at.information[np.ix_(inside, inside)])
    found = {}
    for c in candidates:
        j = at.terms.index(c)
        shared = at.information[j, inside]
        own = at.information[j, j] - shared @ inverse @ shared
        if own > 1e-9 * at.information[j, j]:
            found[c] = float((at.score[j] - shared @ inverse @ at.score[inside]) ** 2 / own)
    return found


def select_forward(
    df: DataFrame,
    features: Sequence[str],
    target: str = "target",
    family: Mapping[str, str] | None = None,
    max_per_family: int = cfg.MAX_FEATURES_PER_FAMILY,
    max_features: int = 15,
    max_p: float = 0.05,
) -> Selection:
    """Forward selection by score tests: the most significant candidate whose family has room, while the AIC falls.

    A step is one pass, which sums the products of all candidates at the present coefficients, and a refit of the model
    with the winner alone, which starts from that pass; the driver works on one number per pair of features. Ties go to the feature named first.
    ``max_features`` is the target length of a scorecard; ``stopped`` says whether it was what ended the selection.
    """
    family = family or {}
    fit = fit_fractional(df, [], target, robust=False)
    steps: list[Step] = []
    while True:
        chosen = [s.feature for s in steps]
        taken = [family.get(f, f) for f in chosen]
        open_ = [f for f in features if f not in chosen and taken.count(family.get(f, f)) < max_per_family]
        if len(chosen) >= max_features or not open_:
            stopped = "max_features" if len(chosen) >= max_features else "no_candidate"
            break
        known = df.where(F.col(f"`{target}`").isNotNull())
        here = moments(known, (ONE, *features), target, log_odds(fit.intercept, fit.coefficients))
        found = score_statistics(here, chosen, open_)
        if not found:
            stopped = "no_candidate"
            break
        best = max(found, key=lambda f: (found[f], -features.index(f)))
        p_value = math.erfc(math.sqrt(found[best] / 2))
        if p_value > max_p:
            stopped = "not_significant"
            break
        with_best = fit_fractional(df, [*chosen, best], target, start=({ONE: fit.intercept, **fit.coefficients}, here), robust=False)
        if with_best.aic >= fit.aic:
            stopped = "aic"
            break
        fit = with_best
        steps.append(Step(best, found[best], p_value, fit.aic))
    return Selection(with_spread(fit, df, target) if steps else None, tuple(steps), stopped)


def forward_selection(df: DataFrame, features: Sequence[str], target: str = "target", **limits) -> LogisticFit | None:
    """The model that :func:`select_forward` ends with, with the p-values of its coefficients."""
    fit = select_forward(df, features, target, **limits).fit
    if fit is None:
        return None
    errors = np.sqrt(np.diag(np.linalg.pinv(fit.information)))[1:]
    p = {f: math.erfc(abs(b / e) / math.sqrt(2)) for (f, b), e in zip(fit.coefficients.items(), errors)}
    return LogisticFit(fit.features, fit.intercept, fit.coefficients, p, fit.aic)


def fit_challenger(df: DataFrame, features: Sequence[str], target: str = "target", rounds: int = 20, depth: int = 3):
    gbt = GBTClassifier(featuresCol="_x", labelCol=target, maxIter=rounds, maxDepth=depth, seed=42)
    return gbt.fit(tree_vectors(df, features))


def score_challenger(model, df: DataFrame, features: Sequence[str], name: str = "pd_challenger") -> DataFrame:
    """Every row scored; missing values take the branch that training gave them."""
    scored = model.transform(tree_vectors(df, features))
    return scored.withColumn(name, vector_to_array("probability")[1]).drop("_x", "rawPrediction", "probability", "prediction")
