"""Fractional fits of loss and exposure, selection by score tests, and the gap of two scores.

The SQL side makes its own Newton steps, written out one after the other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import functions as F

from catalogue import fixtures as fx
from catalogue.registry import query, r, rounded
from cohortlake.operators import comparison, losses, models, severity


def newton_sql(name: str, source: str, y: str, xs: Sequence[str], steps: int = 14) -> str:
    """Views ``name_0`` to ``name_<steps>``: coefficients b0, b1, b2 after each step (absent features stay at zero)."""
    x1, x2 = (list(xs) + ["0.0", "0.0"])[:2]
    views = [f"{name}_d AS MATERIALIZED (SELECT CAST({y} AS DOUBLE) AS y, CAST({x1} AS DOUBLE) AS x1, CAST({x2} AS DOUBLE) AS x2 FROM {source})"]
    views.append(f"{name}_0 AS MATERIALIZED (SELECT 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2)")
    pad1, pad2 = ("1.0" if len(xs) < 1 else "0.0"), ("1.0" if len(xs) < 2 else "0.0")
    for k in range(steps):
        views.append(f"""
{name}_{k + 1} AS MATERIALIZED (
  SELECT b0 + (g0 * (d * f - e * e) - g1 * (b * f - c * e) + g2 * (b * e - c * d)) / det AS b0,
         b1 + (a * (g1 * f - g2 * e) - b * (g0 * f - g2 * c) + c * (g0 * e - g1 * c)) / det AS b1,
         b2 + (a * (d * g2 - e * g1) - b * (b * g2 - c * g1) + g0 * (b * e - c * d)) / det AS b2
  FROM (SELECT *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) AS det
        FROM (SELECT any_value(b0) AS b0, any_value(b1) AS b1, any_value(b2) AS b2, sum(w) AS a, sum(w * x1) AS b, sum(w * x2) AS c,
                     sum(w * x1 * x1) + {pad1} AS d, sum(w * x1 * x2) AS e, sum(w * x2 * x2) + {pad2} AS f,
                     sum(y - p) AS g0, sum((y - p) * x1) AS g1, sum((y - p) * x2) AS g2
              FROM (SELECT *, p * (1 - p) AS w FROM (
                    SELECT s.*, c.b0, c.b1, c.b2, 1 / (1 + exp(-(c.b0 + c.b1 * x1 + c.b2 * x2))) AS p FROM {name}_d s, {name}_{k} c)))))""")
    return ",".join(views)


def logistic_sql(name: str, xs: Sequence[str], steps: int = 14) -> str:
    x1, x2 = (list(xs) + ["0.0", "0.0"])[:2]
    return f"(SELECT 1 / (1 + exp(-(b0 + b1 * {x1} + b2 * {x2}))) FROM {name}_{steps})"


#: Bad loans with a balance after twelve months; a tenth have not been observed that long.
WORKOUT_SQL = """
workout AS (
  SELECT *, CASE WHEN months_after_default >= 12 AND balance_at_default > 0
                 THEN least(greatest((balance_at_default - balance_after_workout) / balance_at_default, 0), 1) END AS recovery_rate
  FROM (SELECT loan_id, segment, (score - 500) / 100 AS risk, CASE WHEN loan_id % 13 <> 0 THEN ln(balance) / 10 END AS size,
               balance AS balance_at_default, balance * (((loan_id * 7919) % 1009) / 600.0::DOUBLE - (score - 500) / 400) AS balance_after_workout,
               CASE WHEN loan_id % 10 = 0 THEN 7 ELSE 12 + loan_id % 5 END AS months_after_default, balance * (0.4::DOUBLE + (loan_id % 17) / 10) AS credit_limit
        FROM portfolio WHERE target = 1))"""


def workouts(spark, sf_dir):
    key, score, balance = F.col("loan_id"), F.col("score"), F.col("balance")
    bad = fx.portfolio(spark, sf_dir).where("target = 1").select(
        "loan_id", "segment",
        ((score - 500) / 100).alias("risk"),
        F.when(key % 13 != 0, F.log(balance) / 10).alias("size"),
        balance.alias("balance_at_default"),
        (balance * (((key * 7919) % 1009) / 600 - (score - 500) / 400)).alias("balance_after_workout"),
        F.when(key % 10 == 0, 7).otherwise(12 + key % 5).alias("months_after_default"),
        (balance * (0.4 + (key % 17) / 10)).alias("credit_limit"),
    )
    return losses.with_recovery(bad)


_KNOWN = "(SELECT * FROM workout WHERE recovery_rate IS NOT NULL AND size IS NOT NULL)"
_SOME = "(SELECT * FROM workout WHERE recovery_rate > 0 AND size IS NOT NULL)"
_LIMITS = "(SELECT *, least(greatest(balance_at_default / credit_limit, 0), 1.5) / 1.5 AS share FROM workout WHERE credit_limit > 0 AND size IS NOT NULL)"
_FEATURES = ["risk", "size"]
LOSS_FITS = (fx.PORTFOLIO_SQL, WORKOUT_SQL, newton_sql("st1", _KNOWN, "recovery_rate > 0", _FEATURES), newton_sql("st2", _SOME, "recovery_rate", _FEATURES))
EXPOSURE_FIT = (fx.PORTFOLIO_SQL, WORKOUT_SQL, newton_sql("ead", _LIMITS, "share", _FEATURES))


@query(
    "q_lgd_fit",
    fx.with_views(
        f"""
SELECT loan_id, {r('p', 6)} AS p_recovery, {r('m', 6)} AS recovery_if_any, {r('coalesce(1 - p * m, 0.87)', 6)} AS lgd, m IS NOT NULL AS is_modelled
FROM (SELECT loan_id, CASE WHEN size IS NOT NULL AND segment <> '5-LOW' THEN {logistic_sql('st1', _FEATURES)} END AS p,
             CASE WHEN size IS NOT NULL AND segment <> '5-LOW' THEN {logistic_sql('st2', _FEATURES)} END AS m FROM workout)""",
        *LOSS_FITS,
    ),
)
def lgd_fit(spark, sf_dir):
    """Both stages fitted on observed workouts; one segment stands for products without balances."""
    rows = workouts(spark, sf_dir)
    scored = severity.fit_loss(rows, _FEATURES).score(rows, observable=F.col("segment") != "5-LOW")
    return rounded(scored.select("loan_id", "p_recovery", "recovery_if_any", "lgd", "is_modelled"), 6)


@query(
    "q_ead_fit",
    fx.with_views(
        f"""
SELECT loan_id, {r('q', 6)} AS ead_ratio, {r('coalesce(q * credit_limit, balance_at_default)', 0)} AS ead, q IS NOT NULL AS is_ead_modelled
FROM (SELECT *, CASE WHEN size IS NOT NULL AND credit_limit > 0 THEN 1.5 * {logistic_sql('ead', _FEATURES)} END AS q FROM workout)""",
        *EXPOSURE_FIT,
    ),
)
def ead_fit(spark, sf_dir):
    rows = workouts(spark, sf_dir)
    model = severity.fit_exposure(rows, _FEATURES, "balance_at_default", "credit_limit")
    scored = model.score(rows, "credit_limit", "balance_at_default").select("loan_id", "ead_ratio", "ead", "is_ead_modelled")
    return scored.withColumns({"ead_ratio": F.round("ead_ratio", 6), "ead": F.round("ead", 0)})


def _terms_sql(name: str, label: str, steps: int = 14) -> str:
    return f"""
SELECT '{label}' AS model, term, {r('estimate', 5)} AS estimate, {r('sqrt(v)', 5)} AS robust_error, 0.0::DOUBLE AS score_left FROM (
  SELECT unnest(['(intercept)', 'risk', 'size']) AS term, unnest([b0, b1, b2]) AS estimate,
    unnest([
      i00 * i00 * m00 + i01 * i01 * m11 + i02 * i02 * m22 + 2 * (i00 * i01 * m01 + i00 * i02 * m02 + i01 * i02 * m12),
      i01 * i01 * m00 + i11 * i11 * m11 + i12 * i12 * m22 + 2 * (i01 * i11 * m01 + i01 * i12 * m02 + i11 * i12 * m12),
      i02 * i02 * m00 + i12 * i12 * m11 + i22 * i22 * m22 + 2 * (i02 * i12 * m01 + i02 * i22 * m02 + i12 * i22 * m12)]) AS v
  FROM (SELECT *, (d * f - e * e) / det AS i00, -(b * f - c * e) / det AS i01, (b * e - c * d) / det AS i02, (a * f - c * c) / det AS i11,
               -(a * e - b * c) / det AS i12, (a * d - b * b) / det AS i22
        FROM (SELECT *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) AS det
              FROM (SELECT any_value(b0) AS b0, any_value(b1) AS b1, any_value(b2) AS b2, sum(w) AS a, sum(w * x1) AS b, sum(w * x2) AS c,
                           sum(w * x1 * x1) AS d, sum(w * x1 * x2) AS e, sum(w * x2 * x2) AS f, sum(q) AS m00, sum(q * x1) AS m01, sum(q * x2) AS m02,
                           sum(q * x1 * x1) AS m11, sum(q * x1 * x2) AS m12, sum(q * x2 * x2) AS m22
                    FROM (SELECT *, p * (1 - p) AS w, (y - p) * (y - p) AS q FROM (
                          SELECT s.*, c.b0, c.b1, c.b2, 1 / (1 + exp(-(c.b0 + c.b1 * x1 + c.b2 * x2))) AS p FROM {name}_d s, {name}_{steps} c))))))"""


@query(
    "q_severity_terms",
    fx.with_views(
        " UNION ALL ".join([_terms_sql("st1", "any recovery"), _terms_sql("st2", "recovery if any"), _terms_sql("ead", "exposure")]),
        *LOSS_FITS, EXPOSURE_FIT[-1],
    ),
)
def severity_terms(spark, sf_dir):
    """Estimates and robust errors; what is left of the score equations rounds to zero at six digits."""
    rows = workouts(spark, sf_dir)
    loss = severity.fit_loss(rows, _FEATURES)
    exposure = severity.fit_exposure(rows, _FEATURES, "balance_at_default", "credit_limit")
    terms = severity.terms_table(spark, {"any recovery": loss.any_recovery, "recovery if any": loss.recovery_if_any, "exposure": exposure.share})
    return rounded(terms.drop("score_left"), 5).join(terms.select("model", "term", (F.round("score_left", 6) + F.lit(0.0)).alias("score_left")), ["model", "term"])


# -- selection ----------------------------------------------------------------------------------

CANDIDATES = ("risk", "twin", "size", "season")
CANDIDATE_SQL = """
cand AS MATERIALIZED (
  SELECT loan_id, (score - 500) / 100 AS risk, (score - 500) / 100 + loan_id % 7 / 5.0::DOUBLE AS twin, ln(balance) / 10 AS size,
         month(opened) / 12.0::DOUBLE AS season,
         CASE WHEN loan_id * 104729 % 1000 < 700 - score + 25 * month(opened) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS late
  FROM portfolio)"""


def candidates(spark, sf_dir):
    key, score, month = F.col("loan_id"), F.col("score"), F.month("opened")
    return fx.portfolio(spark, sf_dir).select(
        "loan_id",
        ((score - 500) / 100).alias("risk"),
        ((score - 500) / 100 + key % 7 / 5).alias("twin"),
        (F.log("balance") / 10).alias("size"),
        (month / 12).alias("season"),
        ((key * 104729) % 1000 < 700 - score + 25 * month).cast("double").alias("late"),
    )


def _chosen_sql(view: str) -> str:
    return f"CASE (SELECT feature FROM {view}) " + " ".join(f"WHEN '{c}' THEN {c}" for c in CANDIDATES) + " END"


_LONG = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS x, late AS y, p, x1 FROM {{0}}" for c in CANDIDATES)
_LOSS = "(SELECT -sum(y * ln(p) + (1 - y) * ln(1 - p)) FROM (SELECT d.y, 1 / (1 + exp(-(b0 + b1 * d.x1 + b2 * d.x2))) AS p FROM {0}_d d, {0}_14))"


@query(
    "q_forward_selection",
    fx.with_views(
        f"""
SELECT 1 AS step, feature, {r('statistic', 4)} AS statistic, {r('2 * ' + _LOSS.format('f1') + ' + 4', 2)} AS aic, 'max_features' AS stopped FROM first_pick
UNION ALL
SELECT 2, feature, {r('statistic', 4)}, {r('2 * ' + _LOSS.format('f2') + ' + 6', 2)}, 'max_features' FROM second_pick""",
        fx.PORTFOLIO_SQL,
        CANDIDATE_SQL,
        f"""
nothing AS (SELECT *, avg(late) OVER () AS p, 0.0::DOUBLE AS x1 FROM cand),
first_pick AS MATERIALIZED (
  SELECT feature, power(sum((y - p) * x), 2) / (any_value(p * (1 - p)) * (sum(x * x) - power(sum(x), 2) / count(*))) AS statistic
  FROM ({_LONG.format('nothing')}) GROUP BY feature ORDER BY statistic DESC LIMIT 1)""",
        newton_sql("f1", f"(SELECT *, {_chosen_sql('first_pick')} AS pick FROM cand)", "late", ["pick"]),
        f"""
one AS (SELECT c.*, {_chosen_sql('first_pick')} AS x1, 1 / (1 + exp(-(b0 + b1 * {_chosen_sql('first_pick')}))) AS p FROM cand c, f1_14),
second_pick AS MATERIALIZED (
  SELECT feature, u * u / (ijj - (i0 * i0 * s11 - 2 * i0 * i1 * s01 + i1 * i1 * s00) / (s00 * s11 - s01 * s01)) AS statistic
  FROM (SELECT feature, sum((y - p) * x) AS u, sum(w * x * x) AS ijj, sum(w * x) AS i0, sum(w * x * x1) AS i1, sum(w) AS s00, sum(w * x1) AS s01,
               sum(w * x1 * x1) AS s11
        FROM (SELECT *, p * (1 - p) AS w FROM ({_LONG.format('one')})) WHERE feature <> (SELECT feature FROM first_pick) GROUP BY feature)
  ORDER BY statistic DESC LIMIT 1)""",
        newton_sql("f2", f"(SELECT *, {_chosen_sql('first_pick')} AS pick, {_chosen_sql('second_pick')} AS pick2 FROM cand)", "late", ["pick", "pick2"]),
    ),
)
def forward_selection(spark, sf_dir):
    """The first two features of a forward selection, with their score statistics and the criterion after each."""
    chosen = models.select_forward(candidates(spark, sf_dir), CANDIDATES, "late", max_features=2)
    return rounded(chosen.table(spark).select("step", "feature", F.round("statistic", 4).alias("statistic"), F.round("aic", 2).alias("aic"), "stopped"))


# -- two scores -----------------------------------------------------------------------------------

RIVAL_SQL = """
pair AS MATERIALIZED (SELECT loan_id, target, score AS a, CASE WHEN loan_id % 50 <> 0 THEN floor((score + loan_id * 31 % 257) / 8) END AS b FROM portfolio),
known AS MATERIALIZED (SELECT * FROM pair WHERE a IS NOT NULL AND b IS NOT NULL)"""


def _placed_sql(score: str) -> str:
    return f"""
at_{score} AS MATERIALIZED (
  SELECT {score}, (sum(g) OVER () - sum(g) OVER o + g / 2) / sum(g) OVER () AS of_bad, (sum(bads) OVER o - bads / 2) / sum(bads) OVER () AS of_good
  FROM (SELECT {score}, sum(target) AS bads, sum(1 - target) AS g FROM known GROUP BY {score}) WINDOW o AS (ORDER BY {score}))"""


@query(
    "q_gini_gap",
    fx.with_views(
        f"""
SELECT n_bads, n_goods, {r('2 * auc_a - 1', 6)} AS gini_a, {r('2 * auc_b - 1', 6)} AS gini_b, {r('2 * (auc_b - auc_a)', 6)} AS gap,
       {r('2 * sqrt(v)', 6)} AS gap_error, {r('(auc_b - auc_a) / sqrt(v)', 4)} AS z
FROM (SELECT count(*) FILTER (target = 1) AS n_bads, count(*) FILTER (target = 0) AS n_goods, avg(va) FILTER (target = 1) AS auc_a,
             avg(vb) FILTER (target = 1) AS auc_b,
             var_samp(vb - va) FILTER (target = 1) / count(*) FILTER (target = 1) + var_samp(vb - va) FILTER (target = 0) / count(*) FILTER (target = 0) AS v
      FROM (SELECT target, CASE WHEN target = 1 THEN x.of_bad ELSE x.of_good END AS va, CASE WHEN target = 1 THEN y.of_bad ELSE y.of_good END AS vb
            FROM known JOIN at_a x USING (a) JOIN at_b y USING (b)))""",
        fx.PORTFOLIO_SQL,
        RIVAL_SQL,
        _placed_sql("a"),
        _placed_sql("b"),
    ),
)
def gini_gap(spark, sf_dir):
    """The gap between the score and a coarser, noisier rival with many ties, on the loans that have both."""
    key = F.col("loan_id")
    rival = F.when(key % 50 != 0, F.floor((F.col("score") + (key * 31) % 257) / 8).cast("double"))
    measured = comparison.gini_gap(fx.portfolio(spark, sf_dir).withColumn("rival", rival), "score", "rival")
    six = ["gini_a", "gini_b", "gap", "gap_error"]
    return measured.select("n_bads", "n_goods", *[(F.round(c, 6) + 0.0).alias(c) for c in six], (F.round("z", 4) + 0.0).alias("z"))
