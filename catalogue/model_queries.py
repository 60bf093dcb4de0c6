"""Binning, validation, scaling, losses, strategy and external tradelines on derived views."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import fixtures as fx
from catalogue.population_queries import POPULATION
from catalogue.registry import big, query, r, rounded
from cohortlake.operators import (
    binning,
    losses,
    models,
    sampling,
    scaling,
    strategy,
    tradelines,
    validation,
)
from cohortlake.operators import population as pop
from cohortlake.sources.workspace import materialise

# -- bands and bins -------------------------------------------------------------------------


def _banded(source: str, value: str, bands: int, edges_from: str | None = None, name: str = "band") -> str:
    """SQL view ``banded``: rows with the 1-based quantile band of a value."""
    probs = ", ".join(str(i / bands) for i in range(1, bands))
    return f"""
edges AS (SELECT list_distinct(quantile_cont(CAST({value} AS DOUBLE), [{probs}])) AS e FROM {edges_from or source}),
banded AS (SELECT s.*, CASE WHEN {value} IS NOT NULL
                            THEN CAST(len([x for x in e if x <= {value}]) + 1 AS INT) END AS {name}
           FROM {source} s, edges)"""


@query(
    "q_quantile_bins",
    fx.with_views(
        f"""
SELECT 'l_extendedprice' AS variable, band - 1 AS bin, count(*) AS n, {big("sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)")} AS bads
FROM banded GROUP BY band""",
        _banded("lineitem", "l_extendedprice", 8),
    ),
)
def quantile_bins(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "lineitem").select(
        "l_extendedprice", (F.col("l_returnflag") == "R").cast("int").alias("bad")
    )
    edges = binning.quantile_edges(rows, ["l_extendedprice"], 8)
    return binning.bin_counts(rows, edges, "bad")


# Merging is iterative: rows only here, checked by brute force in the tests.
@query("q_monotone_bins")
def monotone_bins(spark, sf_dir):
    scored = fx.portfolio(spark, sf_dir).select("score", "balance", "lgd", "target")
    return binning.bin_table(spark, binning.fit_bins(scored, ["score", "balance", "lgd"], "target"))


@query("q_woe_transform")
def woe_transform(spark, sf_dir):
    scored = fx.portfolio(spark, sf_dir).select("loan_id", "score", "lgd", "target")
    return binning.woe_transform(scored, binning.fit_bins(scored, ["score", "lgd"], "target"))


@query(
    "q_bad_rate_by_band",
    fx.with_views(
        f"""
SELECT band, n, {r('bad_rate', 6)} AS bad_rate, {r('CASE WHEN band > 1 THEN bad_rate - lag(bad_rate) OVER (ORDER BY band) END', 6)} AS step
FROM (SELECT coalesce(band, 0) AS band, count(*) AS n, avg(target) AS bad_rate FROM banded GROUP BY 1)""",
        fx.PORTFOLIO_SQL,
        _banded("portfolio", "lgd", 5),
    ),
)
def bad_rate_by_band(spark, sf_dir):
    return rounded(validation.bad_rate_by_band(fx.portfolio(spark, sf_dir), "lgd", bands=5), 6)


@query(
    "q_observed_direction",
    fx.with_views(
        """
SELECT count(*) FILTER (WHERE s > 0) AS up, count(*) FILTER (WHERE s < 0) AS down,
       CASE WHEN count(*) FILTER (WHERE s < 0) = 0 AND count(*) FILTER (WHERE s > 0) > 0 THEN '+'
            WHEN count(*) FILTER (WHERE s > 0) = 0 AND count(*) FILTER (WHERE s < 0) > 0 THEN '-' ELSE '?' END AS direction
FROM (SELECT avg(target) - lag(avg(target)) OVER (ORDER BY band) AS s FROM banded GROUP BY band)""",
        fx.PORTFOLIO_SQL,
        _banded("portfolio", "score", 5),
    ),
)
def observed_direction(spark, sf_dir):
    return validation.observed_direction(validation.bad_rate_by_band(fx.portfolio(spark, sf_dir), "score", bands=5))


# -- validation -------------------------------------------------------------------------------


@query(
    "q_separation",
    fx.with_views(
        f"""
SELECT {big('sum(n)')} AS n, {big('sum(b)')} AS n_bads, {r('max(abs(cb / nb - cg / ng))', 6)} AS ks,
       {r('1 - sum(b * (cg - g / 2)) / (max(nb) * max(ng))', 6)} AS auc,
       {r('1 - 2 * sum(b * (cg - g / 2)) / (max(nb) * max(ng))', 6)} AS gini, {r('max(div)', 4)} AS divergence
FROM (SELECT *, sum(b) OVER (ORDER BY score) AS cb, sum(g) OVER (ORDER BY score) AS cg, sum(b) OVER () AS nb, sum(g) OVER () AS ng
      FROM (SELECT score, count(*) AS n, sum(target) AS b, sum(1 - target) AS g FROM portfolio GROUP BY score)),
     (SELECT 2 * power(avg(score) FILTER (WHERE target = 0) - avg(score) FILTER (WHERE target = 1), 2)
             / (var_pop(score) FILTER (WHERE target = 0) + var_pop(score) FILTER (WHERE target = 1)) AS div FROM portfolio)""",
        fx.PORTFOLIO_SQL,
    ),
)
def separation(spark, sf_dir):
    measured = validation.separation(fx.portfolio(spark, sf_dir))
    return rounded(measured, 6).withColumn("divergence", F.round("divergence", 4))


@query(
    "q_gains",
    fx.with_views(
        f"""
SELECT band, n, bads, min_score, max_score, {r('bads / n', 6)} AS bad_rate, {r('sum(n) OVER o / sum(n) OVER ()', 6)} AS cum_population,
       {r('sum(bads) OVER o / sum(bads) OVER ()', 6)} AS cum_bad_capture,
       {r('(bads / n) / (sum(bads) OVER () / sum(n) OVER ())', 6)} AS lift, bads / n < lag(bads / n) OVER (ORDER BY band) AS is_ranked
FROM (SELECT band, count(*) AS n, {big('sum(target)')} AS bads, min(score) AS min_score, max(score) AS max_score
      FROM banded GROUP BY band) WINDOW o AS (ORDER BY band)""",
        fx.PORTFOLIO_SQL,
        _banded("portfolio", "score", 10),
    ),
)
def gains(spark, sf_dir):
    return rounded(validation.gains(fx.portfolio(spark, sf_dir)), 6)


@query(
    "q_calibration",
    fx.with_views(
        f"""
SELECT band, n, {r('p', 6)} AS predicted, {r('o', 6)} AS observed, {r('(p - o) / nullif(o, 0)', 6)} AS relative_error,
       abs((p - o) / nullif(o, 0)) <= 0.2 AS is_ok
FROM (SELECT band, count(*) AS n, avg(pd) AS p, avg(target) AS o FROM banded GROUP BY band)""",
        fx.PORTFOLIO_SQL,
        _banded("portfolio", "pd", 10),
    ),
)
def calibration(spark, sf_dir):
    return rounded(validation.calibration(fx.portfolio(spark, sf_dir)), 6)


@query(
    "q_psi",
    fx.with_views(
        f"""
SELECT {r('sum((a - e) * ln(a / e))', 6)} AS psi,
       CASE WHEN sum((a - e) * ln(a / e)) < 0.1 THEN 'stable' WHEN sum((a - e) * ln(a / e)) <= 0.25 THEN 'monitor' ELSE 'unusable' END AS verdict
FROM (SELECT greatest(coalesce(count(*) FILTER (WHERE half = 1) / max(n1), 0), 1e-6) AS e,
             greatest(coalesce(count(*) FILTER (WHERE half = 2) / max(n2), 0), 1e-6) AS a
      FROM banded, (SELECT count(*) FILTER (WHERE half = 1) AS n1, count(*) FILTER (WHERE half = 2) AS n2 FROM ev) GROUP BY band)""",
        "ev AS (SELECT value, CASE WHEN day(ts) <= 15 THEN 1 ELSE 2 END AS half FROM events)",
        "first_half AS (SELECT * FROM ev WHERE half = 1)",
        _banded("ev", "value", 10, "first_half"),
    ),
)
def psi(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events").select("value", (F.day("ts") <= 15).alias("early"))
    measured = validation.psi(events.filter("early"), events.filter("NOT early"), "value")
    return rounded(measured, 6)


@query(
    "q_psi_by_period",
    fx.with_views(
        f"""
SELECT y AS year, {big('sum(n)')} AS n, {r('sum((a - e) * ln(a / e))', 6)} AS psi
FROM (SELECT y, n, greatest(n / sum(n) OVER (PARTITION BY y), 1e-6) AS a,
             greatest((SELECT count(*) FROM banded b WHERE b.y = 1995 AND b.band = g.band) / (SELECT count(*) FROM base), 1e-6) AS e
      FROM (SELECT y, band, (SELECT count(*) FROM banded b WHERE b.y = ys.y AND b.band = bs.band) AS n
            FROM (SELECT DISTINCT y FROM o) ys, (SELECT unnest(range(1, 11)) AS band) bs) g)
GROUP BY y""",
        "o AS (SELECT CAST(year(o_orderdate) AS INT) AS y, o_totalprice FROM orders)",
        "base AS (SELECT * FROM o WHERE y = 1995)",
        _banded("o", "o_totalprice", 10, "base"),
    ),
)
def psi_by_period(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), "o_totalprice")
    return rounded(validation.psi_by_period(orders.filter("year = 1995"), orders, "o_totalprice", "year"), 6)


@query(
    "q_psi_category",
    """
WITH e AS (SELECT o_orderpriority AS c, count(*) AS n FROM orders WHERE year(o_orderdate) < 1998 GROUP BY 1),
a AS (SELECT o_orderpriority AS c, count(*) AS n FROM orders WHERE year(o_orderdate) >= 1998 GROUP BY 1)
SELECT category, round(e, 6) AS expected, round(a, 6) AS actual, round((a - e) * ln(a / e), 6) + 0.0 AS psi
FROM (SELECT c AS category, e.n / (SELECT sum(n) FROM e) AS e, a.n / (SELECT sum(n) FROM a) AS a FROM e JOIN a USING (c))""",
)
def psi_category(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders")
    late = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    return rounded(validation.psi_table(orders.filter(~late), orders.filter(late), "o_orderpriority"), 6)


@query(
    "q_indeterminate_check",
    fx.with_views(
        f"""
SELECT {r('b', 4)} AS bads, {r('i', 4)} AS indeterminates, {r('g', 4)} AS goods, b < i AND i < g AS is_between
FROM (SELECT avg(score) FILTER (WHERE target = 1) AS b, avg(score) FILTER (WHERE is_indeterminate) AS i,
             avg(score) FILTER (WHERE target = 0 AND NOT is_indeterminate) AS g FROM portfolio)""",
        fx.PORTFOLIO_SQL,
    ),
)
def indeterminate_check(spark, sf_dir):
    return rounded(validation.indeterminate_check(fx.portfolio(spark, sf_dir)))


@query(
    "q_vintage_curves",
    fx.with_views(
        """
SELECT v AS vintage, CAST(month AS INT) AS month, n, CAST(sum(hits) OVER (PARTITION BY v ORDER BY month) AS BIGINT) AS cum_bads,
       round(sum(hits) OVER (PARTITION BY v ORDER BY month) / n, 6) AS cum_bad_rate
FROM (SELECT v, month, n, (SELECT count(*) FROM l WHERE l.v = g.v AND l.bad_month = g.month) AS hits
      FROM (SELECT v, n, unnest(range(1, last + 1)) AS month
            FROM (SELECT v, count(*) AS n, max(mob) AS last FROM l GROUP BY v)) g)""",
        fx.PORTFOLIO_SQL,
        "l AS (SELECT CAST(year(opened) AS INT) AS v, 24 AS mob, CASE WHEN target = 1 THEN CAST(1 + loan_id % 24 AS INT) END AS bad_month FROM portfolio)",
    ),
)
def vintage_curves(spark, sf_dir):
    loans = fx.portfolio(spark, sf_dir).select(
        F.year("opened").alias("vintage"),
        F.lit(24).alias("mob"),
        F.when(F.col("target") == 1, (1 + F.col("loan_id") % 24).cast("int")).alias("bad_month"),
    )
    return rounded(validation.vintage_curves(loans, "vintage", "mob", "bad_month"), 6)


# -- scaling ----------------------------------------------------------------------------------


@query(
    "q_score_scaling",
    fx.with_views(
        f"""
SELECT loan_id, {r('600 - 20 / ln(2) * ln(50) + 20 / ln(2) * ln((1 - pd) / pd)', 4)} AS points, {r('pd', 6)} AS pd FROM portfolio""",
        fx.PORTFOLIO_SQL,
    ),
)
def score_scaling(spark, sf_dir):
    scored = fx.portfolio(spark, sf_dir).select("loan_id", "pd").withColumn("points", scaling.score_of_pd("pd"))
    # The way back must return the probability it came from.
    return scored.select("loan_id", F.round("points", 4).alias("points"), F.round(scaling.pd_of_score("points"), 6).alias("pd"))


@query(
    "q_reason_codes",
    fx.with_views(
        """
SELECT loan_id, array_to_string([x.v for x in [y for y in list_sort([
         {'gap': a - 50, 'v': 'a'}, {'gap': b - 40, 'v': 'b'}, {'gap': c - 30, 'v': 'c'}, {'gap': d - 20, 'v': 'd'}])
       if y.gap < 0][1:3]], ',') AS reasons
FROM (SELECT loan_id, CAST(loan_id % 51 AS DOUBLE) AS a, CAST(loan_id % 41 AS DOUBLE) AS b, CAST(loan_id % 31 AS DOUBLE) AS c,
             CAST(loan_id % 21 AS DOUBLE) AS d FROM portfolio)""",
        fx.PORTFOLIO_SQL,
    ),
)
def reason_codes(spark, sf_dir):
    best = {"a": 50, "b": 40, "c": 30, "d": 20}
    given = {f"{v}_points": (F.col("loan_id") % (b + 1)).cast("double") for v, b in best.items()}
    scored = fx.portfolio(spark, sf_dir).select("loan_id").withColumns(given)
    return scaling.reason_codes(scored, best).select("loan_id", F.concat_ws(",", "reasons").alias("reasons"))


# -- losses -----------------------------------------------------------------------------------

DEFAULTS_SQL = """
d AS (SELECT account_id, customer_id, product_type, min(month_idx) AS default_month FROM panel WHERE dpd >= 60 GROUP BY ALL),
ev AS (SELECT d.*, max(balance) FILTER (WHERE month_idx = default_month) AS balance_at_default,
              max(credit_limit) FILTER (WHERE month_idx = default_month) AS limit_at_default,
              max(balance) FILTER (WHERE month_idx = default_month + 12) AS balance_after_workout,
              max(month_idx - default_month) AS months_after_default
       FROM d JOIN panel p ON p.account_id = d.account_id AND p.customer_id = d.customer_id AND p.product_type = d.product_type
       GROUP BY ALL),
rec AS (SELECT *, months_after_default >= 12 AS is_covered,
               CASE WHEN months_after_default >= 12 AND balance_at_default > 0
                     AND balance_after_workout IS NOT NULL
                    THEN least(greatest((balance_at_default - balance_after_workout) / balance_at_default, 0), 1) END AS recovery_rate
        FROM ev)"""


def _recoveries(spark, sf_dir):
    return losses.with_recovery(losses.default_events(fx.panel(spark, sf_dir), bad_from=60))


@query(
    "q_default_events",
    fx.with_views(
        f"""
SELECT account_id, customer_id, product_type, default_month, {r('balance_at_default', 2)} AS balance_at_default,
       {r('limit_at_default', 2)} AS limit_at_default, {r('balance_after_workout', 2)} AS balance_after_workout,
       months_after_default, is_covered, {r('recovery_rate', 6)} AS recovery_rate, {r('1 - recovery_rate', 6)} AS lgd FROM rec""",
        fx.PANEL_SQL,
        DEFAULTS_SQL,
    ),
)
def default_events(spark, sf_dir):
    digits = {"balance_at_default": 2, "limit_at_default": 2, "balance_after_workout": 2, "recovery_rate": 6, "lgd": 6}
    return _recoveries(spark, sf_dir).withColumns({c: F.round(c, d) for c, d in digits.items()})


@query(
    "q_recovery_stages",
    fx.with_views(
        f"""
SELECT product_type, n, {r('p', 6)} AS p_recovery, {r('m', 6)} AS recovery_if_any, {r('1 - p * coalesce(m, 0)', 6)} AS lgd
FROM (SELECT product_type, count(*) AS n, avg(CASE WHEN recovery_rate > 0 THEN 1 ELSE 0 END) AS p,
             avg(recovery_rate) FILTER (WHERE recovery_rate > 0) AS m
      FROM rec WHERE recovery_rate IS NOT NULL GROUP BY product_type)""",
        fx.PANEL_SQL,
        DEFAULTS_SQL,
    ),
)
def recovery_stages(spark, sf_dir):
    return rounded(losses.recovery_stages(_recoveries(spark, sf_dir), "product_type"), 6)


@query(
    "q_exposure",
    fx.with_views(
        f"""
SELECT account_id, {r('CASE WHEN l > 0 AND bd IS NOT NULL THEN least(greatest(bd / l, 0), 1.5) END', 6)} AS ead_ratio,
       {r('(bd - bo) / nullif(l - bo, 0)', 4)} AS ccf, (bd - bo) / nullif(l - bo, 0) BETWEEN 0 AND 1 AS ccf_in_bounds
FROM (SELECT account_id, balance_at_default AS bd,
             (SELECT max(credit_limit) FROM panel p WHERE p.account_id = ev.account_id AND month_idx = -13) AS l,
             (SELECT max(balance) FROM panel p WHERE p.account_id = ev.account_id AND month_idx = -13) AS bo FROM ev)""",
        fx.PANEL_SQL,
        DEFAULTS_SQL,
    ),
)
def exposure(spark, sf_dir):
    # Computed once: a sum that is computed again can differ in its last digit, and a default in that month is then out of bounds.
    used = ("account_id", "customer_id", "product_type", "month_idx", "dpd", "balance", "credit_limit")
    panel = materialise(fx.panel(spark, sf_dir).select(*used), "panel")
    # An account can have rows of several customers in that month: one row each, so that no event is repeated.
    at_obs = panel.filter("month_idx = -13").groupBy("account_id").agg(
        F.max("credit_limit").alias("limit_obs"), F.max("balance").alias("balance_obs")
    )
    events = losses.default_events(panel, bad_from=60).join(at_obs, "account_id", "left")
    measures = losses.exposure_measures("balance_at_default", "limit_obs", "balance_obs")
    out = events.withColumns(measures).select("account_id", *measures)
    return out.withColumns({"ead_ratio": F.round("ead_ratio", 6), "ccf": F.round("ccf", 4)})


@query(
    "q_loan_losses",
    fx.with_views(
        f"""
SELECT loan_id, {r('rate', 6)} AS recovery_rate, {r('1 - rate', 6)} AS lgd, {r('funded_amnt - funded_amnt * 0.25', 4)} AS ead
FROM (SELECT loan_id, funded_amnt, least(greatest(recoveries / nullif(funded_amnt, 0), 0), 1) AS rate FROM loans)""",
        fx.LOANS_SQL,
    ),
)
def loan_losses(spark, sf_dir):
    loans = fx.loans(spark, sf_dir).withColumn("repaid", F.col("funded_amnt") * 0.25)
    out = losses.loan_losses(loans, "recoveries", "funded_amnt", "repaid").select("loan_id", "recovery_rate", "lgd", "ead")
    return out.withColumns({"recovery_rate": F.round("recovery_rate", 6), "lgd": F.round("lgd", 6), "ead": F.round("ead", 4)})


EL_SQL = """
el AS (SELECT *, lgd IS NOT NULL AND ead IS NOT NULL AS is_modelled, pd * coalesce(lgd, 0.87) * coalesce(ead, balance) AS el,
              pd * 0.87 * balance AS el_flat FROM portfolio),
econ AS (SELECT *, balance * 0.12 + spend * 0.01 AS revenue, balance * 0.03 + 20 AS cost,
                balance * 0.12 + spend * 0.01 - balance * 0.03 - 20 - el AS contribution FROM el)"""
ECONOMICS = (fx.PORTFOLIO_SQL, EL_SQL)


def _economics(spark, sf_dir):
    return losses.contribution(losses.expected_loss(fx.portfolio(spark, sf_dir)))


@query(
    "q_expected_loss",
    fx.with_views(
        f"""
SELECT segment, is_modelled, count(*) AS n, {r('sum(el)', 2)} AS el, {r('sum(el_flat)', 2)} AS el_flat,
       {r('sum(contribution)', 2)} AS contribution FROM econ GROUP BY ALL""",
        *ECONOMICS,
    ),
)
def expected_loss(spark, sf_dir):
    grouped = _economics(spark, sf_dir).groupBy("segment", "is_modelled").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(c).alias(c) for c in ("el", "el_flat", "contribution")],
    )
    return rounded(grouped, 2)


@query(
    "q_cutoff_sweep",
    fx.with_views(
        f"""
SELECT CAST(cutoff AS DOUBLE) AS cutoff, count(*) FILTER (WHERE score >= cutoff) AS n_approved,
       {r('count(*) FILTER (WHERE score >= cutoff) / count(*)', 6)} AS approval_rate,
       {r('avg(target) FILTER (WHERE score >= cutoff)', 6)} AS bad_rate,
       {r('sum(target) FILTER (WHERE score < cutoff) / sum(target)', 6)} AS bad_capture,
       {r('sum(el) FILTER (WHERE score >= cutoff)', 2)} AS el, {r('sum(contribution) FILTER (WHERE score >= cutoff)', 2)} AS contribution
FROM econ, (VALUES (450), (500), (550), (600), (650), (700), (750)) c(cutoff) GROUP BY cutoff""",
        *ECONOMICS,
    ),
)
def cutoff_sweep(spark, sf_dir):
    swept = losses.cutoff_sweep(_economics(spark, sf_dir), range(450, 800, 50))
    digits = {"approval_rate": 6, "bad_rate": 6, "bad_capture": 6, "el": 2, "contribution": 2}
    return swept.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query(
    "q_swap_set",
    fx.with_views(
        """
SELECT CASE WHEN balance < 200000 AND score >= 600 THEN 'both approve' WHEN score >= 600 THEN 'swap in'
            WHEN balance < 200000 THEN 'swap out' ELSE 'both decline' END AS decision, count(*) AS n, round(avg(target), 6) AS bad_rate
FROM portfolio GROUP BY 1""",
        fx.PORTFOLIO_SQL,
    ),
)
def swap_set(spark, sf_dir):
    return rounded(losses.swap_set(fx.portfolio(spark, sf_dir), F.col("balance") < 200_000, F.col("score") >= 600), 6)


@query(
    "q_stress",
    fx.with_views(
        f"""
SELECT segment, CAST(m AS DOUBLE) AS multiplier, count(*) AS n, {r('sum(el * least(pd * m, 1) / pd)', 2)} AS el,
       {r('sum(contribution + el - el * least(pd * m, 1) / pd)', 2)} AS contribution
FROM econ, (VALUES (1.0), (1.5), (2.0)) x(m) GROUP BY segment, m""",
        *ECONOMICS,
    ),
)
def stress(spark, sf_dir):
    return rounded(losses.stress(_economics(spark, sf_dir), "segment"), 2)


# -- strategy ---------------------------------------------------------------------------------

BUCKET_SQL = """
b AS (SELECT *, CASE WHEN score < 500 THEN 'E' WHEN score < 550 THEN 'D' WHEN score < 600 THEN 'C' WHEN score < 650 THEN 'B'
                     WHEN score < 700 THEN 'A2' ELSE 'A1' END AS bucket FROM portfolio)"""


@query(
    "q_risk_buckets",
    fx.with_views(
        f"""
SELECT bucket, n, min_score, max_score, {r('n / sum(n) OVER ()', 6)} AS share, {r('bads / n', 6)} AS bad_rate,
       {r('sum(bads) OVER (ORDER BY min_score) / sum(bads) OVER ()', 6)} AS cum_bad_capture,
       n / sum(n) OVER () >= 0.05 AS is_large_enough, bads / n < lag(bads / n) OVER (ORDER BY min_score) AS is_ranked
FROM (SELECT bucket, count(*) AS n, sum(target) AS bads, min(score) AS min_score, max(score) AS max_score FROM b GROUP BY bucket)""",
        fx.PORTFOLIO_SQL,
        BUCKET_SQL,
    ),
)
def risk_buckets(spark, sf_dir):
    return rounded(strategy.bucket_report(strategy.risk_bucket(fx.portfolio(spark, sf_dir))), 6)


@query(
    "q_overrides",
    fx.with_views(
        """
SELECT final_action, is_overridden, count(*) AS n
FROM (SELECT CASE greatest(lvl, CASE WHEN pd >= 0.3 THEN 5 ELSE 0 END, CASE WHEN balance > 400000 THEN 3 ELSE 0 END)
                  WHEN 1 THEN 'proactive increase' WHEN 3 THEN 'hold' WHEN 5 THEN 'decrease' END AS final_action,
             greatest(lvl, CASE WHEN pd >= 0.3 THEN 5 ELSE 0 END, CASE WHEN balance > 400000 THEN 3 ELSE 0 END) > lvl AS is_overridden
      FROM (SELECT *, CASE WHEN score >= 600 THEN 1 WHEN score >= 550 THEN 3 ELSE 5 END AS lvl FROM portfolio))
GROUP BY ALL""",
        fx.PORTFOLIO_SQL,
    ),
)
def overrides(spark, sf_dir):
    score = F.col("score")
    action = F.when(score >= 600, "proactive increase").when(score >= 550, "hold").otherwise("decrease")
    rules = [(F.col("pd") >= 0.3, "decrease"), (F.col("balance") > 400_000, "hold")]
    decided = strategy.with_overrides(fx.portfolio(spark, sf_dir).withColumn("action", action), "action", rules)
    return decided.groupBy("final_action", "is_overridden").agg(F.count(F.lit(1)).alias("n"))


# Tree and model fits are iterative: rows only.
@query("q_strategy_tree")
def strategy_tree(spark, sf_dir):
    scored = fx.portfolio(spark, sf_dir).select("score", "balance", "target")
    model = strategy.fit_tree(scored, ["score", "balance"])
    return strategy.leaf_table(model, scored, ["score", "balance"])


@query("q_logistic_scorecard")
def logistic_scorecard(spark, sf_dir):
    """Bins, WoE, logistic fit, points and score of the portfolio."""
    scored = fx.portfolio(spark, sf_dir).select("loan_id", "score", "balance", "target").withColumnRenamed("score", "raw")
    fitted = binning.fit_bins(scored, ["raw", "balance"], "target")
    fit = models.fit_logistic(binning.woe_transform(scored, fitted), ["raw_woe", "balance_woe"])
    coefficients = {f.removesuffix("_woe"): b for f, b in fit.coefficients.items()}
    points = scaling.points(fitted, coefficients, fit.intercept)
    return scaling.with_points(scored, fitted, points)


@query(
    "q_correlations",
    """
SELECT * FROM (SELECT 'l_discount' AS left_feature, 'l_quantity' AS right_feature, round(corr(l_discount, l_quantity), 6) + 0.0 AS r FROM lineitem
UNION ALL SELECT 'l_extendedprice', 'l_quantity', round(corr(l_extendedprice, l_quantity), 6) + 0.0 FROM lineitem
UNION ALL SELECT 'l_extendedprice', 'l_discount', round(corr(l_extendedprice, l_discount), 6) + 0.0 FROM lineitem)""",
)
def correlations(spark, sf_dir):
    features = ["l_quantity", "l_discount", "l_extendedprice"]
    pairs = models.correlated_pairs(fx.table(spark, sf_dir, "lineitem"), features, above=-1.0)
    return rounded(spark.createDataFrame(pairs, "left_feature string, right_feature string, r double"), 6)


# -- sampling ---------------------------------------------------------------------------------


@query(
    "q_as_of_join",
    fx.with_views(
        """
SELECT p.account_id, p.month_idx, d.dpd AS last_dpd
FROM panel p ASOF LEFT JOIN (SELECT account_id, month_idx, dpd FROM panel WHERE dpd >= 30) d
  ON p.account_id = d.account_id AND p.month_idx >= d.month_idx""",
        fx.PANEL_SQL,
    ),
)
def as_of_join(spark, sf_dir):
    panel = fx.panel(spark, sf_dir).select("account_id", "month_idx", "dpd")
    events = panel.filter("dpd >= 30").withColumnRenamed("dpd", "last_dpd")
    return sampling.as_of_join(panel.drop("dpd"), events, ["account_id"], "month_idx", "month_idx", ["last_dpd"])


@query(
    "q_point_in_time_join",
    fx.with_views(
        """
SELECT t.account_id, t.obs_point, t.target, (SELECT max(dpd) FROM panel p WHERE p.account_id = t.account_id
       AND p.month_idx BETWEEN t.obs_point - 2 AND t.obs_point) AS max_dpd_3m FROM target t""",
        *POPULATION,
    ),
)
def point_in_time_join(spark, sf_dir):
    from cohortlake.operators import features as fe

    panel = fx.panel(spark, sf_dir)
    target = pop.target_behaviour(pop.cohort_frame(panel)).select("account_id", "obs_point", "target")
    wanted = [f for f in fe.FEATURES if f.name == "max_dpd_3m"]
    features = fe.panel_features(panel, features=wanted).select("account_id", "obs_point", "max_dpd_3m")
    return sampling.join_features(target, features, ["account_id"])


@query(
    "q_stratified_split",
    fx.with_views(
        """
SELECT loan_id, target, CASE WHEN h <= (SELECT quantile_cont(h, 0.7) FROM hashed s WHERE s.target = hashed.target)
                             THEN 'train' ELSE 'test' END AS split FROM hashed""",
        fx.PORTFOLIO_SQL,
        "hashed AS (SELECT loan_id, target, CAST(CAST('0x' || substr(md5('42|' || loan_id), 1, 8) AS BIGINT) % 2147483647 AS DOUBLE) AS h FROM portfolio)",
    ),
)
def stratified_split(spark, sf_dir):
    rows = fx.portfolio(spark, sf_dir).select("loan_id", "target")
    return sampling.stratified_split(rows, "loan_id", "target", [0, 1])


@query(
    "q_down_sample",
    fx.with_views(
        """
SELECT loan_id, target, CASE WHEN target = 1 THEN 1.0::DOUBLE ELSE 4.0::DOUBLE END AS weight FROM portfolio
WHERE target = 1 OR CAST('0x' || substr(md5('42|' || loan_id), 1, 8) AS BIGINT) % 100 < 25""",
        fx.PORTFOLIO_SQL,
    ),
)
def down_sample(spark, sf_dir):
    return sampling.down_sample(fx.portfolio(spark, sf_dir).select("loan_id", "target"), "loan_id", "target", 25)


# -- external tradelines ------------------------------------------------------------------------

COLUMNS = tradelines.TradelineColumns(
    "customer_id", "tradeline_id", "kind", "state", "opened_day", "debt", "credit_limit", "overdue", "prolonged"
)


@query(
    "q_tradeline_features",
    fx.with_views(
        f"""
SELECT customer_id, count(*) AS n_tradelines_total, count(*) FILTER (WHERE state = 'Active') AS n_tradelines_active,
       count(*) FILTER (WHERE state = 'Closed') AS n_tradelines_closed, count(*) FILTER (WHERE kind = '1') AS n_revolving,
       count(*) FILTER (WHERE kind IN ('3', '4')) AS n_installment, count(*) FILTER (WHERE kind = '2') AS n_mortgage,
       count(*) FILTER (WHERE kind = '5') AS n_other, {r("count(*) FILTER (WHERE kind = '1') / count(*)")} AS pct_revolving_of_total,
       {r('max(entropy)')} AS trade_mix_entropy, {r('max(-opened_day) / 30.44')} AS oldest_tradeline_months,
       {r('avg(-opened_day) / 30.44')} AS avg_tradeline_age_months, {r('min(-opened_day) / 30.44')} AS newest_tradeline_months,
       count(*) FILTER (WHERE -opened_day <= 6 * 30.44) AS n_tradelines_opened_6m,
       count(*) FILTER (WHERE -opened_day <= 12 * 30.44) AS n_tradelines_opened_12m,
       {r("sum(debt) FILTER (WHERE kind = '1') / nullif(sum(credit_limit) FILTER (WHERE kind = '1'), 0)")} AS bureau_util_revolving,
       {r('sum(debt)')} AS bureau_total_debt, {r('sum(credit_limit)')} AS bureau_total_limit,
       {r('max(debt / nullif(credit_limit, 0))')} AS max_single_tradeline_util,
       count(*) FILTER (WHERE debt / nullif(credit_limit, 0) > 0.9) AS n_maxed_tradelines, {r('sum(overdue)')} AS bureau_amt_overdue,
       count(*) FILTER (WHERE state = 'Bad debt') AS bureau_n_bad_debt, count(*) FILTER (WHERE prolonged > 0) AS bureau_n_prolonged
FROM external JOIN (SELECT customer_id, -sum(p * ln(p)) AS entropy
                    FROM (SELECT customer_id, count(*) / sum(count(*)) OVER (PARTITION BY customer_id) AS p FROM external GROUP BY customer_id, kind)
                    GROUP BY customer_id) USING (customer_id)
GROUP BY customer_id""",
        fx.EXTERNAL_SQL,
    ),
)
def tradeline_features(spark, sf_dir):
    return rounded(
        tradelines.tradeline_features(fx.external_tradelines(spark, sf_dir), COLUMNS, ["1"], ["2"], ["3", "4"])
    )


@query(
    "q_tradeline_delinquency",
    fx.with_views(
        "SELECT customer_id, "
        + ", ".join(
            f"count(*) FILTER (WHERE age < {m} AND b {cond}) AS bureau_n_{name}_{m}m"
            for m in (12, 24)
            for name, cond in (("30dpd", "= 1"), ("60dpd", "= 2"), ("90plus", ">= 3"))
        )
        + """, min(age) FILTER (WHERE b >= 1) AS bureau_months_since_last_delinq, max(b) AS bureau_max_bucket_ever,
       max(b) FILTER (WHERE age < 12) AS bureau_worst_status_12m
FROM (SELECT customer_id, 0 - (month_idx - 1) AS age, CAST(CASE upper(trim(status)) WHEN 'C' THEN 0 WHEN 'X' THEN NULL WHEN '?' THEN NULL
                                                     ELSE CAST(status AS INT) END AS INT) AS b FROM tradelines)
WHERE age >= 0 GROUP BY customer_id""",
        fx.TRADELINES_SQL,
    ),
)
def tradeline_delinquency(spark, sf_dir):
    from cohortlake.operators import cleaning

    lines = fx.tradelines(spark, sf_dir)
    decoded = cleaning.decode_status_panel(lines.drop("customer_id"), "status", "month_idx")
    return tradelines.delinquency_features(decoded, lines, COLUMNS, "month_idx_aligned", now=0)


@query(
    "q_score_features",
    """
SELECT doc_id, round(list_avg(v), 6) AS ext_score_mean, CAST(list_min(v) AS DOUBLE) AS ext_score_min,
       round(list_stddev_samp(v), 6) AS ext_score_std, CAST(3 - len(v) AS INT) AS ext_score_n_missing
FROM (SELECT d.doc_id, [x for x in [CAST(l.quality AS DOUBLE), CAST(l.toxic AS DOUBLE), CAST(d.n_chars AS DOUBLE)] if x IS NOT NULL] AS v
      FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)""",
)
def score_features(spark, sf_dir):
    docs = fx.docs_labeled(spark, sf_dir).select(
        "doc_id", *[F.col(c).cast("double").alias(c) for c in ("quality", "toxic", "n_chars")]
    )
    out = tradelines.score_features(docs, ["quality", "toxic", "n_chars"]).drop("quality", "toxic", "n_chars")
    return rounded(out, 6)
