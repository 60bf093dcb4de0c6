"""Cohorts, waterfall, targets, features and their reports on the supplier panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import fixtures as fx
from catalogue.registry import big, query, r, rounded
from cohortlake import config as cfg
from cohortlake.operators import features as fe
from cohortlake.operators import population as pop
from cohortlake.operators import reports
from cohortlake.plans import behaviour
from cohortlake.sources.workspace import materialise

# -- cohort frame and population ---------------------------------------------------------

COHORTS_SQL = "cohorts AS (SELECT 'dev' AS cohort, -13 AS obs_point UNION ALL SELECT 'oot', -19)"
KEYS = "account_id, customer_id, product_type"
_OBS = "FILTER (WHERE month_idx BETWEEN obs_point - 11 AND obs_point)"
_PERF = "FILTER (WHERE month_idx BETWEEN obs_point + 1 AND obs_point + 12)"
_AT = "FILTER (WHERE month_idx = obs_point)"
FRAME_SQL = f"""
frame AS (
  SELECT *, obs_point - first_month AS tenure_at_obs FROM (
    SELECT {KEYS}, cohort, obs_point, min(month_idx) AS first_month, max(month_idx) AS last_month,
           count(*) {_OBS} AS n_months_obs, max(dpd) {_OBS} AS max_dpd_obs, max(balance) {_OBS} AS max_balance_obs,
           sum(drawings) {_OBS} AS sum_drawings_obs, max(utilisation) {_OBS} AS max_utilisation_obs,
           max(dpd) {_AT} AS dpd_at_obs, bool_or(contract_status = 'Completed') {_AT} AS is_closed_at_obs,
           count(*) {_PERF} AS n_months_perf, max(dpd) {_PERF} AS max_dpd_perf
    FROM panel CROSS JOIN cohorts GROUP BY {KEYS}, cohort, obs_point))"""

STEPS_SQL = [
    "first_month IS NOT NULL",
    "tenure_at_obs >= 6",
    "n_months_obs >= 12",
    "n_months_perf >= 6",
    "coalesce(is_closed_at_obs, false) = false",
    "coalesce(dpd_at_obs, 0) < 90",
    "(product_type <> 'CC' OR coalesce(max_balance_obs, 0) > 0 OR coalesce(sum_drawings_obs, 0) > 0)",
]
TARGET_SQL = f"""
target AS (
  SELECT {KEYS}, cohort, obs_point, CASE WHEN w >= 90 THEN 1 ELSE 0 END AS target,
         w >= 30 AND w < 90 AS is_indeterminate, w AS max_dpd_perf, max_dpd_obs, dpd_at_obs, tenure_at_obs,
         n_months_obs, n_months_perf, first_month, last_month
  FROM (SELECT *, coalesce(max_dpd_perf, 0) AS w FROM frame WHERE {' AND '.join(STEPS_SQL)}))"""
POPULATION = (fx.PANEL_SQL, COHORTS_SQL, FRAME_SQL, TARGET_SQL)


def _target(spark, sf_dir):
    return pop.target_behaviour(pop.cohort_frame(fx.panel(spark, sf_dir)))


@query(
    "q_cohort_frame",
    fx.with_views(
        f"""
SELECT {KEYS}, cohort, obs_point, first_month, last_month, n_months_obs, max_dpd_obs,
       {r('max_balance_obs', 2)} AS max_balance_obs, {r('sum_drawings_obs', 2)} AS sum_drawings_obs,
       {r('max_utilisation_obs', 6)} AS max_utilisation_obs, dpd_at_obs, is_closed_at_obs, n_months_perf, max_dpd_perf,
       tenure_at_obs FROM frame""",
        *POPULATION[:3],
    ),
)
def cohort_frame(spark, sf_dir):
    frame = pop.cohort_frame(fx.panel(spark, sf_dir))
    digits = {"max_balance_obs": 2, "sum_drawings_obs": 2, "max_utilisation_obs": 6}
    return frame.withColumns({c: F.round(c, d) for c, d in digits.items()})


def _waterfall_sql() -> str:
    labels = [("start", "start"), *[(s.name, s.kind) for s in pop.EXCLUSION_STEPS]]
    steps = []
    for i, (name, kind) in enumerate(labels):
        passed = " AND ".join(STEPS_SQL[:i]) or "true"
        steps.append(
            f"SELECT cohort, {i} AS step, '{name}' AS name, '{kind}' AS kind, "
            f"count(*) FILTER (WHERE {passed}) AS n_out FROM frame GROUP BY cohort"
        )
    return f"""
SELECT cohort, step, name, kind, n_in, n_in - n_out AS n_dropped, n_out,
       CASE WHEN n_in = 0 THEN 0.0 ELSE round((n_in - n_out) / n_in, 6) END AS pct_dropped
FROM (SELECT *, coalesce(lag(n_out) OVER (PARTITION BY cohort ORDER BY step), n_out) AS n_in
      FROM ({' UNION ALL '.join(steps)}))"""


@query("q_waterfall", fx.with_views(_waterfall_sql(), *POPULATION[:3]))
def waterfall(spark, sf_dir):
    return pop.Waterfall().report(pop.cohort_frame(fx.panel(spark, sf_dir)))


@query("q_target_behaviour", fx.with_views("SELECT * FROM target", *POPULATION))
def target_behaviour(spark, sf_dir):
    return _target(spark, sf_dir)


@query(
    "q_waterfall_account_list",
    fx.with_views(
        """
SELECT cohort, count(*) AS n_listed, count(first_month) AS n_with_history
FROM (SELECT s_suppkey AS account_id, cohort FROM supplier CROSS JOIN cohorts
      UNION ALL SELECT s_suppkey + 1000000, cohort FROM supplier CROSS JOIN cohorts) a
LEFT JOIN frame USING (account_id, cohort) GROUP BY cohort""",
        *POPULATION[:3],
    ),
)
def waterfall_account_list(spark, sf_dir):
    """An outside account list as starting population: half of it has no panel rows."""
    supplier = fx.table(spark, sf_dir, "supplier")
    product = F.when(F.col("s_suppkey") % 3 == 0, "POS").otherwise("CC")
    known = supplier.select(
        F.col("s_suppkey").alias("account_id"), F.col("s_nationkey").alias("customer_id"), product.alias("product_type")
    )
    listed = known.unionByName(known.withColumn("account_id", F.col("account_id") + 1_000_000))
    report = pop.Waterfall().report(pop.cohort_frame(fx.panel(spark, sf_dir), accounts=listed))
    return report.filter("step = 1").select(
        "cohort", F.col("n_in").alias("n_listed"), F.col("n_out").alias("n_with_history")
    )


@query(
    "q_cohort_report",
    fx.with_views(
        f"""
SELECT cohort, product_type, count(*) AS n_accounts, {big('sum(target)')} AS n_bads, round(avg(target), 4) AS bad_rate,
       {big('sum(CAST(is_indeterminate AS INT))')} AS n_indeterminate, round(avg(tenure_at_obs), 1) AS avg_tenure_months
FROM target GROUP BY cohort, product_type""",
        *POPULATION,
    ),
)
def cohort_report(spark, sf_dir):
    return reports.cohort_report(_target(spark, sf_dir))


@query(
    "q_cohort_rates",
    fx.with_views(
        f"""
SELECT cohort, count(*) AS n_accounts, {big('sum(target)')} AS n_bads,
       count(*) FILTER (WHERE is_indeterminate) AS n_indeterminate, round(avg(target), 6) AS bad_rate
FROM target GROUP BY cohort""",
        *POPULATION,
    ),
)
def cohort_rates(spark, sf_dir):
    return rounded(pop.cohort_rates(_target(spark, sf_dir)), 6)


@query(
    "q_drift_gate",
    fx.with_views(
        """
SELECT CASE WHEN bd >= 1000 THEN 'PASS' ELSE 'FAIL' END AS status, 'min-bads' AS "check", CAST(bd AS DOUBLE) AS value,
       CAST(1000 AS DOUBLE) AS threshold FROM c
UNION ALL SELECT CASE WHEN bd // 180 >= 10 THEN 'PASS' ELSE 'WARN' END, 'scorecard-length', bd // 180, 10 FROM c
UNION ALL SELECT CASE WHEN drift > 0.3 THEN 'WARN' ELSE 'PASS' END, 'bad-rate-drift', round(drift, 6), 0.3 FROM c""",
        *POPULATION,
        """t AS (
  SELECT count(*) FILTER (WHERE cohort = 'dev') AS nd, count(*) FILTER (WHERE cohort = 'oot') AS no,
         count(*) FILTER (WHERE cohort = 'dev' AND target = 1) AS bd,
         count(*) FILTER (WHERE cohort = 'oot' AND target = 1) AS bo FROM target),
c AS (SELECT *, CASE WHEN bd > 0 THEN abs(bd / nd - bo / no) / (bd / nd) ELSE 0 END AS drift FROM t)""",
    ),
)
def drift_gate(spark, sf_dir):
    return rounded(pop.population_gate(_target(spark, sf_dir)), 6)


# -- application target: customers with orders, outcome = low balance -----------------------


@query(
    "q_target_application",
    f"""
WITH p AS (
  SELECT o_custkey, count(*) AS n_panel_months, count(DISTINCT o_orderpriority) AS n_accounts,
         count(DISTINCT o_orderstatus) AS n_product_types,
         min(CAST(year(o_orderdate)*12 + month(o_orderdate) - (2001*12 + 12) AS INT)) AS first_month
  FROM orders GROUP BY 1)
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS target, n_panel_months, n_accounts, n_product_types,
       first_month, false AS is_indeterminate
FROM customer JOIN p ON o_custkey = c_custkey""",
)
def target_application(spark, sf_dir):
    cols = cfg.PanelColumns(account="o_orderpriority", customer="c_custkey", product="o_orderstatus", month="m")
    orders = fx.table(spark, sf_dir, "orders")
    month = (F.year("o_orderdate") * 12 + F.month("o_orderdate") - (2001 * 12 + 12)).cast("int")
    panel = orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderpriority", "o_orderstatus", month.alias("m"))
    outcome = (F.col("c_acctbal") < 0).cast("int")
    applications = fx.table(spark, sf_dir, "customer").select("c_custkey", outcome.alias("TARGET"))
    return pop.target_application(applications, panel, cols=cols)


@query(
    "q_union_cohorts",
    fx.with_views(
        """
SELECT account_id, cohort, target, NULL AS n_months_perf FROM target WHERE cohort = 'dev'
UNION ALL SELECT account_id, cohort, NULL, n_months_perf FROM target WHERE cohort = 'oot'""",
        *POPULATION,
    ),
)
def union_cohorts(spark, sf_dir):
    target = _target(spark, sf_dir)
    dev = target.filter("cohort = 'dev'").select("account_id", "cohort", "target")
    oot = target.filter("cohort = 'oot'").select("account_id", "cohort", "n_months_perf")
    return pop.union_cohorts([dev, oot], fill_missing=True)


# -- features ----------------------------------------------------------------------------


def _card(expression: str, corrected: bool) -> str:
    return f"CASE WHEN product_type = 'CC' THEN {expression} END" if corrected else expression


def _panel_features_sql(corrected: bool) -> dict[str, str]:
    """Feature name -> SQL over the rows of one account and cohort (age = months before observation)."""
    out: dict[str, str] = {}

    def f(n: int) -> str:
        return f"FILTER (WHERE age < {n})"

    def hits(condition: str, n: int = 12) -> str:
        return f"{big(f'sum(CASE WHEN {condition} THEN 1 ELSE 0 END) {f(n)}')}"

    def card(name: str, expression: str) -> None:
        out[name] = _card(expression, corrected)

    def slope(column: str) -> str:
        if corrected:
            return f"regr_slope({column}, month_idx) {f(6)}"
        return f"covar_pop({column}, month_idx) {f(6)} / nullif(var_pop(month_idx) {f(6)}, 0)"

    for n in (3, 6, 12):
        out[f"max_dpd_{n}m"] = f"max(dpd) {f(n)}"
        for t in (30, 60, 90):
            out[f"n_months_dpd{t}_{n}m"] = hits(f"dpd >= {t}", n)
        card(f"util_avg_{n}m", f"avg(utilisation) {f(n)}")
        card(f"util_max_{n}m", f"max(utilisation) {f(n)}")
        card(f"bal_avg_{n}m", f"avg(balance) {f(n)}")
        card(f"spend_avg_{n}m", f"avg(drawings) {f(n)}")
        card(f"n_txn_{n}m", big(f"sum(drawings_cnt) {f(n)}"))
        card(f"cash_adv_amt_{n}m", f"sum(drawings_atm) {f(n)}")
        card(f"cash_adv_cnt_{n}m", big(f"sum(drawings_atm_cnt) {f(n)}"))
    out["months_since_last_delinq"] = "min(age) FILTER (WHERE dpd >= 30)"
    out["n_consecutive_clean_months"] = "coalesce(min(age) FILTER (WHERE dpd >= 30), count(*))"
    card("util_at_obs", "max(utilisation) FILTER (WHERE age = 0)")
    card("util_min_12m", "min(utilisation)")
    card("util_std_12m", "stddev_samp(utilisation)")
    card("util_trend_slope_6m", slope("utilisation"))
    card("n_months_util_gt80_12m", hits("utilisation > 0.8"))
    card("n_months_util_gt100_12m", hits("utilisation > 1.0"))
    card("bal_max_12m", "max(balance)")
    card("bal_min_12m", "min(balance)")
    card("bal_trend_slope_6m", slope("balance"))
    card("bal_growth_6m", "max(balance) FILTER (WHERE age = 0) - max(balance) FILTER (WHERE age = 5)")
    card("spend_std_12m", "stddev_samp(drawings)")
    card("n_zero_spend_months_12m", hits("coalesce(drawings, 0) = 0"))
    for name in ("pct_atm_drawings_12m", "cash_adv_to_spend_ratio_12m"):
        card(name, "sum(drawings_atm) / nullif(sum(drawings), 0)")
    card("pct_pos_drawings_12m", "sum(drawings_pos) / nullif(sum(drawings), 0)")
    card("cash_adv_trend_6m", slope("drawings_atm"))
    card("n_overlimit_months_12m", hits("is_overlimit"))
    card("max_overlimit_amt_12m", "max(overlimit_amount)")
    card("months_since_last_overlimit", "min(age) FILTER (WHERE is_overlimit)")
    card("n_min_payment_only_12m", hits("min_due > 0 AND payment <= min_due * 1.05"))
    return out


def _payments_features_sql(corrected: bool) -> str:
    seen = "NOT coalesce(days_entry_payment >= (obs_point + 1) * 30.44, false)" if corrected else "true"
    return f"""
pf AS (
  SELECT account_id, cohort, sum(CASE WHEN NOT is_late THEN 1 ELSE 0 END) / count(*) AS ontime_pay_ratio_12m,
         avg(CASE WHEN days_late > 0 THEN days_late ELSE 0 END) AS avg_days_late_12m, max(days_late) AS max_days_late_12m,
         {big('sum(CAST(is_late AS INT))')} AS n_late_payments_12m,
         {big('sum(CAST(is_short_payment AS INT))')} AS n_short_payments_12m,
         sum(amt_payment) / nullif(sum(amt_instalment), 0) AS pay_shortfall_ratio_12m,
         stddev_samp(days_late) AS pay_regularity_std_12m
  FROM (SELECT account_id, cohort, amt_instalment, CASE WHEN {seen} THEN days_late END AS days_late,
               CASE WHEN {seen} THEN is_late END AS is_late, CASE WHEN {seen} THEN is_short_payment END AS is_short_payment,
               CASE WHEN {seen} THEN amt_payment END AS amt_payment
        FROM payments CROSS JOIN cohorts
        WHERE days_instalment >= (obs_point - 11) * 30.44 AND days_instalment < (obs_point + 1) * 30.44)
  GROUP BY account_id, cohort)"""


CUSTOMER_SQL = """
cf AS (
  SELECT customer_id, cohort, count(DISTINCT account_id) AS cust_n_accounts,
         count(DISTINCT product_type) AS cust_n_product_types, max(obs_point - month_idx) AS cust_tenure_months,
         sum(balance) FILTER (WHERE month_idx = obs_point) AS cust_total_balance
  FROM panel CROSS JOIN cohorts WHERE month_idx <= obs_point GROUP BY customer_id, cohort)"""


def _views(corrected: bool) -> tuple[str, ...]:
    panel_columns = ", ".join(f"{sql} AS {name}" for name, sql in _panel_features_sql(corrected).items())
    panel_features = f"""
f AS (
  SELECT {KEYS}, cohort, {panel_columns}
  FROM (SELECT *, obs_point - month_idx AS age FROM panel CROSS JOIN cohorts)
  WHERE age BETWEEN 0 AND 11 GROUP BY {KEYS}, cohort),
feat AS (
  SELECT t.account_id, t.customer_id, t.product_type, t.cohort, t.obs_point, t.tenure_at_obs AS acct_tenure_months,
         t.n_months_obs AS n_months_observed, f.* EXCLUDE (account_id, customer_id, product_type, cohort),
         pf.* EXCLUDE (account_id, cohort), cf.* EXCLUDE (customer_id, cohort),
         util_avg_3m - util_avg_12m AS util_delta_3m_vs_12m, max_dpd_3m - max_dpd_12m AS dpd_trend_3m_vs_12m,
         max_dpd_12m >= 30 AS ever_delinquent
  FROM target t
  LEFT JOIN f ON f.account_id = t.account_id AND f.customer_id = t.customer_id
             AND f.product_type = t.product_type AND f.cohort = t.cohort
  LEFT JOIN pf ON pf.account_id = t.account_id AND pf.cohort = t.cohort
  LEFT JOIN cf ON cf.customer_id = t.customer_id AND cf.cohort = t.cohort)"""
    return (*POPULATION, fx.PAYMENTS_SQL, _payments_features_sql(corrected), CUSTOMER_SQL, panel_features)


_DOUBLES = {
    *(f"{n}_{m}m" for n in ("util_avg", "util_max", "bal_avg", "spend_avg", "cash_adv_amt") for m in (3, 6, 12)),
    "util_at_obs", "util_min_12m", "util_std_12m", "util_trend_slope_6m", "util_delta_3m_vs_12m", "bal_max_12m",
    "bal_min_12m", "bal_trend_slope_6m", "bal_growth_6m", "spend_std_12m", "pct_atm_drawings_12m",
    "pct_pos_drawings_12m", "cash_adv_to_spend_ratio_12m", "cash_adv_trend_6m", "max_overlimit_amt_12m",
    "ontime_pay_ratio_12m", "avg_days_late_12m", "pay_shortfall_ratio_12m", "pay_regularity_std_12m",
    "cust_total_balance",
}


def _features_sql(features, corrected: bool = True) -> str:
    columns = ", ".join(f"{r(f.name)} AS {f.name}" if f.name in _DOUBLES else f.name for f in features)
    return fx.with_views(f"SELECT {KEYS}, cohort, obs_point, {columns} FROM feat", *_views(corrected))


def _features(spark, sf_dir, features=fe.FEATURES, policy=fe.CORRECTED):
    panel, payments = fx.panel(spark, sf_dir), fx.payments(spark, sf_dir)
    target = pop.target_behaviour(pop.cohort_frame(panel))
    return fe.behaviour_features(target, panel, payments, policy=policy, features=features)


def _family(*families: str, needs: tuple[str, ...] = ()):
    return [f for f in fe.FEATURES if f.family in families or f.name in needs]


def _register_family(name: str, features) -> None:
    @query(name, _features_sql(features))
    def run(spark, sf_dir):
        return rounded(_features(spark, sf_dir, features))


_register_family("q_feat_delinquency", _family(fe.DELINQUENCY))
_register_family("q_feat_utilisation", _family(fe.UTILISATION))
_register_family("q_feat_balance_spend", _family(fe.BALANCE, fe.SPEND))
_register_family("q_feat_distress", _family(fe.DISTRESS))
_register_family("q_feat_payment", _family(fe.PAYMENT))
_register_family("q_feat_customer", _family(fe.TENURE))


@query("q_features_all", _features_sql(fe.FEATURES))
def features_all(spark, sf_dir):
    """The panel is stored first, as a pipeline would: three blocks read it."""
    panel = materialise(fx.panel(spark, sf_dir), "panel")
    return rounded(behaviour.feature_table(panel, fx.payments(spark, sf_dir)))


@query("q_features_as_published", _features_sql(fe.FEATURES, corrected=False))
def features_as_published(spark, sf_dir):
    return rounded(_features(spark, sf_dir, policy=fe.AS_PUBLISHED))


@query(
    "q_feature_means",
    fx.with_views(
        """
SELECT cohort, product_type, count(*) AS n_accounts, round(avg(util_avg_12m), 4) AS avg_util_12m,
       round(avg(max_dpd_12m), 2) AS avg_max_dpd_12m, round(avg(cash_adv_to_spend_ratio_12m), 4) AS avg_cash_adv_share,
       round(avg(ontime_pay_ratio_12m), 4) AS avg_ontime_ratio, round(avg(n_overlimit_months_12m), 2) AS avg_overlimit_months
FROM feat GROUP BY cohort, product_type""",
        *_views(True),
    ),
)
def feature_means(spark, sf_dir):
    return fe.feature_means(_features(spark, sf_dir))


@query(
    "q_leakage_check",
    fx.with_views(
        """
SELECT CASE WHEN i / nullif(n, 0) > 0.5 THEN 'FAIL' ELSE 'PASS' END AS status, 'leakage' AS "check",
       i AS n_identical, n AS n_total, round(coalesce(i / nullif(n, 0), 0), 6) AS share
FROM (SELECT count(*) FILTER (WHERE max_dpd_12m = max_dpd_perf) AS i, count(*) AS n
      FROM feat JOIN target USING (account_id, customer_id, product_type, cohort)
      WHERE cohort = 'dev' AND max_dpd_perf > 0
        AND EXISTS (SELECT 1 FROM panel p WHERE p.account_id = feat.account_id AND p.month_idx > -13))""",
        *_views(True),
    ),
)
def leakage_check(spark, sf_dir):
    panel, payments = fx.panel(spark, sf_dir), fx.payments(spark, sf_dir)
    target = _target(spark, sf_dir)
    wanted = [f for f in fe.FEATURES if f.name == "max_dpd_12m"]
    features = fe.behaviour_features(target, panel, payments, features=wanted)
    return rounded(fe.leakage_report(features, target, panel), 6)


def _dictionary_sql() -> str:
    parts = []
    for family, features in fe.by_family().items():
        signs = {d: sum(f.direction == d for f in features) for d in fe.DIRECTIONS}
        filled = " + ".join(f"count({f.name})" for f in features)
        parts.append(
            f"SELECT '{family}' AS family, {big(len(features))} AS catalogued, {big(len(features))} AS built, "
            f"{big(signs['+'])} AS expect_riskier, {big(signs['-'])} AS expect_safer, {big(signs['?'])} AS no_prior, "
            f"{big(filled)} AS n_values FROM feat"
        )
    return fx.with_views(" UNION ALL ".join(parts), *_views(True))


@query("q_feature_dictionary", _dictionary_sql())
def feature_dictionary(spark, sf_dir):
    """The catalogue against the feature table: what is built and how well it is filled."""
    built = _features(spark, sf_dir)
    return fe.dictionary_coverage(fe.feature_dictionary(spark, built.columns), built)
