"""Cleaning, parsing and panel operators on the star-schema tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import fixtures as fx
from catalogue.registry import big, query, r, rounded
from cohortlake.functions import columns as cf
from cohortlake.operators import cleaning, reports
from cohortlake.operators import panel as pnl

# -- sentinels, caps -------------------------------------------------------------------


@query(
    "q_sentinel_scrub",
    """
SELECT p_partkey, CAST(nullif(CAST(p_size AS DOUBLE), 24) AS INT) AS "DAYS_SIZE", p_size = 24 AS days_size_is_missing
FROM part""",
)
def sentinel_scrub(spark, sf_dir):
    part = fx.table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("double").alias("DAYS_SIZE"))
    # The flag threshold is lowered: 24 is one of fifty sizes and stays below five percent.
    counted = part.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("DAYS_SIZE") == 24).alias("hits")).first()
    hits = {"DAYS_SIZE": counted["hits"]}
    scrubbed, _ = cleaning.scrub_sentinels(part, hits, counted["n"], sentinel=24, min_share=0.001)
    return cleaning.narrow_days_to_int(scrubbed)


@query(
    "q_cap_flag",
    """
WITH q AS (SELECT quantile_cont(value, 0.995) AS cap FROM events)
SELECT event_id, round(CASE WHEN value > cap THEN cap ELSE value END, 4) AS value, value > cap AS value_was_capped
FROM events, q""",
)
def cap_flag(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events").select("event_id", "value")
    return rounded(cleaning.cap_outliers(events, {"value": 0.995}, exact=True)[0])


# The published threshold is approximate by design: rows only.
@query("q_cap_flag_approx")
def cap_flag_approx(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events").select("event_id", "value")
    return cleaning.cap_outliers(events, {"value": 0.995})[0]


# -- status panel ----------------------------------------------------------------------

DECODED_SQL = """
decoded AS (
  SELECT *, CASE upper(trim(status)) WHEN 'C' THEN 0 WHEN '0' THEN 0 WHEN '1' THEN 1 WHEN '2' THEN 2
                 WHEN '3' THEN 3 WHEN '4' THEN 4 WHEN '5' THEN 5 END AS status_bucket,
         month_idx - 1 AS month_idx_aligned, upper(trim(status)) = 'C' AS is_closed,
         upper(trim(status)) = 'X' AS is_status_unknown
  FROM tradelines)"""


@query(
    "q_status_decode",
    fx.with_views(
        "SELECT *, status_bucket >= 1 AS is_delinquent, status_bucket >= 4 AS is_90_plus FROM decoded",
        fx.TRADELINES_SQL,
        DECODED_SQL,
    ),
)
def status_decode(spark, sf_dir):
    return cleaning.decode_status_panel(fx.tradelines(spark, sf_dir), "status", "month_idx")


@query(
    "q_status_report",
    fx.with_views(
        """
SELECT status, status_bucket, is_closed, is_status_unknown, status_bucket >= 1 AS is_delinquent, count(*) AS n_rows
FROM decoded GROUP BY ALL""",
        fx.TRADELINES_SQL,
        DECODED_SQL,
    ),
)
def status_report(spark, sf_dir):
    decoded = cleaning.decode_status_panel(fx.tradelines(spark, sf_dir), "status", "month_idx")
    return reports.status_report(decoded, "status")


# -- payments ----------------------------------------------------------------------------


@query(
    "q_payment_derive",
    fx.with_views(
        f"""
SELECT account_id, days_instalment, days_entry_payment, {r('amt_instalment')} AS amt_instalment,
       {r('amt_payment')} AS amt_payment, days_late, is_late, {r('payment_shortfall')} AS payment_shortfall,
       is_short_payment FROM payments""",
        fx.PAYMENTS_SQL,
    ),
)
def payment_derive(spark, sf_dir):
    return rounded(fx.payments(spark, sf_dir))


# -- pooled panel ------------------------------------------------------------------------

POOLED = {
    "account_id": None, "customer_id": None, "product_type": None, "month_idx": None, "contract_status": None,
    "dpd": None, "has_valid_limit": None, "is_overlimit": None, "utilisation": 6, "overlimit_amount": 4,
    "balance": 4, "credit_limit": 4,
}


@query(
    "q_pooled_panel",
    fx.with_views(
        "SELECT " + ", ".join(f"{r(c, d)} AS {c}" if d else c for c, d in POOLED.items()) + " FROM panel",
        fx.PANEL_SQL,
    ),
)
def pooled_panel(spark, sf_dir):
    """Split into the two product panels, align each, and pool them again."""
    from cohortlake.config import PanelColumns

    raw, cols = fx.raw_panel(spark, sf_dir), PanelColumns()
    card = raw.filter(F.col("product_type") == "CC").drop("product_type")
    pos = raw.filter(F.col("product_type") == "POS").drop("product_type", "balance", "credit_limit")
    parts = [
        pnl.align_panel(card, "CC", True, cols, tuple(POOLED)),
        pnl.align_panel(pos, "POS", False, cols, tuple(POOLED)),
    ]
    pooled = parts[0].unionByName(parts[1])
    return pooled.withColumns({c: F.round(c, d) for c, d in POOLED.items() if d})


@query(
    "q_panel_report",
    fx.with_views(
        f"""
SELECT product_type, count(*) AS n_rows, count(DISTINCT account_id) AS n_accounts,
       count(DISTINCT customer_id) AS n_customers, min(month_idx) AS min_month, max(month_idx) AS max_month,
       round(avg(utilisation), 4) AS avg_utilisation, {big('sum(CAST(is_overlimit AS INT))')} AS n_overlimit_months,
       {big('sum(CASE WHEN dpd >= 90 THEN 1 END)')} AS n_months_90plus
FROM panel GROUP BY product_type""",
        fx.PANEL_SQL,
    ),
)
def panel_report(spark, sf_dir):
    return reports.panel_report(fx.panel(spark, sf_dir))


@query(
    "q_trailing_12m_all_months",
    fx.with_views(
        f"""
SELECT account_id, customer_id, product_type, month_idx,
       {big('count(*) OVER w')} AS n_months_12m, max(dpd) OVER w AS max_dpd_12m,
       {r('sum(balance) OVER w', 6)} AS bal_sum_12m, {r('avg(balance) OVER w', 6)} AS bal_avg_12m
FROM panel WINDOW w AS (PARTITION BY account_id, customer_id, product_type ORDER BY month_idx
                        RANGE BETWEEN 11 PRECEDING AND CURRENT ROW)""",
        fx.PANEL_SQL,
    ),
)
def trailing_12m_all_months(spark, sf_dir):
    return rounded(pnl.trailing_all_months(fx.panel(spark, sf_dir), 12), 6)


@query(
    "q_state_at_obs",
    fx.with_views(
        "SELECT account_id, dpd AS dpd_at_obs, contract_status AS status_at_obs FROM panel WHERE month_idx = -13",
        fx.PANEL_SQL,
    ),
)
def state_at_obs(spark, sf_dir):
    wanted = {"dpd": "dpd_at_obs", "contract_status": "status_at_obs"}
    return pnl.state_at(fx.panel(spark, sf_dir), -13, wanted, "account_id")


@query(
    "q_window_filters",
    fx.with_views(
        """
SELECT 'window' AS part, count(*) AS n FROM panel WHERE month_idx BETWEEN -24 AND -13
UNION ALL SELECT 'history', count(*) FROM panel WHERE month_idx <= -13
UNION ALL SELECT 'future', count(*) FROM panel WHERE month_idx > -13
UNION ALL SELECT 'days', count(*) FROM payments WHERE days_instalment >= -24*30.44 AND days_instalment < -12*30.44""",
        fx.PANEL_SQL,
        fx.PAYMENTS_SQL,
    ),
)
def window_filters(spark, sf_dir):
    panel, payments = fx.panel(spark, sf_dir), fx.payments(spark, sf_dir)
    parts = {
        "window": pnl.months_between(panel, (-24, -13)),
        "history": pnl.history_until(panel, -13),
        "future": pnl.future_after(panel, -13),
        "days": pnl.days_in_window(payments, -13, 12, "days_instalment"),
    }
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(p).alias("part"), "n") for p, df in parts.items()]
    out = counts[0]
    for extra in counts[1:]:
        out = out.unionByName(extra)
    return out


# -- fills -------------------------------------------------------------------------------


@query(
    "q_fill_mean",
    fx.with_views(
        "SELECT doc_id, round(coalesce(CAST(quality AS DOUBLE), (SELECT avg(quality) FROM docs_labeled)), 6) AS quality "
        "FROM docs_labeled",
        fx.DOCS_SQL,
    ),
)
def fill_mean(spark, sf_dir):
    docs = fx.docs_labeled(spark, sf_dir).select("doc_id", F.col("quality").cast("double").alias("quality"))
    return rounded(cleaning.fill_with_mean(docs, ["quality"]), 6)


@query(
    "q_fill_other",
    fx.with_views("SELECT doc_id, coalesce(quality, n_chars) AS quality, n_chars FROM docs_labeled", fx.DOCS_SQL),
)
def fill_other(spark, sf_dir):
    docs = fx.docs_labeled(spark, sf_dir).select("doc_id", F.col("quality").cast("bigint").alias("quality"), "n_chars")
    return cleaning.fill_from(docs, "quality", "n_chars")


@query(
    "q_fill_zero",
    fx.with_views("SELECT doc_id, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic FROM docs_labeled", fx.DOCS_SQL),
)
def fill_zero(spark, sf_dir):
    return cleaning.fill_with_zero(fx.docs_labeled(spark, sf_dir).select("doc_id", "quality", "toxic"), ["quality", "toxic"])


@query(
    "q_neg_to_max",
    "SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN (SELECT max(s_acctbal) FROM supplier) ELSE s_acctbal END AS s_acctbal "
    "FROM supplier",
)
def neg_to_max(spark, sf_dir):
    supplier = fx.table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    return cleaning.negatives_to_max(supplier, "s_acctbal")


@query(
    "q_null_mask",
    fx.with_views(
        "SELECT quality IS NULL AS quality, toxic IS NULL AS toxic, count(*) AS n FROM docs_labeled GROUP BY 1, 2",
        fx.DOCS_SQL,
    ),
)
def null_mask(spark, sf_dir):
    mask = cleaning.null_mask(fx.docs_labeled(spark, sf_dir).select("quality", "toxic"))
    return mask.groupBy("quality", "toxic").agg(F.count(F.lit(1)).alias("n"))


@query(
    "q_subset",
    "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45",
)
def subset(spark, sf_dir):
    wanted = (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45)
    return cleaning.subset(fx.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_extendedprice"], wanted)


# -- text and date scalars -----------------------------------------------------------------


@query(
    "q_parse_emp_term",
    fx.with_views(
        """
SELECT loan_id, emp_length,
       CASE WHEN emp_length IN ('< 1 year', 'n/a') THEN 0
            ELSE TRY_CAST(regexp_replace(emp_length, '\\+? years?$', '') AS INT) END AS emp_length_int,
       CAST(trim(replace(term, ' months', '')) AS INT) AS term_int
FROM loans""",
        fx.LOANS_SQL,
    ),
)
def parse_emp_term(spark, sf_dir):
    return fx.loans(spark, sf_dir).select(
        "loan_id",
        "emp_length",
        cf.employment_years("emp_length").alias("emp_length_int"),
        cf.term_months("term").alias("term_int"),
    )


@query(
    "q_months_since",
    fx.with_views(
        """
SELECT loan_id, earliest_cr_line, CAST(d AS DATE) AS earliest_cr_line_date,
       CAST(round_even(date_diff('day', d, DATE '2017-12-01') / 30.436875::DOUBLE, 0) AS DOUBLE) AS mths_since_earliest_cr_line
FROM (SELECT *, make_date(CASE WHEN yy >= 69 THEN 1900 + yy ELSE 2000 + yy END, mm, 1) AS d
      FROM (SELECT *, CAST(right(earliest_cr_line, 2) AS INT) AS yy,
                   (strpos('JanFebMarAprMayJunJulAugSepOctNovDec', left(earliest_cr_line, 3)) + 2) // 3 AS mm FROM loans))""",
        fx.LOANS_SQL,
    ),
)
def months_since(spark, sf_dir):
    dated = fx.loans(spark, sf_dir).withColumn("earliest_cr_line_date", cf.parse_month_year("earliest_cr_line"))
    return dated.select(
        "loan_id",
        "earliest_cr_line",
        "earliest_cr_line_date",
        cf.months_since("earliest_cr_line_date").cast("double").alias("mths_since_earliest_cr_line"),
    )


@query(
    "q_row_hash",
    """
SELECT n_nationkey, sha256(concat_ws('||', CAST(n_nationkey AS VARCHAR), coalesce(n_name, '\\N'), CAST(n_regionkey AS VARCHAR)))
       AS _row_hash FROM nation""",
)
def row_hash(spark, sf_dir):
    nation = fx.table(spark, sf_dir, "nation")
    return nation.select("n_nationkey", cf.row_hash(nation.columns).alias("_row_hash"))


@query(
    "q_first_last_rows",
    """
SELECT 'first' AS part, * FROM (SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 5)
UNION ALL
SELECT 'last', * FROM (SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 5)""",
)
def first_last_rows(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    order = ("o_orderdate", "o_orderkey")
    first = reports.first_rows(orders, 5, *order).select(F.lit("first").alias("part"), "*")
    return first.unionByName(reports.last_rows(orders, 5, *order).select(F.lit("last").alias("part"), "*"))
