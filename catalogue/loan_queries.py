"""Loan-level operators on the orders-based loan view."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import fixtures as fx
from catalogue.registry import big, query, rounded
from cohortlake.operators import loans as ln

OUTCOME_SQL = """
CASE WHEN loan_status IN ('Charged Off', 'Default') THEN 'BAD' WHEN loan_status = 'Fully Paid' THEN 'GOOD'
     WHEN loan_status = 'Late (31-120 days)' THEN 'INDETERMINATE' WHEN loan_status = 'Current' THEN 'EXCLUDED'
     ELSE 'unmapped' END"""
MATURED_SQL = """
matured AS (SELECT *, CASE WHEN loan_status IN ('Charged Off', 'Default') THEN 1 ELSE 0 END AS target
            FROM loans WHERE loan_status IN ('Charged Off', 'Default', 'Fully Paid'))"""
# The generated orders span 1995 to 2001; the samples are placed there.
DEV, OOT = ("1995-01-01", "1998-01-01"), ("1998-01-01", "1999-01-01")


@query(
    "q_outcome_class",
    fx.with_views(
        f"""
SELECT loan_id, loan_status, {OUTCOME_SQL} AS outcome,
       CASE WHEN loan_status IN ('Charged Off', 'Default', 'Late (31-120 days)') THEN 0 ELSE 1 END AS good_bad FROM loans""",
        fx.LOANS_SQL,
    ),
)
def outcome_class(spark, sf_dir):
    return fx.loans(spark, sf_dir).select(
        "loan_id",
        "loan_status",
        ln.outcome_class("loan_status").alias("outcome"),
        ln.good_bad("loan_status").alias("good_bad"),
    )


@query(
    "q_loan_status_report",
    fx.with_views(
        f"""
SELECT loan_status, count(*) AS n, round(count(*) / (SELECT count(*) FROM loans), 6) AS share, {OUTCOME_SQL} AS outcome
FROM loans GROUP BY loan_status""",
        fx.LOANS_SQL,
    ),
)
def loan_status_report(spark, sf_dir):
    return rounded(ln.status_report(fx.loans(spark, sf_dir)), 6)


@query("q_matured", fx.with_views("SELECT loan_id, loan_status, target FROM matured", fx.LOANS_SQL, MATURED_SQL))
def matured(spark, sf_dir):
    return ln.matured(fx.loans(spark, sf_dir)).select("loan_id", "loan_status", "target")


@query(
    "q_fully_matured",
    fx.with_views(
        """
SELECT loan_id, CAST(issue_date AS DATE) + to_months(CAST(trim(replace(term, ' months', '')) AS INT)) <= DATE '2000-12-01'
       AS is_fully_matured FROM loans""",
        fx.LOANS_SQL,
    ),
)
def fully_matured(spark, sf_dir):
    from cohortlake.functions.columns import term_months

    return fx.loans(spark, sf_dir).select(
        "loan_id",
        ln.is_fully_matured(F.col("issue_date").cast("date"), term_months("term"), "2000-12-01").alias("is_fully_matured"),
    )


@query(
    "q_vintage",
    fx.with_views(
        f"""
SELECT CAST(year(issue_date) AS INT) AS issue_year, count(*) AS n, {big('sum(target)')} AS bads,
       round(avg(target) * 100, 2) AS bad_rate FROM matured GROUP BY 1""",
        fx.LOANS_SQL,
        MATURED_SQL,
    ),
)
def vintage(spark, sf_dir):
    return ln.vintage_table(ln.matured(fx.loans(spark, sf_dir)), "issue_date")


@query(
    "q_vintage_samples",
    fx.with_views(
        """
SELECT n AS n_matured, b AS bads_matured, nd AS n_dev, bd AS bads_dev, no AS n_oot, bo AS bads_oot, round(bd / nd, 6) AS rate_dev, round(bo / no, 6) AS rate_oot,
       round(abs(bd / nd - bo / no) / (bd / nd), 6) AS drift, CASE WHEN b >= 1000 THEN 'PASS' ELSE 'FAIL' END AS gate
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE target = 1) AS b, count(*) FILTER (WHERE s = 'dev') AS nd, count(*) FILTER (WHERE s = 'oot') AS no,
             count(*) FILTER (WHERE s = 'dev' AND target = 1) AS bd, count(*) FILTER (WHERE s = 'oot' AND target = 1) AS bo
      FROM (SELECT target, CASE WHEN issue_date >= DATE '1995-01-01' AND issue_date < DATE '1998-01-01' THEN 'dev'
                                WHEN issue_date >= DATE '1998-01-01' AND issue_date < DATE '1999-01-01' THEN 'oot' END AS s
            FROM matured))""",
        fx.LOANS_SQL,
        MATURED_SQL,
    ),
)
def vintage_samples(spark, sf_dir):
    return rounded(ln.sample_rates(ln.matured(fx.loans(spark, sf_dir)), "issue_date", DEV, OOT), 6)


@query(
    "q_recovery_summary",
    fx.with_views(
        """
SELECT count(*) AS n_loans, count(*) FILTER (WHERE recoveries > 0) AS n_with_recovery,
       round(avg(CASE WHEN recoveries > 0 THEN 1.0 ELSE 0.0 END), 6) AS share_with_recovery,
       round(avg(CASE WHEN rate <= 0 THEN 1.0 ELSE 0.0 END), 6) AS share_zero,
       round(avg(CASE WHEN rate >= 0.999 THEN 1.0 ELSE 0.0 END), 6) AS share_full, round(avg(rate), 6) AS mean_rate
FROM (SELECT *, least(greatest(recoveries / nullif(funded_amnt, 0), 0), 1) AS rate FROM matured WHERE target = 1)""",
        fx.LOANS_SQL,
        MATURED_SQL,
    ),
)
def recovery_summary(spark, sf_dir):
    bad = ln.matured(fx.loans(spark, sf_dir)).filter("target = 1")
    return rounded(ln.recovery_summary(ln.with_recovery_rate(bad, "recoveries", "funded_amnt"), "recoveries"), 6)


@query(
    "q_select_features",
    fx.with_views("SELECT loan_id, funded_amnt, issue_date, emp_length, earliest_cr_line FROM loans", fx.LOANS_SQL),
)
def select_features(spark, sf_dir):
    """Outcome, control and post-outcome columns drop out by rule."""
    return ln.select_features(fx.loans(spark, sf_dir))
