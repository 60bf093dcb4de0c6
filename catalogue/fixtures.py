"""Credit-shaped views over the star-schema tables: Spark builders and the same views in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.operators import cleaning
from cohortlake.operators import panel as pnl


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _month_index(day: str) -> Column:
    return (F.year(day) * 12 + F.month(day) - (2001 * 12 + 12)).cast("int")


def raw_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier by ship month, shaped like a pooled card and point-of-sale panel."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    price = F.col("l_extendedprice")

    def spent(flag: Column) -> Column:
        return F.sum(F.when(flag, price).otherwise(0))

    is_atm, is_pos = F.col("l_returnflag") == "A", F.col("l_returnflag") == "N"
    returned = F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0))
    monthly = (
        table(spark, sf_dir, "lineitem")
        .withColumn("month_idx", _month_index("l_shipdate"))
        .groupBy(F.col("l_suppkey").alias("account_id"), "month_idx")
        .agg(
            F.sum(price).alias("balance"),
            spent(F.col("l_linestatus") == "F").alias("drawings"),
            spent(is_atm).alias("drawings_atm"),
            spent(is_pos).alias("drawings_pos"),
            F.count(F.lit(1)).alias("drawings_cnt"),
            F.count_if(is_atm).alias("drawings_atm_cnt"),
            (F.sum(price) * 0.04).alias("min_due"),
            F.sum(price * F.col("l_tax")).alias("payment"),
            F.greatest(F.lit(0), returned.cast("int") - 110).alias("dpd"),
        )
    )
    rows = monthly.join(supplier, F.col("account_id") == F.col("s_suppkey"))
    is_card = F.col("account_id") % 3 != 0
    done = (F.col("account_id") % 17 == 5) & (F.col("month_idx") >= -13)
    card_only = [
        "balance", "credit_limit", "drawings", "drawings_atm", "drawings_pos", "drawings_cnt",
        "drawings_atm_cnt", "min_due", "payment",
    ]
    return rows.withColumn("credit_limit", F.col("s_acctbal") * 100).select(
        "account_id",
        F.col("s_nationkey").alias("customer_id"),
        F.when(is_card, "CC").otherwise("POS").alias("product_type"),
        "month_idx",
        "dpd",
        F.when(done, "Completed").otherwise("Active").alias("contract_status"),
        *[F.when(is_card, F.col(c)).alias(c) for c in card_only],
    )


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pnl.with_limit_measures(raw_panel(spark, sf_dir))


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.floor(
        (F.year("l_shipdate") - 2001) * 365.25
        + (F.month("l_shipdate") - 12) * 30.44
        + F.day("l_shipdate")
        - 31
    ).cast("int")
    paid = F.when(F.col("l_partkey") % 50 != 0, day + F.col("l_linenumber") * 3 - 9)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("account_id"),
        day.alias("days_instalment"),
        paid.alias("days_entry_payment"),
        F.col("l_extendedprice").alias("amt_instalment"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("amt_payment"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.derive_payments(raw_payments(spark, sf_dir))


def tradelines(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    status = (
        F.when(key % 23 == 0, None)
        .when(key % 29 == 0, "?")
        .when(F.col("o_orderstatus") == "F", " c")
        .when(F.col("o_orderstatus") == "P", "X")
        .otherwise(F.substring("o_orderpriority", 1, 1))
    )
    return table(spark, sf_dir, "orders").select(
        key.alias("tradeline_id"),
        F.col("o_custkey").alias("customer_id"),
        (_month_index("o_orderdate") + 1).alias("month_idx"),
        status.alias("status"),
    )


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, cust, day = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    seniority = (
        F.when(cust % 13 == 0, "< 1 year")
        .when(cust % 13 == 1, "1 year")
        .when(cust % 13 == 10, "10+ years")
        .when(cust % 13 == 11, "n/a")
        .when(cust % 13 == 12, None)
        .otherwise(F.concat((cust % 13).cast("string"), F.lit(" years")))
    )
    status = (
        F.when(key % 10 == 0, "Charged Off")
        .when(key % 37 == 0, "Default")
        .when(key % 11 == 0, "Late (31-120 days)")
        .when(key % 7 == 0, "Current")
        .when(key % 101 == 0, "Issued")
        .otherwise("Fully Paid")
    )
    short_year = F.lpad(((F.year(day) - cust % 40) % 100).cast("string"), 2, "0")
    return table(spark, sf_dir, "orders").select(
        key.alias("loan_id"),
        F.col("o_totalprice").alias("funded_amnt"),
        day.alias("issue_date"),
        F.when(F.month(day) % 2 == 0, " 36 months").otherwise(" 60 months").alias("term"),
        seniority.alias("emp_length"),
        status.alias("loan_status"),
        F.when((key % 10 == 0) & (key % 40 != 0), 0.0).otherwise(F.col("o_totalprice") * 0.3).alias("recoveries"),
        F.concat_ws("-", F.date_format(day, "MMM"), short_year).alias("earliest_cr_line"),
    )


def docs_labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")


# -- the same views as SQL, for the oracles --------------------------------------------------

PANEL_SQL = """
panel_m AS (
  SELECT l_suppkey AS account_id, s_nationkey AS customer_id,
         CASE WHEN l_suppkey % 3 = 0 THEN 'POS' ELSE 'CC' END AS product_type,
         CAST(year(l_shipdate)*12 + month(l_shipdate) - (2001*12 + 12) AS INT) AS month_idx,
         SUM(l_extendedprice) AS balance, MAX(s_acctbal)*100 AS credit_limit,
         SUM(CASE WHEN l_returnflag='A' THEN l_extendedprice ELSE 0 END) AS drawings_atm,
         SUM(CASE WHEN l_returnflag='N' THEN l_extendedprice ELSE 0 END) AS drawings_pos,
         SUM(CASE WHEN l_linestatus='F' THEN l_extendedprice ELSE 0 END) AS drawings,
         COUNT(*) AS drawings_cnt,
         CAST(SUM(CASE WHEN l_returnflag='A' THEN 1 ELSE 0 END) AS BIGINT) AS drawings_atm_cnt,
         SUM(l_extendedprice)*0.04 AS min_due, SUM(l_extendedprice*l_tax) AS payment,
         GREATEST(0, CAST(SUM(CASE WHEN l_returnflag='R' THEN l_quantity ELSE 0 END) AS INT) - 110) AS dpd
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  GROUP BY l_suppkey, s_nationkey, year(l_shipdate), month(l_shipdate)),
panel_raw AS (
  SELECT account_id, customer_id, product_type, month_idx, dpd,
       CASE WHEN account_id % 17 = 5 AND month_idx >= -13 THEN 'Completed' ELSE 'Active' END AS contract_status,
       CASE WHEN product_type='CC' THEN balance END AS balance,
       CASE WHEN product_type='CC' THEN credit_limit END AS credit_limit,
       CASE WHEN product_type='CC' THEN drawings END AS drawings,
       CASE WHEN product_type='CC' THEN drawings_atm END AS drawings_atm,
       CASE WHEN product_type='CC' THEN drawings_pos END AS drawings_pos,
       CASE WHEN product_type='CC' THEN drawings_cnt END AS drawings_cnt,
       CASE WHEN product_type='CC' THEN drawings_atm_cnt END AS drawings_atm_cnt,
       CASE WHEN product_type='CC' THEN min_due END AS min_due,
       CASE WHEN product_type='CC' THEN payment END AS payment
  FROM panel_m),
panel AS (
  SELECT *,
       CASE WHEN product_type='CC' THEN credit_limit > 0 END AS has_valid_limit,
       CASE WHEN product_type='CC' AND credit_limit > 0 THEN balance / credit_limit END AS utilisation,
       CASE WHEN product_type='CC' AND credit_limit > 0 THEN balance > credit_limit END AS is_overlimit,
       CASE WHEN product_type='CC' THEN
            CASE WHEN credit_limit > 0 AND balance > credit_limit THEN balance - credit_limit ELSE 0.0 END
       END AS overlimit_amount
  FROM panel_raw)"""

_DAY_SQL = (
    "CAST(FLOOR((year(l_shipdate)-2001)*365.25 + (month(l_shipdate)-12)*30.44 + day(l_shipdate) - 31) AS INT)"
)
PAYMENTS_SQL = f"""
payments_raw AS (
  SELECT l_suppkey AS account_id, {_DAY_SQL} AS days_instalment,
         CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE {_DAY_SQL} + l_linenumber*3 - 9 END AS days_entry_payment,
         l_extendedprice AS amt_instalment, l_extendedprice*(1-l_discount) AS amt_payment
  FROM lineitem),
payments AS (
  SELECT *, days_entry_payment - days_instalment AS days_late,
         days_entry_payment > days_instalment AS is_late,
         amt_instalment - amt_payment AS payment_shortfall,
         amt_payment < amt_instalment * 0.99 AS is_short_payment
  FROM payments_raw)"""

TRADELINES_SQL = """
tradelines AS (
  SELECT o_orderkey AS tradeline_id, o_custkey AS customer_id,
         CAST(year(o_orderdate)*12 + month(o_orderdate) - (2001*12 + 12) + 1 AS INT) AS month_idx,
         CASE WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderkey % 29 = 0 THEN '?'
              WHEN o_orderstatus='F' THEN ' c' WHEN o_orderstatus='P' THEN 'X'
              ELSE substring(o_orderpriority, 1, 1) END AS status
  FROM orders)"""

LOANS_SQL = """
loans AS (
  SELECT o_orderkey AS loan_id, o_totalprice AS funded_amnt, o_orderdate AS issue_date,
         CASE WHEN month(o_orderdate) % 2 = 0 THEN ' 36 months' ELSE ' 60 months' END AS term,
         CASE o_custkey % 13 WHEN 0 THEN '< 1 year' WHEN 1 THEN '1 year' WHEN 10 THEN '10+ years'
              WHEN 11 THEN 'n/a' WHEN 12 THEN NULL ELSE concat(CAST(o_custkey % 13 AS VARCHAR(4)), ' years') END AS emp_length,
         CASE WHEN o_orderkey % 10 = 0 THEN 'Charged Off' WHEN o_orderkey % 37 = 0 THEN 'Default'
              WHEN o_orderkey % 11 = 0 THEN 'Late (31-120 days)' WHEN o_orderkey % 7 = 0 THEN 'Current'
              WHEN o_orderkey % 101 = 0 THEN 'Issued' ELSE 'Fully Paid' END AS loan_status,
         CASE WHEN o_orderkey % 10 = 0 AND o_orderkey % 40 <> 0 THEN 0.0 ELSE o_totalprice * 0.3 END AS recoveries,
         concat(substring('JanFebMarAprMayJunJulAugSepOctNovDec', month(o_orderdate)*3-2, 3), '-',
                lpad(CAST((year(o_orderdate) - (o_custkey % 40)) % 100 AS VARCHAR(2)), 2, '0')) AS earliest_cr_line
  FROM orders)"""

DOCS_SQL = """
docs_labeled AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def with_views(body: str, *views: str) -> str:
    return "WITH " + ",".join(views) + "\n" + body if views else body


# -- a scored portfolio: one row per order ------------------------------------------------------


def portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score 400 to 799, a bad flag that falls with it, and loss components, some of them missing."""
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    score = (F.lit(400) + (key * 7919) % 400).cast("double")
    return (
        table(spark, sf_dir, "orders")
        .withColumn("score", score)
        .select(
            key.alias("loan_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderpriority").alias("segment"),
            F.col("o_orderdate").alias("opened"),
            "score",
            ((key * 104729) % 1000 < 800 - F.col("score")).cast("int").alias("target"),
            ((key * 104729) % 1000 == 999).alias("is_indeterminate"),
            ((801 - F.col("score")) / 1000).alias("pd"),
            price.alias("balance"),
            (price * 0.5).alias("spend"),
            F.when(key % 3 != 0, 0.5 + (key % 50) / 100.0).alias("lgd"),
            F.when(key % 4 != 0, price * 0.9).alias("ead"),
        )
    )


PORTFOLIO_SQL = """
portfolio AS (
  SELECT o_orderkey AS loan_id, o_custkey AS customer_id, o_orderpriority AS segment, o_orderdate AS opened, score,
         CASE WHEN o_orderkey * 104729 % 1000 < 800 - score THEN 1 ELSE 0 END AS target,
         o_orderkey * 104729 % 1000 = 999 AS is_indeterminate, (801 - score) / 1000 AS pd,
         o_totalprice AS balance, o_totalprice * 0.5 AS spend,
         CASE WHEN o_orderkey % 3 <> 0 THEN CAST(0.5 AS DOUBLE) + (o_orderkey % 50) / CAST(100 AS DOUBLE) END AS lgd,
         CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice * 0.9 END AS ead
  FROM (SELECT *, CAST(400 + (o_orderkey * 7919) % 400 AS DOUBLE) AS score FROM orders))"""


def external_tradelines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as tradelines of the customer, with a kind, a state, debt and limit."""
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    state = F.when(F.col("o_orderstatus") == "F", "Closed").when(key % 17 == 0, "Bad debt").otherwise("Active")
    return table(spark, sf_dir, "orders").select(
        key.alias("tradeline_id"),
        F.col("o_custkey").alias("customer_id"),
        F.substring("o_orderpriority", 1, 1).alias("kind"),
        state.alias("state"),
        (-F.datediff(F.lit("2001-12-31"), "o_orderdate")).alias("opened_day"),
        (price * (key % 11) / 10).alias("debt"),
        F.when(key % 5 != 0, price).alias("credit_limit"),
        F.when(key % 17 == 0, price * 0.1).otherwise(0.0).alias("overdue"),
        (key % 13 == 0).cast("int").alias("prolonged"),
    )


EXTERNAL_SQL = """
external AS (
  SELECT o_orderkey AS tradeline_id, o_custkey AS customer_id, substring(o_orderpriority, 1, 1) AS kind,
         CASE WHEN o_orderstatus = 'F' THEN 'Closed' WHEN o_orderkey % 17 = 0 THEN 'Bad debt' ELSE 'Active' END AS state,
         -date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-12-31') AS opened_day,
         o_totalprice * (o_orderkey % 11) / 10 AS debt,
         CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS credit_limit,
         CASE WHEN o_orderkey % 17 = 0 THEN o_totalprice * 0.1 ELSE 0.0 END AS overdue,
         CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 0 END AS prolonged
  FROM orders)"""
