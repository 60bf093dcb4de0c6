"""Monitoring tables and the layout on several columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import fixtures as fx
from catalogue.registry import big, query, r, rounded
from cohortlake.operators import monitoring as mon
from cohortlake.sources import tables
from cohortlake.sources.workspace import scratch_path

BANDS = {"score": [500.0, 600.0, 700.0], "lgd": [0.6, 0.8]}

WATCHED_SQL = """
watched AS MATERIALIZED (
  SELECT CAST(year(opened) AS INT) AS period, year(opened) <= 1996 AS is_base, CASE WHEN loan_id % 29 <> 0 THEN target END AS t, pd AS p,
         CASE WHEN score IS NULL THEN '(missing)' ELSE CAST(1 + (score >= 500)::INT + (score >= 600)::INT + (score >= 700)::INT AS VARCHAR) END AS score_band,
         CASE WHEN lgd IS NULL THEN '(missing)' ELSE CAST(1 + (lgd >= 0.6::DOUBLE)::INT + (lgd >= 0.8::DOUBLE)::INT AS VARCHAR) END AS lgd_band,
         CASE WHEN score >= 700 THEN 'raise' WHEN score >= 500 THEN 'hold' WHEN loan_id % 7 <> 0 THEN 'cut' ELSE '(missing)' END AS action
  FROM portfolio),
long AS (
  SELECT period, is_base, t, p, 'score' AS feature, score_band AS band FROM watched UNION ALL SELECT period, is_base, t, p, 'lgd', lgd_band FROM watched
  UNION ALL SELECT period, is_base, t, p, 'action', action FROM watched),
grid AS (
  SELECT period, feature, band FROM (SELECT DISTINCT period FROM long), (SELECT DISTINCT feature, band FROM long)),
cell AS (
  SELECT period, feature, band, count(*) AS n, sum(t) AS bads, count(t) AS n_t, sum(p) AS e, count(p) AS n_p FROM long GROUP BY ALL),
base AS (SELECT feature, band, count(*) AS n_base FROM long WHERE is_base GROUP BY ALL),
filled AS (
  SELECT period, feature, band, coalesce(n, 0) AS n, bads, coalesce(n_t, 0) AS n_t, e, coalesce(n_p, 0) AS n_p,
         coalesce(n, 0) / sum(n) OVER (PARTITION BY period, feature) AS share,
         coalesce(n_base, 0) / (SELECT count(*) FROM watched WHERE is_base) AS base_share
  FROM grid LEFT JOIN cell USING (period, feature, band) LEFT JOIN base USING (feature, band)),
indexed AS (SELECT *, (greatest(share, 1e-6) - greatest(base_share, 1e-6)) * ln(greatest(share, 1e-6) / greatest(base_share, 1e-6)) AS psi FROM filled)"""


@query(
    "q_monitoring",
    fx.with_views(
        f"""
SELECT period, feature, band, n, {r('share', 6)} AS share, {r('base_share', 6)} AS base_share, {r('psi', 6)} AS psi,
       {r('bads / nullif(n_t, 0)', 6)} AS bad_rate, {r('e / nullif(n_p, 0)', 6)} AS expected_bad_rate FROM indexed
UNION ALL
SELECT period, feature, NULL, {big('sum(n)')}, {r('sum(share)', 6)}, {r('sum(base_share)', 6)}, {r('sum(psi)', 6)}, {r('sum(bads) / sum(n_t)', 6)},
       {r('sum(e) / sum(n_p)', 6)} FROM indexed GROUP BY period, feature""",
        fx.PORTFOLIO_SQL,
        WATCHED_SQL,
    ),
)
def monitoring(spark, sf_dir):
    """Score bands, a feature with missing values, and the action mix, by year against the first years."""
    key, score = F.col("loan_id"), F.col("score")
    action = F.when(score >= 700, "raise").when(score >= 500, "hold").when(key % 7 != 0, "cut")
    watched = fx.portfolio(spark, sf_dir).withColumns(
        {"year": F.year("opened"), "action": action, "target": F.when(key % 29 != 0, F.col("target"))}
    )
    return rounded(mon.monitoring(watched, "year", BANDS, F.col("year") <= 1996, categories=["action"]), 6)


@query("q_zorder_layout", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, CAST(l_shipdate AS DATE) AS shipped FROM lineitem")
def zorder_layout(spark, sf_dir):
    """Written in an order that keeps part, day and mode together, and read back."""
    path = scratch_path(spark, "zorder")
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", F.col("l_shipdate").cast("date").alias("shipped")]
    tables.clustered_on_all(fx.table(spark, sf_dir, "lineitem").select(*columns), ["l_partkey", "shipped", "l_returnflag"]).write.parquet(path)
    return spark.read.parquet(path)
