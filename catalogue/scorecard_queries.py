"""Weight of evidence, dummies, coarse classes and splits on the star-schema tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import fixtures as fx
from catalogue.registry import big, query, r, rounded
from cohortlake.operators import reports, scorecard


def _woe_sql(counts: str, smoothing: float = 0.0) -> str:
    """WoE table from a query giving (variable, category, good); good is 0 or 1."""
    return f"""
SELECT variable, category, {big('row_number() OVER o')} AS rank, n_obs, {r('prop_good', 6)} AS prop_good,
       {r('n_obs / sum(n_obs) OVER v', 6)} AS prop_n_obs, {r('n_good', 6)} AS n_good, {r('n_bad', 6)} AS n_bad,
       {r('pg', 6)} AS prop_n_good, {r('pb', 6)} AS prop_n_bad, {r('woe', 6)} AS woe,
       {r('abs(prop_good - lag(prop_good) OVER o)', 6)} AS diff_prop_good, {r('abs(woe - lag(woe) OVER o)', 6)} AS diff_woe,
       {r('sum((pg - pb) * woe) OVER v', 6)} AS iv
FROM (SELECT *, CASE WHEN pg > 0 AND pb > 0 THEN ln(pg / pb) END AS woe
      FROM (SELECT *, n_good AS g, (n_good + {smoothing}) / nullif(sum(n_good + {smoothing}) OVER (PARTITION BY variable), 0) AS pg,
                   (n_bad + {smoothing}) / nullif(sum(n_bad + {smoothing}) OVER (PARTITION BY variable), 0) AS pb
            FROM (SELECT variable, category, count(*) AS n_obs, avg(good) AS prop_good, CAST(sum(good) AS DOUBLE) AS n_good,
                         CAST(sum(1 - good) AS DOUBLE) AS n_bad
                  FROM ({counts}) WHERE category IS NOT NULL AND good IS NOT NULL GROUP BY variable, category)))
WINDOW v AS (PARTITION BY variable), o AS (PARTITION BY variable ORDER BY woe ASC NULLS LAST, category)"""


def _finished(spark, sf_dir):
    good = (F.col("o_orderstatus") == "F").cast("int")
    return fx.table(spark, sf_dir, "orders").withColumn("good_bad", good)


_ORDER_VARS = {"o_orderpriority": "o_orderpriority", "order_year": "CAST(year(o_orderdate) AS VARCHAR)"}


def _woe(df):
    return rounded(df.withColumn("rank", F.col("rank").cast("bigint")), 6)


@query(
    "q_woe_iv",
    _woe_sql(
        "SELECT 'o_orderpriority' AS variable, o_orderpriority AS category, "
        "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS good FROM orders"
    ),
)
def woe_iv(spark, sf_dir):
    return _woe(scorecard.woe_tables(_finished(spark, sf_dir), ["o_orderpriority"], "good_bad"))


@query(
    "q_woe_multi",
    _woe_sql(
        " UNION ALL ".join(
            f"SELECT '{v}' AS variable, {sql} AS category, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS good FROM orders"
            for v, sql in _ORDER_VARS.items()
        )
    ),
)
def woe_multi(spark, sf_dir):
    orders = _finished(spark, sf_dir).withColumn("order_year", F.year("o_orderdate"))
    return _woe(scorecard.woe_tables(orders, list(_ORDER_VARS), "good_bad"))


@query(
    "q_woe_nulls",
    fx.with_views(
        _woe_sql(
            "SELECT 'lang' AS variable, lang AS category, quality AS good FROM docs_labeled UNION ALL "
            "SELECT 'source', source, quality FROM docs_labeled UNION ALL "
            "SELECT 'toxic', CAST(toxic AS VARCHAR), quality FROM docs_labeled"
        ),
        fx.DOCS_SQL,
    ),
)
def woe_nulls(spark, sf_dir):
    return _woe(scorecard.woe_tables(fx.docs_labeled(spark, sf_dir), ["lang", "source", "toxic"], "quality"))


@query(
    "q_woe_smoothed",
    _woe_sql(
        "SELECT 'o_orderstatus' AS variable, o_orderstatus AS category, "
        "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS good FROM orders",
        smoothing=0.5,
    ),
)
def woe_smoothed(spark, sf_dir):
    """Each status is all good or all bad: the empty classes need smoothing."""
    return _woe(scorecard.woe_tables(_finished(spark, sf_dir), ["o_orderstatus"], "good_bad", smoothing=0.5))


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "q_one_hot",
    "SELECT o_orderkey, "
    + ", ".join(f"CASE WHEN o_orderpriority = '{p}' THEN 1 ELSE 0 END AS \"o_orderpriority:{p}\"" for p in _PRIORITIES)
    + " FROM orders",
)
def one_hot(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return scorecard.one_hot(orders, ["o_orderpriority"]).drop("o_orderpriority")


@query(
    "q_coarse_class",
    """
SELECT o_orderkey, CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN 'low' ELSE o_orderpriority END AS coarse,
       CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN 1 ELSE 0 END AS "o_orderpriority:4-NOT SPECIFIED_5-LOW"
FROM orders""",
)
def coarse_class(spark, sf_dir):
    low = ["4-NOT SPECIFIED", "5-LOW"]
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    merged = scorecard.merge_dummies(
        scorecard.one_hot(orders, ["o_orderpriority"], known={"o_orderpriority": low}), "o_orderpriority", low
    )
    return merged.select(
        "o_orderkey",
        scorecard.coarse_class("o_orderpriority", {"low": low}).alias("coarse"),
        "`o_orderpriority:4-NOT SPECIFIED_5-LOW`",
    )


@query(
    "q_split_counts",
    """
SELECT CASE WHEN o_orderkey % 100 < 20 THEN 'test' ELSE 'train' END AS split, count(*) AS n FROM orders GROUP BY 1""",
)
def split_counts(spark, sf_dir):
    split = scorecard.modulus_split(fx.table(spark, sf_dir, "orders"), "o_orderkey")
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query(
    "q_split_hash",
    """
SELECT o_orderkey, CASE WHEN CAST('0x' || substr(md5('42|' || o_orderkey), 1, 8) AS BIGINT) % 100 < 20
                        THEN 'test' ELSE 'train' END AS split FROM orders""",
)
def split_hash(spark, sf_dir):
    return scorecard.hash_split(fx.table(spark, sf_dir, "orders"), "o_orderkey").select("o_orderkey", "split")


@query(
    "q_target_by",
    fx.with_views(
        "SELECT lang, count(quality) AS n_obs, round(avg(quality), 6) AS mean_target FROM docs_labeled "
        "WHERE lang IS NOT NULL GROUP BY lang",
        fx.DOCS_SQL,
    ),
)
def target_by(spark, sf_dir):
    return rounded(reports.target_by(fx.docs_labeled(spark, sf_dir), "lang", "quality"), 6)
