"""Small report tables over large inputs, in SQL where a report reads best as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake import config as cfg


def status_report(df: DataFrame, status: str = "STATUS") -> DataFrame:
    """Rows per raw status and decoded flags."""
    return df.sparkSession.sql(
        f"""
        SELECT `{status}`, status_bucket, is_closed, is_status_unknown, is_delinquent, count(*) AS n_rows
        FROM {{decoded}} GROUP BY ALL
        """,
        decoded=df,
    )


def panel_report(panel: DataFrame, cols: cfg.PanelColumns = cfg.PanelColumns()) -> DataFrame:
    """Rows, accounts, customers, month range and stress counts per product.

    Rows first collapse per account and customer; the distinct counts then run over accounts.
    """
    held = panel.groupBy(*cols.keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(cols.month).alias("lo"),
        F.max(cols.month).alias("hi"),
        F.sum(cols.utilisation).alias("util"),
        F.count(cols.utilisation).alias("util_n"),
        F.sum(F.col(cols.is_overlimit).cast("int")).alias("over"),
        F.sum(F.when(F.col(cols.dpd) >= 90, 1)).alias("late"),
    )
    return held.groupBy(cols.product).agg(
        F.sum("n").alias("n_rows"),
        F.count_distinct(cols.account).alias("n_accounts"),
        F.count_distinct(cols.customer).alias("n_customers"),
        F.min("lo").alias("min_month"),
        F.max("hi").alias("max_month"),
        F.round(F.try_divide(F.sum("util"), F.sum("util_n")), 4).alias("avg_utilisation"),
        F.sum("over").alias("n_overlimit_months"),
        F.sum("late").alias("n_months_90plus"),
    )


def cohort_report(target: DataFrame, product: str = "product_type") -> DataFrame:
    """Accounts, bads, bad rate, indeterminates and mean tenure per cohort and product."""
    return target.sparkSession.sql(
        f"""
        SELECT cohort, `{product}`, count(*) AS n_accounts, sum(target) AS n_bads,
               round(avg(target), 4) AS bad_rate, sum(CAST(is_indeterminate AS INT)) AS n_indeterminate,
               round(avg(tenure_at_obs), 1) AS avg_tenure_months
        FROM {{target}} GROUP BY ALL
        """,
        target=target,
    )


def target_by(df: DataFrame, column: str, target: str) -> DataFrame:
    """Rows with a target and its mean, per value of a column."""
    known = df.filter(F.col(column).isNotNull())
    return known.groupBy(column).agg(F.count(target).alias("n_obs"), F.avg(target).alias("mean_target"))


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(n)


def last_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The last ``n`` rows of the ordering: a top-k on the reversed keys, not a full sort."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n).orderBy(*order)


def source_table(spark) -> DataFrame:
    rows = [
        (s.name, s.filename, s.role, s.grain, s.expected_rows, list(s.natural_key), list(s.cluster_by))
        for s in cfg.TABLE_SPECS
    ]
    return spark.createDataFrame(
        rows,
        "table string, filename string, role string, grain string, expected_rows bigint, "
        "natural_key array<string>, cluster_by array<string>",
    )
