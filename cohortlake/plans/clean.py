"""Bronze to silver: the cleaning steps per table, the pooled panel, the row gate."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake import config as cfg
from cohortlake.operators import cleaning, panel, profiling, quality
from cohortlake.sources import tables
from cohortlake.sources.schema import CORRUPT_RECORD

# Clean table -> raw table (the pooled panel has two).
SOURCES = {
    "application": ("application_train",),
    "application_holdout": ("application_test",),
    "bureau": ("bureau",),
    "bureau_balance": ("bureau_balance",),
    "previous_application": ("previous_application",),
    "installments_payments": ("installments_payments",),
    "panel_pooled": ("credit_card_balance", "pos_cash_balance"),
}

COMMENTS = {
    "application": "labelled applications; sentinels blanked, income capped",
    "application_holdout": "unlabelled applications, cleaned alike, never trained on",
    "bureau": "external tradelines",
    "bureau_balance": "monthly tradeline status as bucket 0-5, months on the account panels' axis",
    "previous_application": "earlier applications; sentinels blanked",
    "installments_payments": "payments with lateness and shortfall",
    "panel_pooled": "card and POS months; columns a product lacks are NULL, utilisation needs a positive limit",
}
AUDIT = "table string, status string, n_rows bigint, duration_sec double"


def clean_table(
    name: str,
    raw: Mapping[str, DataFrame],
    sentinels: Mapping[str, Mapping[str, int]],
    n_rows: Mapping[str, int],
) -> DataFrame:
    """The clean form of one table; lazy but for the capping threshold."""
    parts = [raw[source].drop(CORRUPT_RECORD) for source in SOURCES[name]]
    if name == "panel_pooled":
        return panel.pool_panels(*parts)
    (source,), (df,) = SOURCES[name], parts
    if name == "bureau_balance":
        return cleaning.decode_status_panel(df)
    df, _ = cleaning.scrub_sentinels(df, sentinels.get(source, {}), n_rows.get(source, 0))
    if name.startswith("application"):
        df, _ = cleaning.cap_outliers(df)
    df = cleaning.narrow_days_to_int(df)
    return cleaning.derive_payments(df, cfg.EXTRACT_PAYMENTS) if name == "installments_payments" else df


def write_silver(
    spark: SparkSession,
    findings: DataFrame,
    n_rows: Mapping[str, int],
    layout: cfg.Layout = cfg.Layout(),
    mode: str = tables.OVERWRITE,
) -> list[dict]:
    """Clean and store every table; the sentinel findings say which columns to scrub."""
    sentinels = cleaning.sentinel_columns(findings)
    audit = []
    for name, sources in SOURCES.items():
        raw = {s: spark.table(layout.table("bronze", s)) for s in sources}
        cleaned = clean_table(name, raw, sentinels, n_rows)
        audit.append({**tables.write_table(cleaned, layout.table("silver", name), mode, COMMENTS[name]), "table": name})
    tables.append_audit(spark, audit, AUDIT, layout.table("reporting", "silver_audit"))
    return audit


def silver_gate(spark: SparkSession, layout: cfg.Layout = cfg.Layout()) -> DataFrame:
    checks = [
        quality.rows_preserved(
            spark.table(layout.table("silver", name)),
            [spark.table(layout.table("bronze", s)) for s in sources],
            name,
        )
        for name, sources in SOURCES.items()
    ]
    findings = quality.union_findings(checks)
    quality.raise_on_fail(findings)
    return findings


def silver_profile(spark: SparkSession, layout: cfg.Layout = cfg.Layout()) -> DataFrame:
    """Store and return the column profile of every clean table."""
    profiles = [
        profiling.column_profile(spark.table(layout.table("silver", name))).select(F.lit(name).alias("table"), "*")
        for name in SOURCES
    ]
    report = quality.union_findings(profiles).withColumn("generated_at", F.current_timestamp())
    return tables.overwrite_table(report, layout.table("reporting", "silver_data_quality"))
