"""Clean tables to stored population, features, dictionary and their reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake import config as cfg
from cohortlake.operators import features as fe
from cohortlake.operators import population as pop
from cohortlake.plans.behaviour import build_population
from cohortlake.sources import tables

COLS, PAYMENT_COLS = cfg.EXTRACT_PANEL, cfg.EXTRACT_PAYMENTS


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("generated_at", F.current_timestamp())


def write_population(
    spark: SparkSession,
    layout: cfg.Layout = cfg.Layout(),
    cohorts: Sequence[cfg.Cohort] = cfg.COHORTS,
    rule: cfg.PopulationRule = cfg.PopulationRule(),
    gate: cfg.PopulationGate = cfg.PopulationGate(),
) -> DataFrame:
    """Store both target tables and the waterfall; returns the gate findings, computed from the stored table."""
    panel = spark.table(layout.table("silver", "panel_pooled"))
    built = build_population(panel, cohorts, COLS, rule)
    label = rule.label
    stored = tables.overwrite_table(
        built.target,
        layout.table("gold", "target_behaviour"),
        f"eligible account by cohort; bad = worst delinquency >= {label.bad_from} in the performance window; "
        f"{label.indeterminate_from}-{label.bad_from - 1} is flagged and kept out of training",
    )
    tables.overwrite_table(_stamped(built.waterfall), layout.table("reporting", "exclusion_waterfall"))
    applications = spark.table(layout.table("silver", "application"))
    tables.overwrite_table(
        pop.target_application(applications, panel, cols=COLS),
        layout.table("gold", "target_application"),
        "labelled customer with panel history",
    )
    return pop.population_gate(stored, gate)


def write_features(
    spark: SparkSession,
    layout: cfg.Layout = cfg.Layout(),
    cohorts: Sequence[cfg.Cohort] = cfg.COHORTS,
    policy: fe.FeaturePolicy = fe.CORRECTED,
) -> DataFrame:
    """Store the feature table and its dictionary; returns the leakage finding of the first cohort."""
    panel = spark.table(layout.table("silver", "panel_pooled"))
    payments = spark.table(layout.table("silver", "installments_payments"))
    target = spark.table(layout.table("gold", "target_behaviour"))
    built = fe.behaviour_features(target, panel, payments, cohorts, COLS, PAYMENT_COLS, policy)
    stored = tables.overwrite_table(
        built, layout.table("gold", "features_internal"), "behaviour features by account and cohort"
    )
    dictionary = fe.feature_dictionary(spark, stored.columns)
    tables.overwrite_table(_stamped(dictionary), layout.table("gold", "feature_dictionary"))
    return fe.leakage_report(stored, target, panel, cohorts[0], COLS)


def unbuilt_features(dictionary: DataFrame) -> DataFrame:
    """Catalogued features the feature table does not have."""
    return dictionary.filter(~F.col("is_built")).select("feature", "family")
