"""Clean panel to population, label, waterfall, features and their reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from cohortlake import config as cfg
from cohortlake.operators import features as fe
from cohortlake.operators import population as pop
from cohortlake.sources.workspace import materialise


@dataclass(frozen=True)
class Population:
    frame: DataFrame
    target: DataFrame
    waterfall: DataFrame


def build_population(
    panel: DataFrame,
    cohorts: Sequence[cfg.Cohort] = cfg.COHORTS,
    cols: cfg.PanelColumns = cfg.PanelColumns(),
    rule: cfg.PopulationRule = cfg.PopulationRule(),
    accounts: DataFrame | None = None,
    store: bool = True,
) -> Population:
    """Cohort frame, eligible labelled accounts and the waterfall.

    Target and waterfall both read the frame. With ``store`` it is written once to the shared
    folder (a row per account and cohort, far smaller than the panel), so the panel is scanned once.
    """
    frame = pop.cohort_frame(panel, cohorts, cols, rule, accounts)
    if store:
        frame = materialise(frame, "cohort_frame")
    steps = pop.Waterfall(rule, cols)
    return Population(frame, pop.target_behaviour(frame, cols, rule, steps), steps.report(frame))


def feature_table(
    panel: DataFrame,
    payments: DataFrame,
    cohorts: Sequence[cfg.Cohort] = cfg.COHORTS,
    cols: cfg.PanelColumns = cfg.PanelColumns(),
    payment_cols: cfg.PaymentColumns = cfg.PaymentColumns(),
    rule: cfg.PopulationRule = cfg.PopulationRule(),
    policy: fe.FeaturePolicy = fe.CORRECTED,
) -> DataFrame:
    """Population and all features in one lazy plan."""
    frame = pop.cohort_frame(panel, cohorts, cols, rule)
    target = pop.target_behaviour(frame, cols, rule)
    return fe.behaviour_features(target, panel, payments, cohorts, cols, payment_cols, policy)
