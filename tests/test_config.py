import pytest

from cohortlake import config as cfg
from cohortlake.operators import features as fe
from cohortlake.operators import population as pop


def test_windows_of_both_cohorts():
    assert (cfg.DEV.obs_window, cfg.DEV.perf_window) == ((-24, -13), (-12, -1))
    assert (cfg.OOT.obs_window, cfg.OOT.perf_window) == ((-30, -19), (-18, -7))
    assert cfg.window_for(-13, 1) == (-13, -13)
    with pytest.raises(ValueError):
        cfg.window_for(-13, 0)


@pytest.mark.parametrize("cohort", cfg.COHORTS)
@pytest.mark.parametrize("months", [*cfg.WINDOWS, cfg.TREND_WINDOW, 1])
def test_no_window_touches_the_label_window(cohort, months):
    lo, hi = cfg.window_for(cohort.obs_point, months)
    assert lo <= hi <= cohort.obs_point < cohort.perf_window[0]
    assert cfg.window_is_safe(cohort.obs_point, months)


def test_all_windows_safe():
    assert fe.windows_are_safe()


def test_label_classes_partition_the_axis():
    rule = cfg.LabelRule()
    assert [rule.classify(d) for d in (None, 0, 29, 30, 89, 90, 500)] == [
        "good", "good", "good", "indeterminate", "indeterminate", "bad", "bad",
    ]
    for dpd in range(200):
        assert [rule.is_bad(dpd), rule.is_indeterminate(dpd)].count(True) == (rule.classify(dpd) != "good")


def test_registry():
    names = [s.name for s in cfg.TABLE_SPECS]
    assert len(names) == len(set(names)) == 9
    assert cfg.TABLES["application_test"].role == "holdout"
    assert "application_test" not in [s.name for s in cfg.MODELLING_TABLES]
    assert not cfg.TABLES["installments_payments"].has_natural_key
    with pytest.raises(ValueError):
        cfg.TableSpec("x", "x.csv", "", "", role="other")
    assert cfg.Layout("c").table("gold", "t") == "c.gold.t"


def test_gate_arithmetic():
    assert [pop.supportable_characteristics(n) for n in (0, 179, 180, 1812)] == [0, 0, 1, 10]
    assert pop.supportable_characteristics(100, cfg.PopulationGate(bins=0)) == 0
    assert pop.bad_rate_drift(0.0, 0.5) == 0.0
    assert pop.bad_rate_drift(0.02, 0.03) == pytest.approx(0.5)
    assert pop.drift_is_material(0.02, 0.03) and not pop.drift_is_material(0.02, 0.025)


def test_catalogue():
    names = fe.feature_names()
    assert len(names) == len(set(names)) == 71
    sizes = {family: len(features) for family, features in fe.by_family().items()}
    assert sizes == {
        fe.TENURE: 6, fe.DELINQUENCY: 16, fe.UTILISATION: 13, fe.BALANCE: 7, fe.SPEND: 10, fe.DISTRESS: 12, fe.PAYMENT: 7,
    }
    assert {f.direction for f in fe.FEATURES} == set(fe.DIRECTIONS)
    assert len(fe.CATALOGUE) == 49
    with pytest.raises(ValueError):
        fe.Feature("x", fe.SPEND, "", "up")
    assert set(fe.DERIVED) == {f.name for f in fe.FEATURES if f.source == "derived"}
