import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlake.functions.gram import gram
from cohortlake.operators import comparison, fractional, models, severity


def test_gram_adds_up_products(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, -1.0)], "a double, b double").repartition(3)
    assert gram(df, [F.col("a"), F.col("b"), F.lit(1)]).tolist() == [[10, -1, 4], [-1, 5, 1], [4, 1, 2]]
    assert gram(df.where("false"), [F.col("a"), F.col("b")]).tolist() == [[0, 0], [0, 0]]
    with pytest.raises(Exception, match="null|NaN|Encountered"):
        gram(spark.createDataFrame([(None,)], "a double"), [F.col("a")])


def newton(x, y, w):
    x = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ b))
        b = b + np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x, x.T @ (w * (y - p)))
    p = 1 / (1 + np.exp(-x @ b))
    inverse = np.linalg.inv((x * (w * p * (1 - p))[:, None]).T @ x)
    return b, np.sqrt(np.diag(inverse @ ((x * ((w * (y - p)) ** 2)[:, None]).T @ x) @ inverse))


def shares(spark, n=800):
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.normal(size=n), rng.normal(size=n) * 1e5])
    p = 1 / (1 + np.exp(-(0.3 + x[:, 0] - 2e-5 * x[:, 1])))
    y = np.where(rng.random(n) < 0.3, (rng.random(n) < p) * 1.0, p)
    w = rng.integers(1, 4, n).astype(float)
    return x, y, w, spark.createDataFrame([(*map(float, r), float(t), float(v)) for r, t, v in zip(x, y, w)], "`a.1` double, b double, share double, w double")


def test_fractional_fit_solves_the_score_equations(spark):
    x, y, w, df = shares(spark)
    fit = fractional.fit_fractional(df, ["a.1", "b"], "share", weight="w")
    want, errors = newton(x, y, w)
    assert fit.converged and np.allclose([fit.intercept, *fit.coefficients.values()], want, rtol=1e-8)
    assert np.allclose(list(fit.robust_errors.values()), errors, rtol=1e-6)
    scale = np.abs(np.column_stack([np.ones(len(x)), x])).sum(axis=0)
    assert np.all(np.abs(fit.score) <= 1e-9 * scale)
    shown = df.select(fit.mean().alias("m")).agg(F.min("m"), F.max("m")).first()
    assert 0 < shown[0] < shown[1] < 1


def test_fit_of_odd_data(spark):
    df = spark.createDataFrame([(float(i), float(i >= 10), 1.0) for i in range(20)] + [(5.0, None, 1.0)], "x double, y double, one double")
    apart = fractional.fit_fractional(df, ["x"], "y", max_steps=15)  # separated: no finite answer
    assert not apart.converged and apart.coefficients["x"] > 1 and math.isfinite(apart.intercept)
    twins = fractional.fit_fractional(df.withColumn("y", F.col("y") * 0.6 + 0.2), ["x", "one"], "y")  # "one" repeats the intercept
    alone = fractional.fit_fractional(df.withColumn("y", F.col("y") * 0.6 + 0.2), ["x"], "y")
    assert twins.coefficients["x"] == pytest.approx(alone.coefficients["x"]) and twins.loss == pytest.approx(alone.loss)
    for bad in (1.2, -0.1):
        with pytest.raises(ValueError, match="outside"):
            fractional.fit_fractional(df.withColumn("y", F.lit(bad)), ["x"], "y")


def test_two_stages_of_loss(spark):
    rng = random.Random(2)
    data = [(i, i % 10 / 10, None if i % 11 == 0 else 0.0 if rng.random() < 0.7 else rng.choice([1.0, 0.4]), None if i % 13 == 0 else 1.0) for i in range(600)]
    df = spark.createDataFrame(data, "id long, x double, recovery_rate double, z double")
    model = severity.fit_loss(df, ["x", "z"], second=["x"])
    got = {r.id: r for r in model.score(df, observable=F.col("id") != 5).collect()}
    assert len(got) == 600 and all(0 < r.lgd < 1 for r in got.values())
    for i, r in got.items():
        assert r.is_modelled == (i % 13 != 0 and i != 5)
        assert r.lgd == pytest.approx(1 - r.p_recovery * r.recovery_if_any) if r.is_modelled else r.lgd == 0.87 and r.p_recovery is None
    fitted = [got[i] for i, _, y, z in data if y is not None and z is not None]
    told = {i: y for i, _, y, _ in data}
    ids = [r.id for r in fitted if r.id != 5]
    assert sum(got[i].p_recovery for i in ids) == pytest.approx(sum(told[i] > 0 for i in ids), abs=1.5)
    with pytest.raises(ValueError, match="nothing was recovered"):
        severity.fit_loss(df.withColumn("recovery_rate", F.lit(0.0)), ["x"])


def test_exposure_share_and_fallbacks(spark):
    rows = [(i, float(i % 7), 50.0 + i % 90, 100.0) for i in range(300)] + [(900, 1.0, 70.0, 0.0), (901, None, 70.0, 100.0), (902, 1.0, None, None)]
    df = spark.createDataFrame(rows, "id long, x double, balance double, credit double")
    model = severity.fit_exposure(df, ["x"], "balance", "credit")
    got = {r.id: r for r in model.score(df, "credit", "balance").collect()}
    assert all(0 < got[i].ead_ratio < 1.5 and got[i].ead == pytest.approx(100 * got[i].ead_ratio) for i in range(300))
    assert [(got[i].ead, got[i].is_ead_modelled) for i in (900, 901, 902)] == [(70.0, False), (70.0, False), (0.0, False)]
    assert np.mean([got[i].ead_ratio for i in range(300)]) == pytest.approx(np.mean([min(1.5, r[2] / r[3]) for r in rows[:300]]), abs=1e-6)


def selection_rows(spark, n=1500):
    rng = np.random.default_rng(8)
    a, b, c = rng.normal(size=(3, n))
    y = (rng.random(n) < 1 / (1 + np.exp(-(-1 + a + 0.5 * b)))).astype(int)
    return spark.createDataFrame(
        [(float(p), float(p * 2 + 0.4 * r), float(q), float(r), int(t)) for p, q, r, t in zip(a, b, c, y)], "a double, twin double, b double, noise double, target int"
    )


def by_full_fits(df, features):
    """A fit for every candidate at every step, the most likely one taken."""
    best, left = None, list(features)
    while left:
        fits = [models.fit_logistic(df, [*(best.features if best else ()), f]) for f in left]
        fits = [f for f in fits if f.p_values[f.features[-1]] <= 0.05 and (best is None or f.aic < best.aic)]
        if not fits:
            return best
        best = min(fits, key=lambda f: f.aic)
        left.remove(best.features[-1])
    return best


def test_selection_by_score_tests_chooses_what_full_fits_choose(spark):
    df = selection_rows(spark)
    features = ["noise", "twin", "b", "a"]
    want, got = by_full_fits(df, features), models.select_forward(df, features)
    assert got.fit.features == want.features and got.stopped == "not_significant"
    assert got.fit.aic == pytest.approx(want.aic) and got.fit.coefficients == pytest.approx(want.coefficients, rel=1e-5)
    old = models.forward_selection(df, features)
    assert old.p_values == pytest.approx(want.p_values, rel=1e-3, abs=1e-12)


def test_rounding_of_sums_costs_no_passes(spark, monkeypatch):
    """Over many rows the loss is only known to some 1e-11 of itself; each pass finds a little more here."""
    df, calls = selection_rows(spark), []

    def rising(*args):
        sums = gram(*args).copy()
        calls.append(1)
        if len(sums) > 2:
            sums[-2, -2] *= 1 + 5e-12 * len(calls)
        return sums

    want = models.select_forward(df, ["noise", "twin", "b", "a"], max_features=2)
    monkeypatch.setattr(fractional, "gram", rising)
    got = models.select_forward(df, ["noise", "twin", "b", "a"], max_features=2)
    assert got.fit.features == want.fit.features == ("a", "b") and got.fit.converged
    assert got.fit.coefficients == pytest.approx(want.fit.coefficients, rel=1e-9)
    assert [s.statistic for s in got.steps] == pytest.approx([s.statistic for s in want.steps], rel=1e-9)
    assert len(calls) <= 18  # one a Newton step, one for all candidates of a step, one for robust errors at the end


def test_gram_of_wide_rows(spark):
    x = np.random.default_rng(3).integers(-9, 9, (50, 15)).astype(float)
    df = spark.createDataFrame(x.tolist(), ", ".join(f"c{i} double" for i in range(15)))
    for n in (12, 13, 15):
        cells = [F.col(f"c{i}") for i in range(n)]
        assert np.array_equal(gram(df, cells), x[:, :n].T @ x[:, :n])
        assert not gram(df.where("false"), cells).any()
        for odd in (None, float("nan")):
            with pytest.raises(Exception, match="null|NaN|Encountered"):
                gram(df, [*cells[:-1], F.lit(odd).cast("double")])


def test_selection_says_why_it_stopped(spark):
    df = selection_rows(spark)
    assert models.select_forward(df, ["a", "b", "twin"], max_features=1).stopped == "max_features"
    full = models.select_forward(df, ["a", "b"], family={"a": "f", "b": "f"}, max_per_family=1)
    assert full.stopped == "no_candidate" and [s.feature for s in full.steps] == ["a"]
    assert models.select_forward(df.withColumn("copy", F.col("a") * 3), ["a", "copy"]).stopped == "no_candidate"
    nothing = models.select_forward(df.select((F.hash("a") % 2).cast("double").alias("x"), "target"), ["x"], max_p=1e-9)
    assert nothing.fit is None and nothing.steps == () and nothing.table(spark).count() == 0


def gap_by_pairs(rows):
    bads, goods = [r for r in rows if r[2]], [r for r in rows if not r[2]]
    beats = lambda x, y: 1.0 if x < y else 0.5 if x == y else 0.0
    v = np.asarray([[np.mean([beats(p[k], q[k]) for q in goods]) for k in (0, 1)] for p in bads])
    w = np.asarray([[np.mean([beats(p[k], q[k]) for p in bads]) for k in (0, 1)] for q in goods])
    auc = v.mean(axis=0)
    var = np.var(v[:, 1] - v[:, 0], ddof=1) / len(v) + np.var(w[:, 1] - w[:, 0], ddof=1) / len(w)
    return 2 * auc - 1, 2 * (auc[1] - auc[0]), 2 * math.sqrt(var)


def test_gini_gap_is_that_of_all_pairs(spark):
    rng = random.Random(6)
    rows = [(float(rng.randint(0, 9)), float(rng.randint(0, 30)), int(rng.random() < 0.3)) for _ in range(150)]
    rows = [(s - 3 * t, r - 2 * t, t) for s, r, t in rows]
    extra = [(None, 1.0, 1), (1.0, None, 0), (1.0, 1.0, None)]
    got = comparison.gini_gap(spark.createDataFrame(rows + extra, "`s.1` double, r double, target int"), "s.1", "r").first()
    gini, gap, error = gap_by_pairs(rows)
    assert (got.gini_a, got.gini_b, got.gap, got.gap_error, got.z) == pytest.approx((*gini, gap, error, gap / error))
    assert got.n_bads + got.n_goods == 150
    few = comparison.gini_gap(spark.createDataFrame([(1.0, 2.0, 1), (2.0, 1.0, 0)], "s double, r double, target int"), "s", "r").first()
    assert few.gini_a == 1.0 and few.gini_b == -1.0 and few.gap_error is None
    none = comparison.gini_gap(spark.createDataFrame([], "s double, r double, target int"), "s", "r").first()
    assert none.gini_a is None and none.gap is None
