import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortlake.functions.running import bucketed, running_totals
from cohortlake.operators import binning, losses, models, sampling, scaling, strategy, tradelines, validation
from tests.conftest import rows

# -- running totals -----------------------------------------------------------------------


@pytest.mark.parametrize("pieces", [1, 2, 7, 200])
def test_running_totals_of_missing_keys(spark, pieces):
    data = [(float(i), 1) for i in range(50)] + [(float("nan"), 10), (None, 100)]
    df = spark.createDataFrame(data, "k double, v int")
    got = {repr(r.k): (r.cum_v, r.total_v) for r in running_totals(df, "k", ["v"], pieces).collect()}
    assert got == {**{repr(float(i)): (i + 1, 160) for i in range(50)}, "nan": (60, 160), "None": (160, 160)}


def test_separation_of_nan_scores(spark):
    rng = random.Random(1)
    data = [(float("nan") if i % 10 == 0 else float(rng.randint(0, 300)), int(rng.random() < 0.3)) for i in range(1000)]
    got = validation.separation(spark.createDataFrame(data, "score double, target int")).first()
    place = [(float("inf") if s != s else s, t) for s, t in data]
    bads, goods = [s for s, t in place if t], [s for s, t in place if not t]
    wrong = sum((g < b) + (g == b) / 2 for b in bads for g in goods)
    ks = max(abs(sum(b <= s for b in bads) / len(bads) - sum(g <= s for g in goods) / len(goods)) for s in {s for s, _ in place})
    assert (got.n, got.n_bads) == (1000, len(bads)) and got.ks == pytest.approx(ks)
    assert got.auc == pytest.approx(1 - wrong / len(bads) / len(goods)) and got.gini == pytest.approx(2 * got.auc - 1)


@pytest.mark.parametrize("pieces", [1, 2, 7, 200])
def test_running_totals(spark, pieces):
    values = [(float(k), (k * 37) % 11) for k in range(500)]
    df = spark.createDataFrame(values, "k double, v int").repartition(5)
    got = {r.k: (r.cum_v, r.total_v) for r in running_totals(df, "k", ["v"], pieces).collect()}
    total, everything = 0, sum(v for _, v in values)
    for k, v in values:
        total += v
        assert got[k] == (total, everything)


def test_bucket_edges_and_missing(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (0.5,), (1.0,), (9.0,), (None,), (float("nan"),)], "x double")
    assert [r.b for r in bucketed(df, "x", [0.0, 1.0, 1.0], "b").collect()] == [0, 1, 1, 2, 2, None, None]
    assert [r.b for r in bucketed(df, "x", [], "b").collect()][:2] == [0, 0]


# -- binning ---------------------------------------------------------------------------------

COUNTS = st.lists(st.tuples(st.integers(1, 400), st.floats(0, 1)), min_size=1, max_size=20)


@settings(max_examples=200, deadline=None)
@given(COUNTS)
def test_merged_bins_keep_every_row_and_are_monotone(counts):
    bins = [
        binning.Bin(-math.inf if i == 0 else i, math.inf if i == len(counts) - 1 else i + 1, n, int(n * rate))
        for i, (n, rate) in enumerate(counts)
    ]
    rule = binning.BinRule()
    merged = binning.merge_monotone(bins, rule)
    assert sum(b.n for b in merged) == sum(b.n for b in bins) and sum(b.bads for b in merged) == sum(b.bads for b in bins)
    assert merged[0].low == -math.inf and merged[-1].high == math.inf
    assert all(a.high == b.low for a, b in zip(merged, merged[1:]))
    assert len(merged) <= rule.max_bins
    rates = [b.bad_rate for b in merged]
    assert rates == sorted(rates) or rates == sorted(rates, reverse=True)
    if len(merged) > 1:
        assert all(b.n >= rule.min_share * sum(x.n for x in bins) and b.bads >= rule.min_bads for b in merged)


def _sample(spark, n=4_000):
    key = F.col("id")
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000
    df = spark.range(n).withColumn("x", F.when(key % 10 != 0, (key % 97).cast("double")))
    risk = F.when(F.col("x").isNull(), 0.5).otherwise(0.05 + F.col("x") / 200)
    return df.withColumn("flat", (key % 7).cast("double")).withColumn("target", (noise < risk).cast("int"))


def test_fitted_bins_match_the_rows(spark):
    df = _sample(spark)
    fitted = binning.fit_bins(df, ["x", "flat"], "target")
    *ordered, missing = fitted["x"]
    assert missing.missing and missing.n == 400 and len(ordered) > 2
    for i, b in enumerate(ordered):
        inside = df.filter((F.col("x") >= b.low) & (F.col("x") < b.high))
        assert (inside.count(), inside.filter("target = 1").count()) == (b.n, b.bads), i
    table = binning.bin_table(spark, fitted)
    iv = {r.variable: r.iv for r in table.collect()}
    assert iv["x"] > 0.1 > iv["flat"]
    woe = binning.woe_transform(df, fitted)
    assert woe.filter("x_woe IS NULL").count() == 0
    assert woe.select("x_woe").distinct().count() == len(fitted["x"])


def test_iv_bands(spark):
    df = spark.createDataFrame([(0.01,), (0.05,), (0.2,), (0.5,), (0.6,)], "iv double")
    assert [r.b for r in df.select(binning.iv_band("iv").alias("b")).collect()] == ["drop", "weak", "medium", "strong", "investigate"]


# -- validation -----------------------------------------------------------------------------------


def test_separation_against_pairs(spark):
    rng = np.random.default_rng(5)
    score, bad = rng.integers(300, 330, 400), rng.integers(0, 2, 400)
    df = spark.createDataFrame([(float(s), int(b)) for s, b in zip(score, bad)], "score double, target int")
    got = validation.separation(df).first()
    g, b = score[bad == 0], score[bad == 1]
    wins = (g[:, None] > b[None, :]).mean() + 0.5 * (g[:, None] == b[None, :]).mean()
    ks = max(abs((b <= s).mean() - (g <= s).mean()) for s in score)
    assert got.auc == pytest.approx(wins) and got.gini == pytest.approx(2 * wins - 1) and got.ks == pytest.approx(ks)
    assert got.divergence == pytest.approx(2 * (g.mean() - b.mean()) ** 2 / (g.var() + b.var()))


def test_separation_of_one_class(spark):
    got = validation.separation(spark.createDataFrame([(1.0, 0), (2.0, 0)], "score double, target int")).first()
    assert got.n_bads == 0 and got.auc is None and got.ks is None


def test_psi_of_equal_samples_is_zero(spark):
    df = spark.range(1_000).withColumn("v", (F.col("id") % 100).cast("double"))
    same = validation.psi(df, df, "v").first()
    assert same.psi == pytest.approx(0) and same.verdict == "stable"
    moved = validation.psi(df, df.withColumn("v", F.col("v") + 60), "v").first()
    assert moved.verdict == "unusable"


def test_direction(spark):
    assert validation.observed_direction(validation.bad_rate_by_band(_sample(spark), "x", bands=4)).first().direction == "+"


# -- scaling ----------------------------------------------------------------------------------------


def test_scale_anchor_and_doubling(spark):
    df = spark.createDataFrame([(1 / 51,), (1 / 101,), (0.0,), (1.0,), (None,)], "pd double")
    got = [r.s for r in df.select(scaling.score_of_pd("pd").alias("s")).collect()]
    assert got[:2] == [pytest.approx(600), pytest.approx(620)] and got[2:] == [None, None, None]


def test_points_add_up_to_the_model_score(spark):
    df = _sample(spark)
    fitted = binning.fit_bins(df, ["x", "flat"], "target")
    woe = binning.woe_transform(df, fitted)
    fit = models.fit_logistic(woe, ["x_woe"])
    assert fit.coefficients["x_woe"] == pytest.approx(-1, abs=0.1) and fit.p_values["x_woe"] < 0.01
    table = scaling.points(fitted, {"x": fit.coefficients["x_woe"]}, fit.intercept)
    scored = scaling.with_points(fit.score(woe), fitted, table)
    gap = scored.agg(F.max(F.abs(F.col("score") - scaling.score_of_pd("pd")))).first()[0]
    assert gap < 1e-6


def test_reasons_are_the_largest_shortfalls(spark):
    df = spark.createDataFrame([(10.0, 5.0, 0.0, 9.0), (20.0, 20.0, 20.0, 20.0)], "a_points double, b_points double, c_points double, d_points double")
    got = scaling.reason_codes(df, {"a": 20, "b": 20, "c": 20, "d": 20}).select("reasons").collect()
    assert [r.reasons for r in got] == [["c", "b", "d"], []]
    assert scaling.sign_check({"a": -1.0, "b": -0.5, "c": 0.2}) == ["c"]


# -- losses ---------------------------------------------------------------------------------------------


def test_default_and_recovery(spark):
    data = [
        (1, 1, "CC", -20, 0, 100.0, 200.0), (1, 1, "CC", -15, 95, 80.0, 200.0), (1, 1, "CC", -14, 120, 90.0, 200.0),
        (1, 1, "CC", -3, 0, 20.0, 200.0),
        (2, 1, "CC", -5, 99, 50.0, 100.0), (2, 1, "CC", -1, 99, 50.0, 100.0),
        (3, 1, "CC", -5, 10, 50.0, 100.0),
    ]
    df = spark.createDataFrame(data, "account_id int, customer_id int, product_type string, month_idx int, dpd int, balance double, credit_limit double")
    got = {r.account_id: r for r in losses.with_recovery(losses.default_events(df)).collect()}
    assert set(got) == {1, 2}
    assert (got[1].default_month, got[1].balance_at_default, got[1].is_covered, got[1].recovery_rate) == (-15, 80.0, True, 0.75)
    assert got[2].is_covered is False and got[2].lgd is None
    stages = losses.recovery_stages(spark.createDataFrame([(0.0,), (0.0,), (1.0,), (0.5,), (None,)], "recovery_rate double")).first()
    assert (stages.n, stages.p_recovery, stages.recovery_if_any, stages.lgd) == (4, 0.5, 0.75, 0.625)


def test_exposure_and_fallbacks(spark):
    df = spark.createDataFrame([(300.0, 100.0, 50.0), (80.0, 100.0, 100.0), (80.0, 0.0, 10.0)], "d double, l double, o double")
    got = [tuple(r) for r in df.select(*[c.alias(n) for n, c in losses.exposure_measures("d", "l", "o").items()]).collect()]
    assert got == [(1.5, 5.0, False), (0.8, None, None), (None, -7.0, False)]
    el = losses.expected_loss(spark.createDataFrame([(0.1, None, None, 100.0), (0.1, 0.5, 200.0, 100.0)], "pd double, lgd double, ead double, balance double"))
    assert [(r.is_modelled, round(r.el, 6), round(r.el_flat, 6)) for r in el.collect()] == [(False, 8.7, 8.7), (True, 10.0, 8.7)]


# -- strategy ----------------------------------------------------------------------------------------------


def test_overrides_only_tighten(spark):
    df = spark.createDataFrame([(a, f) for a in strategy.ACTIONS for f in (True, False, None)], "action string, flag boolean")
    out = strategy.with_overrides(df, "action", [(F.col("flag"), "hold")]).collect()
    for r in out:
        before, after = strategy.ACTIONS.index(r.action), strategy.ACTIONS.index(r.final_action)
        assert after == (max(before, 2) if r.flag else before) and r.is_overridden == (after > before)


def test_tree_leaves_are_large_and_pure_enough(spark):
    df = _sample(spark).filter("x IS NOT NULL")
    model = strategy.fit_tree(df, ["x", "flat"])
    leaves = strategy.leaf_table(model, df, ["x", "flat"]).collect()
    assert 2 <= len(leaves) <= 16 and sum(r.n for r in leaves) == df.count()
    assert all(r.share >= 0.02 for r in leaves)
    assert max(r.bad_rate for r in leaves) > 2 * min(r.bad_rate for r in leaves)


def test_buckets(spark):
    df = spark.createDataFrame([(499.9,), (500.0,), (649.0,), (700.0,), (None,)], "score double")
    assert [r.bucket for r in strategy.risk_bucket(df).collect()] == ["E", "D", "B", "A1", None]


# -- sampling --------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("pieces", [1, 5, 64])
def test_as_of_join_against_brute_force(spark, pieces):
    rng = np.random.default_rng(9)
    left = [(int(k), int(t)) for k, t in zip(rng.integers(0, 5, 80), rng.integers(0, 40, 80))]
    # One key holds most of the right side, with repeated times.
    right = [(int(k), int(t), int(v)) for k, t, v in zip(rng.choice([0, 0, 0, 1, 2, 3], 200), rng.integers(0, 40, 200), rng.integers(0, 99, 200))]
    got = sampling.as_of_join(
        spark.createDataFrame(left, "k int, at int"), spark.createDataFrame(right, "k int, t int, v int"), ["k"], "at", "t", ["v"], pieces
    )
    want = []
    for k, at in left:
        seen = [(t, v) for kk, t, v in right if kk == k and t <= at]
        want.append((k, at, max(seen)[1] if seen else None))
    assert rows(got) == sorted(want, key=repr)


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_as_of_join_on_dates(spark, kind):
    left = spark.createDataFrame([(1, "2020-01-05"), (1, "2019-12-31"), (2, "2020-01-05")], "k int, d string")
    right = spark.createDataFrame([(1, "2020-01-01", "a"), (1, "2020-01-05", "b"), (1, "2020-02-01", "c")], "k int, d string, v string")
    left, right = (df.withColumn("d", F.col("d").cast(kind)) for df in (left, right))
    got = sampling.as_of_join(left, right.withColumnRenamed("d", "t"), ["k"], "d", "t", ["v"])
    assert {(r.k, str(r.d)[:10]): r.v for r in got.collect()} == {(1, "2020-01-05"): "b", (1, "2019-12-31"): None, (2, "2020-01-05"): None}


def test_stratified_split_has_the_share_in_each_stratum(spark):
    df = spark.range(5_000).withColumn("target", (F.col("id") % 50 == 0).cast("int"))
    split = sampling.stratified_split(df, "id", "target", [0, 1])
    for t, n in ((0, 4_900), (1, 100)):
        train = split.filter((F.col("target") == t) & (F.col("split") == "train")).count()
        assert abs(train - 0.7 * n) <= 1
    again = sampling.stratified_split(df.repartition(9), "id", "target", [0, 1])
    assert rows(split) == rows(again)


def test_down_sample_restores_the_bad_rate(spark):
    df = spark.range(20_000).withColumn("target", (F.col("id") % 40 == 0).cast("int"))
    kept = sampling.down_sample(df, "id", "target", 20)
    n, bads = kept.agg(F.sum("weight"), F.sum(F.col("weight") * F.col("target"))).first()
    assert bads == 500 and n == pytest.approx(20_000, rel=0.05) and kept.count() < 5_000


# -- models ---------------------------------------------------------------------------------------------------------


def test_selection_and_statistics(spark):
    df = _sample(spark, 2_000).filter("x IS NOT NULL").withColumn("twin", F.col("x") * 2 + F.col("flat") * 0.01)
    assert {p[:2] for p in models.correlated_pairs(df, ["x", "flat", "twin"])} == {("twin", "x")}
    vif = models.variance_inflation(df, ["x", "flat"])
    assert vif["x"] == pytest.approx(1, abs=0.05)
    chosen = models.forward_selection(df, ["x", "twin", "flat"], family={"x": "one", "twin": "one"}, max_per_family=1)
    assert len({"x", "twin"} & set(chosen.features)) == 1 and "x" in chosen.features or "twin" in chosen.features
    challenger = models.fit_challenger(df, ["x", "flat"], rounds=3)
    scored = models.score_challenger(challenger, df, ["x", "flat"]).withColumn("score", 1 - F.col("pd_challenger"))
    assert validation.separation(scored).first().gini > 0.2


def test_fractional_targets(spark):
    df = spark.createDataFrame([(float(i), min(1.0, i / 20)) for i in range(30)], "x double, rate double")
    fit = models.fit_logistic(df, ["x"], target="rate")
    assert fit.coefficients["x"] > 0
    bounds = fit.score(df).agg(F.min("pd"), F.max("pd")).first()
    assert 0 < bounds[0] < bounds[1] < 1


def test_inquiries_and_income(spark):
    df = spark.createDataFrame([(1, 2, 3, 50.0, 100.0), (None, None, None, 50.0, 0.0)], "m int, q int, y int, bureau_total_debt double, AMT_INCOME_TOTAL double")
    got = tradelines.debt_to_income(tradelines.inquiry_features(df, "m", "q", "y")).select(
        "n_inquiries_3m", "n_inquiries_12m", "inquiry_velocity", "dti_bureau"
    )
    assert [tuple(r) for r in got.collect()] == [(3, 6, 0.5, 0.5), (0, 0, None, None)]


def test_missing_values_are_rows_like_others(spark):
    import math

    from cohortlake.operators import models, profiling, sampling, scaling, strategy
    from cohortlake.operators.binning import Bin, by_bin, woe_of

    data = [(i, None if i % 4 == 0 else float("nan") if i % 4 == 1 else float(i % 7), i % 3 % 2, None if i % 5 == 0 else i % 2) for i in range(400)]
    df = spark.createDataFrame(data, "k long, n_rows double, target int, s int")
    model = models.fit_challenger(df, ["n_rows"], rounds=2)
    assert models.score_challenger(model, df, ["n_rows"]).count() == 400
    tree = strategy.fit_tree(df, ["n_rows"])
    assert sum(r.n for r in strategy.leaf_table(tree, df, ["n_rows"]).collect()) == 400
    with pytest.raises(Exception):
        models.correlation_matrix(df, ["n_rows", "k"])
    assert sampling.stratified_split(df, "k", "s", [0, 1]).where("split IS NULL").count() == 0
    assert {r["column"]: r.n_null for r in profiling.null_counts(df).collect()} == {"k": 0, "n_rows": 100, "target": 0, "s": 80}
    bins = [Bin(-math.inf, 3.0, 100, 10), Bin(3.0, math.inf, 100, 30)]
    table = scaling.points({"n_rows": bins}, {"n_rows": -0.8}, -1.5)
    scored = scaling.with_points(df, {"n_rows": bins}, table)
    scale = scaling.Scale()
    neutral = scale.offset + 1.5 * scale.factor
    missing = {round(r.score, 6) for r in scored.where("n_rows IS NULL OR isnan(n_rows)").collect()}
    assert missing == {round(neutral, 6)}
    got = {r.w for r in df.where("isnan(n_rows)").select(by_bin("n_rows", bins, woe_of(bins)).alias("w")).collect()}
    assert got == {0.0}
