import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortlake.operators import loans, scorecard
from tests.conftest import rows


def brute_force_woe(df: pd.DataFrame, variable: str, target: str) -> pd.DataFrame:
    out = df.groupby(variable)[target].agg(["count", "mean"]).reset_index()
    good = out["mean"] * out["count"]
    bad = (1 - out["mean"]) * out["count"]
    out["woe"] = np.log((good / good.sum()) / (bad / bad.sum()))
    out["iv"] = (((good / good.sum()) - (bad / bad.sum())) * out["woe"]).sum()
    return out.sort_values("woe").reset_index(drop=True)


def test_woe_against_pandas(spark):
    rng = np.random.default_rng(3)
    # One category holds a third of all rows.
    grade = rng.choice(list("ABCDE"), 3_000, p=[1 / 3, 1 / 6, 1 / 6, 1 / 6, 1 / 6])
    pdf = pd.DataFrame({"grade": grade, "good": (rng.uniform(size=3_000) < 0.5 + 0.08 * (grade == "A")).astype(int)})
    got = scorecard.woe_discrete(spark.createDataFrame(pdf), "grade", "good").orderBy("rank").toPandas()
    want = brute_force_woe(pdf, "grade", "good")
    assert list(got["grade"]) == list(want["grade"])
    for mine, theirs in (("n_obs", "count"), ("prop_good", "mean"), ("woe", "woe"), ("iv", "iv")):
        assert got[mine].to_numpy() == pytest.approx(want[theirs].to_numpy())
    assert got["diff_woe"].to_numpy()[1:] == pytest.approx(want["woe"].diff().abs().to_numpy()[1:])
    assert math.isnan(got["diff_woe"][0]) and got["prop_n_obs"].sum() == pytest.approx(1)


def test_empty_class_and_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 0), ("b", 1), (None, 1), ("c", None)], "v string, good int")
    got = {r.category: r for r in scorecard.woe_tables(df, ["v"], "good").collect()}
    assert set(got) == {"a", "b"} and got["a"].woe is None and got["b"].woe is not None
    smooth = {r.category: r.woe for r in scorecard.woe_tables(df, ["v"], "good", smoothing=0.5).collect()}
    assert smooth["a"] == pytest.approx(math.log((2.5 / 4) / (0.5 / 2)))


def test_many_variables_equal_single_ones(spark):
    df = spark.range(500).select(
        (F.col("id") % 7).alias("x"), (F.col("id") % 3).alias("y"), (F.pmod(F.xxhash64("id"), F.lit(2))).alias("good")
    )
    both = scorecard.woe_tables(df, ["x", "y"], "good")
    for v in ("x", "y"):
        alone = scorecard.woe_tables(df, [v], "good")
        assert rows(both.filter(F.col("variable") == v)) == rows(alone)


def test_dummies(spark):
    df = spark.createDataFrame([("RENT",), ("OWN",), (None,), ("NONE",)], "home string")
    out = scorecard.one_hot(df, ["home"])
    assert out.columns == ["home", "home:NONE", "home:OWN", "home:RENT"]
    assert [tuple(r)[1:] for r in out.collect()] == [(0, 0, 1), (0, 1, 0), (0, 0, 0), (1, 0, 0)]
    merged = scorecard.merge_dummies(out, "home", ["RENT", "NONE", "ANY"])
    assert [r["home:RENT_NONE_ANY"] for r in merged.collect()] == [1, 0, 0, 1]
    with pytest.raises(ValueError):
        scorecard.categories(df, ["home"], max_categories=2)
    label = df.select(scorecard.coarse_class("home", {"other": ["RENT", "NONE"]}).alias("c"))
    assert [r.c for r in label.collect()] == ["other", "OWN", None, "other"]


def test_split_is_stable_when_rows_are_added(spark):
    few = scorecard.hash_split(spark.range(1_000), "id")
    many = scorecard.hash_split(spark.range(5_000).repartition(7), "id")
    assert rows(few) == rows(many.filter("id < 1000"))
    assert 150 < few.filter("split = 'test'").count() < 250
    assert rows(scorecard.hash_split(spark.range(1_000), "id", seed=1)) != rows(few)


# -- loans ------------------------------------------------------------------------------------

STATUSES = [("Charged Off",), ("Fully Paid",), ("Late (31-120 days)",), ("Current",), ("Issued",), (None,)]


def test_outcomes(spark):
    df = spark.createDataFrame(STATUSES, "loan_status string")
    got = df.select(loans.outcome_class("loan_status"), loans.good_bad("loan_status")).collect()
    assert [tuple(r) for r in got] == [
        ("BAD", 0), ("GOOD", 1), ("INDETERMINATE", 0), ("EXCLUDED", 1), ("unmapped", 1), ("unmapped", 1),
    ]
    assert rows(loans.matured(df)) == [("Charged Off", 1), ("Fully Paid", 0)]
    assert rows(loans.unmapped_statuses(df)) == [("Issued",)]
    report = {r.loan_status: (r.n, r.share) for r in loans.status_report(df).collect()}
    assert report[None] == (1, pytest.approx(1 / 6))


def test_vintages(spark):
    df = spark.createDataFrame(
        [("2011-12-31", 1), ("2012-01-01", 1), ("2014-12-31", 0), ("2015-01-01", 0), ("2016-01-01", 1)], "d string, target int"
    ).withColumn("d", F.to_date("d"))
    assert rows(loans.vintage_split(df, "d").select("target", "sample"), "sample", "target") == [(0, "dev"), (1, "dev"), (0, "oot")]
    rates = loans.sample_rates(df, "d").first()
    assert (rates.rate_dev, rates.rate_oot, rates.drift, rates.gate) == (0.5, 0.0, 1.0, "FAIL")
    # three bads have matured, one of them inside a sample: the gate counts all three
    assert [loans.sample_rates(df, "d", min_bads=n).first().gate for n in (3, 4)] == ["PASS", "FAIL"]
    matured = df.select(loans.is_fully_matured("d")).collect()
    assert [r[0] for r in matured] == [True, True, True, True, False]
    assert df.filter("d = '2015-01-01'").select(loans.is_fully_matured("d", 48)).first()[0] is False


def test_recovery(spark):
    df = spark.createDataFrame([(0.0, 100.0), (100.0, 100.0), (250.0, 100.0), (25.0, 100.0), (None, 100.0), (5.0, 0.0)], "rec double, funded double")
    got = loans.recovery_summary(loans.with_recovery_rate(df, "rec", "funded"), "rec").first()
    assert (got.n_loans, got.n_with_recovery) == (6, 4)
    assert got.share_zero == pytest.approx(1 / 6) and got.share_full == pytest.approx(2 / 6)
    assert got.mean_rate == pytest.approx((0 + 1 + 1 + 0.25) / 4)


def test_column_rules(spark):
    columns = ["id", "loan_amnt", "grade", "recoveries", "issue_d", "term", "loan_status", "sec_app_x", "emp_title", "dti"]
    assert loans.feature_columns(columns) == ["loan_amnt", "grade", "dti"]
    assert loans.feature_columns(columns, include_lender_decision=False) == ["loan_amnt", "dti"]
    assert loans.excluded_summary(columns) == {
        "identifier": ["id"], "post_outcome": ["recoveries"], "application": ["issue_d", "term"],
        "target_source": ["loan_status"], "sparse": ["sec_app_x"], "free_text": ["emp_title"],
    }
    assert not loans.classify("last_fico_range_low").usable and loans.classify("sub_grade").usable
    assert loans.column_rules(spark, columns).filter("usable").count() == 5
