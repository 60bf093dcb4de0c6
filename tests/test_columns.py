import datetime as dt

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortlake.functions import columns as fx
from cohortlake.functions.quantiles import exact_quantiles
from tests.conftest import rows


def one(spark, ddl, values, *exprs):
    return [tuple(r) for r in spark.createDataFrame(values, ddl).select(*exprs).collect()]


def test_status_decoding(spark):
    values = [("C",), ("X",), ("0",), ("5",), (" c",), ("x ",), ("9",), ("?",), (None,)]
    got = [r[0] for r in one(spark, "s string", values, fx.status_bucket("s"))]
    assert got == [0, None, 0, 5, 0, None, None, None, None]


def test_employment_and_term(spark):
    values = [("10+ years",), ("1 year",), ("< 1 year",), ("n/a",), ("7 years",), ("many",), (None,)]
    assert [r[0] for r in one(spark, "s string", values, fx.employment_years("s"))] == [10, 1, 0, 0, 7, None, None]
    assert one(spark, "s string", [(" 36 months",), ("x",)], fx.term_months("s")) == [(36,), (None,)]


def test_month_year_pivot_and_rubbish(spark):
    values = [("Jan-69",), ("Dec-68",), ("Feb-99",), ("may-00",), ("Mar-2013",), ("Foo-12",), ("Ebm-12",), ("",), (None,)]
    got = [r[0] for r in one(spark, "s string", values, fx.parse_month_year("s"))]
    assert got == [
        dt.date(1969, 1, 1), dt.date(2068, 12, 1), dt.date(1999, 2, 1), dt.date(2000, 5, 1), dt.date(2013, 3, 1),
        None, None, None, None,
    ]
    moved = one(spark, "s string", [("Dec-20",)], fx.parse_month_year("s", pivot=20))
    assert moved == [(dt.date(1920, 12, 1),)]


def test_months_since_rounds_half_even(spark):
    # 30.436875 days is one month; 15 days below and above half a month.
    got = one(spark, "d date", [(dt.date(2017, 11, 1),), (dt.date(2018, 12, 1),), (None,)], fx.months_since("d"))
    assert [None if r[0] is None else float(r[0]) for r in got] == [1.0, -12.0, None]


def test_clip_and_ratio_keep_null(spark):
    got = one(spark, "a double, b double", [(None, 1.0), (3.0, 2.0), (-1.0, 0.0)], fx.clip("a", 0, 1), fx.safe_ratio("a", "b"))
    assert got == [(None, None), (1.0, 1.5), (0.0, None)]


def test_slopes_differ_only_with_missing_values(spark):
    full = [(m, 2.0 * m) for m in range(6)]
    holes = [(m, 2.0 * m if m % 2 else None) for m in range(6)]
    for values, equal in ((full, True), (holes, False)):
        df = spark.createDataFrame(values, "m int, y double")
        a, b = df.agg(fx.pairwise_slope(F.col("y"), F.col("m")), fx.marginal_slope(F.col("y"), F.col("m"))).first()
        assert a == pytest.approx(2.0)
        assert (b == pytest.approx(2.0)) is equal
    single = spark.createDataFrame([(1, 5.0)], "m int, y double")
    assert single.agg(fx.pairwise_slope(F.col("y"), F.col("m"))).first()[0] is None
    assert single.agg(fx.marginal_slope(F.col("y"), F.col("m"))).first()[0] is None


def test_row_hash_sees_null_positions(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a", None, "b")], "x string, y string, z string")
    hashes = [r[0] for r in df.select(fx.row_hash(df.columns)).collect()]
    assert hashes[0] == hashes[2] != hashes[1]


def test_hash_bucket_is_even_and_stable(spark):
    df = spark.range(20_000).select(fx.hash_bucket("id", 42, 100).alias("b"))
    counts = dict(rows(df.groupBy("b").count()))
    assert sorted(counts) == list(range(100))
    assert max(counts.values()) < 2 * min(counts.values())


# -- exact quantiles ------------------------------------------------------------------

PROBS = [0.0, 0.25, 0.5, 0.75, 0.95, 0.995, 1.0]


def check_quantiles(spark, values, partitions=4):
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(partitions)
    got = exact_quantiles(df, {"v": PROBS})["v"]
    assert got == pytest.approx([float(np.quantile(values, p)) for p in PROBS])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60))
def test_quantiles_of_small_lists(spark, values):
    check_quantiles(spark, values)


def test_quantiles_of_skewed_values(spark):
    rng = np.random.default_rng(7)
    check_quantiles(spark, rng.normal(size=5_000))
    check_quantiles(spark, rng.exponential(size=3_000) ** 4)


def test_quantiles_with_one_dominant_value(spark):
    rng = np.random.default_rng(8)
    check_quantiles(spark, np.concatenate([np.full(4_000, 1.5), rng.uniform(0, 9, 4_000)]))


def test_quantiles_skip_null_and_empty(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None)], "a double, b double")
    assert exact_quantiles(df, {"a": [0.5], "b": [0.5]}) == {"a": [2.0], "b": [None]}
