import pytest
from pyspark.sql import functions as F

from cohortlake import config as cfg
from cohortlake.operators import profiling, quality, sets
from tests.conftest import rows


def status(df):
    return [r["status"] for r in df.collect()]


def test_row_counts(spark):
    ten = spark.range(10)
    found = quality.row_counts(spark, {"a": ten, "b": ten, "c": ten}, {"a": 10, "b": 11, "c": None, "d": 5})
    assert {r.target: r.status for r in found.collect()} == {"a": "PASS", "b": "FAIL", "c": "PASS", "d": "WARN"}


def test_key_uniqueness(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (None, 1), (None, 1)], "a int, b int")
    assert quality.key_uniqueness(df, "t", ["a", "b"]).first().n_bad == 2
    assert status(quality.key_uniqueness(df.distinct(), "t", ["a", "b"])) == ["PASS"]
    assert status(quality.key_uniqueness(df, "t", [])) == ["PASS"]
    assert status(quality.key_uniqueness(df.limit(0), "t", ["a"])) == ["PASS"]


@pytest.mark.parametrize(
    "orphans, partial, want", [(0, False, "PASS"), (0, True, "PASS"), (1, False, "FAIL"), (2, True, "WARN"), (4, True, "FAIL")]
)
def test_referential_materiality(spark, orphans, partial, want):
    child = spark.range(10).unionByName(spark.range(3))
    parent = spark.range(orphans, 10)
    edge = cfg.Reference("c", "id", "p", "id", partial)
    found = quality.referential(child, parent, edge).first()
    assert (found.status, found.n_bad, found.n_total) == (want, orphans, 10)
    assert found.n_orphan_rows == orphans + min(orphans, 3) and found.n_child_rows == 13


def test_referential_null_is_an_orphan(spark):
    child = spark.createDataFrame([(1,), (None,), (None,)], "k int")
    found = quality.referential(child, spark.createDataFrame([(1,), (None,)], "k int"), cfg.Reference("c", "k", "p", "k")).first()
    assert (found.n_bad, found.n_total, found.n_orphan_rows) == (1, 2, 2)


def test_referential_with_one_dominant_id(spark):
    child = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    found = quality.referential(child, spark.range(8).withColumnRenamed("id", "k"), cfg.Reference("c", "k", "p", "k")).first()
    known = child.filter("k < 8").count()
    assert found.n_orphan_rows == 30_000 - known


def test_panel_index(spark):
    df = spark.createDataFrame([(-3,), (0,)], "m int")
    assert status(quality.panel_index(df, "p", "m")) == ["PASS"]
    assert status(quality.panel_index(df, "p", "m", max_allowed=-1)) == ["FAIL"]
    assert quality.panel_index(df.unionByName(spark.createDataFrame([(4,)], "m int")), "p", "m").first().n_bad == 1


def test_sentinel_scan(spark):
    df = spark.createDataFrame([(365243.0, 1, "x"), (365243.0, 2, "x"), (None, 365243, "x")], "DAYS_A double, DAYS_B int, DAYS_T string")
    found = rows(quality.sentinel_scan(df, "t").select("status", "column_name", "n_bad", "n_total"))
    assert found == [("WARN", "DAYS_A", 2, 3), ("WARN", "DAYS_B", 1, 3)]
    clean = quality.sentinel_scan(df.filter("DAYS_A IS NULL AND DAYS_B < 5"), "t").first()
    assert (clean.status, clean.column_name, clean.n_bad) == ("PASS", None, 0)
    assert quality.sentinel_scan(df.select("DAYS_T"), "t") is None


def test_rows_preserved(spark):
    a, b = spark.range(5), spark.range(7)
    assert status(quality.rows_preserved(spark.range(12), [a, b], "p")) == ["PASS"]
    assert quality.rows_preserved(spark.range(11), [a, b], "p").first().n_bad == 1


def test_ingestion_gate(spark):
    audit = spark.createDataFrame(
        [("a", "ingested", 5, 0, 5, True), ("b", "ingested", 5, 0, 6, False), ("c", "ingested", 5, 1, None, None), ("d", "skipped", 5, None, 9, None)],
        "table string, status string, n_rows bigint, n_corrupt bigint, expected_rows bigint, row_count_ok boolean",
    )
    assert {r.target: r.status for r in quality.ingestion_gate(audit).collect()} == {"a": "PASS", "b": "FAIL", "c": "FAIL"}


def test_raising(spark):
    warn = quality.note(spark, "WARN", "x", "t", "")
    quality.raise_on_fail(warn)
    with pytest.raises(quality.GateError):
        quality.raise_on_fail(warn, strict=True)
    with pytest.raises(quality.GateError, match="broken"):
        quality.raise_on_fail(quality.note(spark, "FAIL", "x", "t", "broken"))
    both = quality.union_findings([warn, quality.note(spark, "PASS", "x", "t", "")])
    assert rows(quality.status_counts(both)) == [("x", 1, 1, 0)]


# -- profiles ----------------------------------------------------------------------------


def test_profiles_agree(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", None), (2, None, None)], "i int, s string, n double")
    want = [("i", "int", 3, 0, 0.0, 2), ("n", "double", 3, 3, 1.0, 0), ("s", "string", 3, 1, 0.333333, 1)]
    assert rows(profiling.column_profile(df)) == want
    assert rows(profiling.column_profile(df, exact_distinct=True)) == want
    assert rows(profiling.null_counts(df)) == [("i", 3, 0), ("n", 0, 3), ("s", 2, 1)]


def test_describe_text_breaks_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "s string")
    assert rows(profiling.describe_text(df, "s")) == [("s", 4, 2, "a", 2)]


def test_value_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "s string")
    assert rows(profiling.value_counts(df, "s"), "n", "s") == [("b", 1, 1 / 3), ("a", 2, 2 / 3)]
    assert {r.s: r.share for r in profiling.value_counts(df, "s", keep_null=True).collect()} == {"a": 0.5, "b": 0.25, None: 0.25}


def test_set_differences(spark):
    a, b = spark.range(5), spark.range(2, 9).withColumnRenamed("id", "other")
    assert rows(sets.values_missing(a, b, "id", "other")) == [(0,), (1,)]
    text = spark.createDataFrame([("x",), ("y",), (None,)], "s string")
    assert rows(sets.values_outside(text, "s", ["x"])) == [("y",)]


def test_deduplicate_keeps_the_largest(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 9, "b"), (1, 9, "c"), (2, None, "d")], "k int, v int, t string")
    assert rows(sets.deduplicate(df, ["k"], "v", "t")) == [(1, 9, "c"), (2, None, "d")]
