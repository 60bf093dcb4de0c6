import pytest
from pyspark.sql import functions as F

from cohortlake import config as cfg
from cohortlake.operators import cleaning, panel
from tests.conftest import rows

S = float(cfg.DAYS_SENTINEL)


@pytest.mark.parametrize("hits, n, want", [(5, 100, True), (4, 100, False), (5, 0, False), (0, 10, False), (1, -1, False)])
def test_indicator_threshold(hits, n, want):
    assert cleaning.needs_indicator(hits, n) is want


def test_indicator_names():
    assert cleaning.indicator_name("DAYS_EMPLOYED") == "is_not_employed"
    assert cleaning.indicator_name("DAYS_FIRST_DRAWING") == "never_drawn"
    assert cleaning.indicator_name("DAYS_LAST_DUE") == "days_last_due_is_missing"


def test_scrub_flags_before_blanking(spark):
    df = spark.createDataFrame([(S, S), (-5.0, 1.0), (None, 2.0)], "DAYS_EMPLOYED double, DAYS_B double")
    out, added = cleaning.scrub_sentinels(df, {"DAYS_EMPLOYED": 1, "DAYS_B": 1, "DAYS_GONE": 9}, 3)
    assert added == ["is_not_employed", "days_b_is_missing"]
    assert rows(out.select("DAYS_EMPLOYED", "is_not_employed")) == rows(
        spark.createDataFrame([(None, True), (-5.0, False), (None, None)], "a double, b boolean")
    )
    rare, added = cleaning.scrub_sentinels(df, {"DAYS_B": 1}, 1_000)
    assert added == [] and rare.filter("DAYS_B IS NULL").count() == 1


def test_narrowing_takes_day_doubles_only(spark):
    df = spark.createDataFrame([(1.0, 2.0, "x")], "DAYS_A double, AMT_B double, DAYS_T string")
    assert dict(cleaning.narrow_days_to_int(df).dtypes) == {"DAYS_A": "int", "AMT_B": "double", "DAYS_T": "string"}


def test_cap_keeps_null_and_flags(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)] + [(None,)], "AMT_INCOME_TOTAL double")
    out, caps = cleaning.cap_outliers(df, {"AMT_INCOME_TOTAL": 0.9}, exact=True)
    assert caps == {"AMT_INCOME_TOTAL": 90.0}
    got = out.agg(F.max("AMT_INCOME_TOTAL"), F.count("AMT_INCOME_TOTAL"), F.count_if("amt_income_total_was_capped")).first()
    assert tuple(got) == (90.0, 101, 10)
    bare, _ = cleaning.cap_outliers(df, {"AMT_INCOME_TOTAL": 0.9}, exact=True, null_becomes_cap=True)
    assert bare.filter("AMT_INCOME_TOTAL IS NULL").count() == 0
    assert cleaning.cap_outliers(df, {"OTHER": 0.9})[1] == {}
    assert cleaning.cap_outliers(df)[1]["AMT_INCOME_TOTAL"] >= 99


def test_status_panel(spark):
    df = spark.createDataFrame([(1, 0, " c"), (1, -1, "4"), (1, -2, "X"), (1, -3, None), (1, -4, "1")], "id int, MONTHS_BALANCE int, STATUS string")
    out = cleaning.decode_status_panel(df).select(
        "months_balance_aligned", "status_bucket", "is_closed", "is_status_unknown", "is_delinquent", "is_90_plus"
    )
    assert {r[0]: tuple(r)[1:] for r in out.collect()} == {
        -1: (0, True, False, False, False),
        -2: (4, False, False, True, True),
        -3: (None, False, True, None, None),
        -4: (None, None, None, None, None),
        -5: (1, False, False, True, False),
    }


def test_payment_derivations(spark):
    df = spark.createDataFrame(
        [(-10, -8, 100.0, 98.9), (-10, -10, 100.0, 99.0), (-10, None, 100.0, None)],
        "days_instalment int, days_entry_payment int, amt_instalment double, amt_payment double",
    )
    got = cleaning.derive_payments(df).select("days_late", "is_late", "is_short_payment").collect()
    assert [tuple(r) for r in got] == [(2, True, True), (0, False, False), (None, None, None)]


def test_fills(spark):
    df = spark.createDataFrame([(1.0, 9.0), (None, 8.0), (3.0, -1.0)], "a double, b double")
    assert [r.a for r in cleaning.fill_with_mean(df, ["a"]).collect()] == [1.0, 2.0, 3.0]
    assert [r.a for r in cleaning.fill_from(df, "a", "b").collect()] == [1.0, 8.0, 3.0]
    assert [r.a for r in cleaning.fill_with_zero(df, ["a"]).collect()] == [1.0, 0.0, 3.0]
    assert [r.b for r in cleaning.negatives_to_max(df, "b").collect()] == [9.0, 8.0, 9.0]
    assert [tuple(r) for r in cleaning.null_mask(df).collect()] == [(False, False), (True, False), (False, False)]


# -- panels -------------------------------------------------------------------------------


def test_limit_measures(spark):
    df = spark.createDataFrame(
        [(50.0, 100.0), (150.0, 100.0), (10.0, 0.0), (10.0, None), (None, 100.0), (5.0, -1.0)], "balance double, credit_limit double"
    )
    got = panel.limit_measures(df).select("has_valid_limit", "utilisation", "is_overlimit", "overlimit_amount").collect()
    assert [tuple(r) for r in got] == [
        (True, 0.5, False, 0.0),
        (True, 1.5, True, 50.0),
        (False, None, None, 0.0),
        (None, None, None, 0.0),
        (True, None, None, 0.0),
        (False, None, None, 0.0),
    ]


def test_pooled_panel_has_one_column_order(spark):
    card = spark.createDataFrame([(1, 2, -1, 5.0, 10.0, 0, 0, "Active")],
        "SK_ID_PREV long, SK_ID_CURR long, MONTHS_BALANCE int, AMT_BALANCE double, AMT_CREDIT_LIMIT_ACTUAL double, "
        "SK_DPD int, SK_DPD_DEF int, NAME_CONTRACT_STATUS string")
    pos = spark.createDataFrame([(1, 2, -1, 12.0, 0, 0, "Active")],
        "SK_ID_PREV long, SK_ID_CURR long, MONTHS_BALANCE int, CNT_INSTALMENT double, SK_DPD int, SK_DPD_DEF int, "
        "NAME_CONTRACT_STATUS string")
    pooled = panel.pool_panels(card, pos)
    assert tuple(pooled.columns) == panel.POOLED_COLUMNS and len(pooled.columns) == 30
    got = {r["product_type"]: r for r in pooled.collect()}
    assert got["CC"]["utilisation"] == 0.5 and got["CC"]["CNT_INSTALMENT"] is None
    assert got["POS"]["utilisation"] is None and got["POS"]["overlimit_amount"] is None
    assert got["POS"]["CNT_INSTALMENT"] == 12.0


def test_trailing_windows_against_brute_force(spark):
    data = [(a, 1, "CC", m, (a * 7 - m) % 40, float(m * m) if m % 3 else None) for a in (1, 2) for m in (-9, -8, -6, -5, -1)]
    data += [(1, 1, "CC", -5, 99, 4.0)] * 3  # repeated rows of one month
    df = spark.createDataFrame(data, "account_id int, customer_id int, product_type string, month_idx int, dpd int, balance double")
    got = {(r.account_id, r.month_idx): r for r in panel.trailing_all_months(df, 3).collect()}
    for (a, m), r in got.items():
        inside = [x for x in data if x[0] == a and m - 3 < x[3] <= m]
        balances = [x[5] for x in inside if x[5] is not None]
        assert r.n_months_3m == len(inside) and r.max_dpd_3m == max(x[4] for x in inside)
        assert r.bal_avg_3m == (pytest.approx(sum(balances) / len(balances)) if balances else None)
