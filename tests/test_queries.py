"""Every registered query on the smallest tables, against its SQL where there is one."""

import shutil

import duckdb
import pytest

import __spark_entry__ as entry
import check_queries
from catalogue import fixtures
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    return check_queries.connect(SMALL)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, duck, name):
    status, detail = check_queries.compare(spark, duck, SMALL, name)
    assert status in ("ok", "rows-only"), detail


def test_entry(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 76 and df.count() > 0


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_exposure_of_an_account_with_several_customers(spark, tmp_path):
    """Suppliers stand twice, in two nations, as in copies whose shifted keys meet."""
    shutil.copy(f"{SMALL}/lineitem.parquet", tmp_path / "lineitem.parquet")
    twice = "s_suppkey, s_name, (s_nationkey + i * (1 + s_suppkey % 3))::INT AS s_nationkey, s_acctbal - i * 37 AS s_acctbal"
    duckdb.sql(f"COPY (SELECT {twice} FROM '{SMALL}/supplier.parquet', range(2) t(i)) TO '{tmp_path}/supplier.parquet'")
    status, detail = check_queries.compare(spark, check_queries.connect(str(tmp_path)), str(tmp_path), "q_exposure")
    assert status == "ok", detail


def test_exposure_takes_both_balances_from_one_computation(spark, monkeypatch):
    """Sums come out of every computation a little different, as on executors that merge them in another order."""
    ticks = "CAST(reflect('java.lang.System', 'nanoTime') AS LONG) % 1000 * 1e-9"
    accounts = spark.range(60).selectExpr(
        "id AS account_id", "1 AS customer_id", "'CC' AS product_type", "-13 AS month_idx", "90 AS dpd", f"1000D + {ticks} AS balance", "500D AS credit_limit"
    )
    monkeypatch.setattr(fixtures, "panel", lambda spark, sf_dir: accounts)
    got = entry.queries()["q_exposure"](spark, SMALL).collect()
    assert len(got) == 60 and all(r["ccf"] == 0 and r["ccf_in_bounds"] for r in got)
