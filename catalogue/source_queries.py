"""Round trips through files: typed CSV scan, inference, profile, append, clustered layout."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogue import fixtures as fx
from catalogue.registry import query
from cohortlake.sources import csv_source, tables
from cohortlake.sources import schema as sch
from cohortlake.sources.workspace import scratch_path

ORDERS = (
    "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string"
)


def _orders_csv(spark, sf_dir, label: str) -> str:
    path = scratch_path(spark, label)
    rows = fx.table(spark, sf_dir, "orders")
    # Every 50th priority is blanked so that NULL makes the trip too.
    blanked = F.when(F.col("o_orderkey") % 50 != 0, F.col("o_orderpriority"))
    rows.withColumn("o_orderpriority", blanked).write.option("header", "true").csv(path)
    return path


@query(
    "q_csv_roundtrip",
    """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN o_orderkey % 50 <> 0 THEN o_orderpriority END AS o_orderpriority,
       CAST(NULL AS VARCHAR) AS _corrupt_record FROM orders""",
)
def csv_roundtrip(spark, sf_dir):
    return csv_source.scan_csv(spark, _orders_csv(spark, sf_dir, "orders-csv"), T.StructType.fromDDL(ORDERS))


@query(
    "q_csv_corrupt",
    """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE l_shipdate IS NOT NULL AND l_returnflag = 'R') AS n_corrupt FROM lineitem""",
)
def csv_corrupt(spark, sf_dir):
    """Text in a numeric column: the row stays and its source text is kept."""
    path, stored = scratch_path(spark, "corrupt-csv"), scratch_path(spark, "corrupt-parquet")
    qty = F.when(F.col("l_returnflag") == "R", "many").otherwise(F.col("l_quantity").cast("string"))
    fx.table(spark, sf_dir, "lineitem").select("l_orderkey", qty.alias("l_quantity")).write.option("header", "true").csv(path)
    schema = T.StructType.fromDDL("l_orderkey long, l_quantity double")
    csv_source.scan_csv(spark, path, schema).write.parquet(stored)
    return spark.read.parquet(stored).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(sch.CORRUPT_RECORD).alias("n_corrupt")
    )


@query(
    "q_schema_infer",
    """
SELECT * FROM (VALUES (0, 'o_orderkey', 'long'), (1, 'o_custkey', 'long'), (2, 'o_orderstatus', 'string'),
  (3, 'o_totalprice', 'double'), (4, 'o_orderdate', 'timestamp'), (5, 'o_orderpriority', 'string'))
  AS t(position, "column", inferred_type),
  (SELECT count(*) AS n_rows, count(*) FILTER (WHERE o_orderkey % 50 = 0) AS nulls FROM orders) c,
  LATERAL (SELECT CASE WHEN position = 5 THEN nulls ELSE 0 END AS n_null,
                  CASE WHEN position = 5 THEN round(nulls / n_rows, 6) ELSE 0.0 END AS null_rate)
""".replace("SELECT * FROM", 'SELECT position, "column", inferred_type, false AS is_widened, n_rows, n_null, null_rate FROM', 1),
)
def schema_infer(spark, sf_dir):
    return sch.scan_types(csv_source.scan_text(spark, _orders_csv(spark, sf_dir, "infer-csv")))


# The digest is a Spark hash that other engines cannot recompute: rows only.
@query("q_profile_table")
def profile_table(spark, sf_dir):
    path = _orders_csv(spark, sf_dir, "profile-csv")
    files = csv_source.list_files(spark, path, "*.csv")
    return sch.profile_table(spark, csv_source.scan_text(spark, path), "orders", 15_000, files)


@query(
    "q_profile_upsert",
    """
SELECT 'events' AS "table", count(*) AS n_rows, 1 AS run FROM events
UNION ALL SELECT 'orders', count(*), 2 FROM orders UNION ALL SELECT 'nation', count(*), 2 FROM nation""",
)
def profile_upsert(spark, sf_dir):
    def counted(names, run):
        parts = [
            fx.table(spark, sf_dir, n).agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(n).alias("table"), "n_rows", F.lit(run).alias("run")
            )
            for n in names
        ]
        return parts[0].unionByName(parts[1])

    return sch.upsert_profiles(counted(["events", "orders"], 1), counted(["orders", "nation"], 2))


@query(
    "q_audit_append",
    """
SELECT 'first' AS run, 'orders' AS "table", count(*) AS n_rows, CAST(NULL AS BIGINT) AS n_null FROM orders
UNION ALL SELECT 'second', 'orders', count(*), count(*) - count(o_orderpriority) FROM orders""",
)
def audit_append(spark, sf_dir):
    """Two appends; the second brings a column the first did not have."""
    path = scratch_path(spark, "audit")
    orders = fx.table(spark, sf_dir, "orders")
    counted = orders.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("o_orderpriority").isNull()).alias("n_null")
    )
    row = counted.select(F.lit("orders").alias("table"), "n_rows", "n_null")
    tables.append_files(row.select(F.lit("first").alias("run"), "table", "n_rows"), path)
    tables.append_files(row.select(F.lit("second").alias("run"), "table", "n_rows", "n_null"), path)
    return tables.read_merged(spark, path).select("run", "table", "n_rows", "n_null")


@query("q_clustered_layout", "SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice FROM lineitem")
def clustered_layout(spark, sf_dir):
    path = scratch_path(spark, "clustered")
    rows = fx.table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    tables.clustered(rows, ["l_suppkey"]).write.parquet(path)
    return spark.read.parquet(path)


# Lineage columns hold load time and file name, which no oracle can know: rows only.
@query("q_lineage")
def lineage(spark, sf_dir):
    return csv_source.add_lineage(fx.table(spark, sf_dir, "nation"))


@query("q_columns_subset", "SELECT o_orderkey, CASE WHEN o_orderkey % 50 <> 0 THEN o_orderpriority END AS o_orderpriority "
       "FROM orders WHERE o_orderkey % 50 <> 0")
def columns_subset(spark, sf_dir):
    """Two columns of a CSV; rows without the required one are trailer junk."""
    path = _orders_csv(spark, sf_dir, "subset-csv")
    text = csv_source.scan_columns(spark, path, ["o_orderkey", "o_orderpriority"], required="o_orderpriority")
    return text.withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


# File names and sizes differ per run: rows only.
@query("q_file_listing")
def file_listing(spark, sf_dir):
    return csv_source.list_files(spark, sf_dir, "*.parquet")
