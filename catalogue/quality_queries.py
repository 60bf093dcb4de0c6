"""Data-quality gates, profiles and set differences on the star-schema tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import fixtures as fx
from catalogue.registry import big, query, r, rounded
from cohortlake import config as cfg
from cohortlake.operators import profiling, quality, sets

FINDING = ["status", "check", "target", "n_bad", "n_total", "rate"]

# Row counts of the generated tables do not all scale with one factor; these have a fixed size.
EXPECTED_ROWS = {"region": 5, "nation": 25, "supplier": None, "lineitem": 60_000, "archive": 1}


@query(
    "q_row_counts",
    f"""
WITH counted AS (
  SELECT 'region' AS target, count(*) AS n, 5 AS expected FROM region UNION ALL
  SELECT 'nation', count(*), 25 FROM nation UNION ALL
  SELECT 'supplier', count(*), NULL FROM supplier UNION ALL
  SELECT 'lineitem', count(*), 60000 FROM lineitem)
SELECT CASE WHEN expected IS NULL OR n = expected THEN 'PASS' ELSE 'FAIL' END AS status, 'row-count' AS "check",
       target, {big('coalesce(abs(n - expected), 0)')} AS n_bad, n AS n_total, CAST(NULL AS DOUBLE) AS rate
FROM counted
UNION ALL SELECT 'WARN', 'row-count', 'archive', NULL, NULL, NULL""",
)
def row_counts(spark, sf_dir):
    tables = {name: fx.table(spark, sf_dir, name) for name in EXPECTED_ROWS if name != "archive"}
    return quality.row_counts(spark, tables, EXPECTED_ROWS).select(*FINDING)


@query(
    "q_key_uniqueness",
    f"""
WITH counted AS (
  SELECT 'orders(o_orderkey)' AS target, count(*) AS n, count(DISTINCT o_orderkey) AS d FROM orders UNION ALL
  SELECT 'lineitem(l_orderkey, l_linenumber)', count(*),
         (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) FROM lineitem)
SELECT CASE WHEN n = d THEN 'PASS' ELSE 'FAIL' END AS status, 'key-uniqueness' AS "check", target,
       {big('n - d')} AS n_bad, n AS n_total, CAST(NULL AS DOUBLE) AS rate FROM counted
UNION ALL SELECT 'PASS', 'key-uniqueness', 'events', NULL, NULL, NULL""",
)
def key_uniqueness(spark, sf_dir):
    checks = [
        quality.key_uniqueness(fx.table(spark, sf_dir, "orders"), "orders", ["o_orderkey"]),
        quality.key_uniqueness(fx.table(spark, sf_dir, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"]),
        quality.key_uniqueness(fx.table(spark, sf_dir, "events"), "events", []),
    ]
    return quality.union_findings(checks).select(*FINDING)


def _edge_sql(target: str, child: str, column: str, parent: str, partial: bool) -> str:
    bad = "CASE WHEN orphan_ids / n_ids > 0.25 THEN 'FAIL' ELSE 'WARN' END" if partial else "'FAIL'"
    return f"""
SELECT CASE WHEN orphan_rows = 0 THEN 'PASS' ELSE {bad} END AS status, 'referential' AS "check",
       '{target}' AS target, orphan_ids AS n_bad, n_ids AS n_total, round(orphan_ids / n_ids, 4) AS rate,
       orphan_rows AS n_orphan_rows, n_rows AS n_child_rows, round(orphan_rows / n_rows, 4) AS orphan_rate_rows
FROM (SELECT count(*) AS n_rows, count(DISTINCT {column}) AS n_ids,
             count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.k = c.{column})) AS orphan_rows,
             count(DISTINCT {column}) FILTER (
               WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.k = c.{column})) AS orphan_ids
      FROM {child} c)"""


EDGES = [
    ("lineitem.l_orderkey -> orders.o_orderkey", "lineitem", "l_orderkey", "all_orders", False),
    ("lineitem.l_orderkey -> later_orders.o_orderkey", "lineitem", "l_orderkey", "later_orders", True),
    ("documents.doc_id -> labels.doc_id", "documents", "doc_id", "labelled", True),
]


@query(
    "q_referential",
    """WITH all_orders AS (SELECT o_orderkey AS k FROM orders),
later_orders AS (SELECT o_orderkey AS k FROM orders WHERE o_orderpriority <> '1-URGENT'),
labelled AS (SELECT doc_id AS k FROM labels)"""
    + " UNION ALL ".join(_edge_sql(*e) for e in EDGES),
)
def referential(spark, sf_dir):
    orders, lineitem = fx.table(spark, sf_dir, "orders"), fx.table(spark, sf_dir, "lineitem")
    later = orders.filter(F.col("o_orderpriority") != "1-URGENT")
    docs, labels = fx.table(spark, sf_dir, "documents"), fx.table(spark, sf_dir, "labels")
    edges = [
        (lineitem, orders, cfg.Reference("lineitem", "l_orderkey", "orders", "o_orderkey")),
        (lineitem, later, cfg.Reference("lineitem", "l_orderkey", "later_orders", "o_orderkey", True)),
        (docs, labels, cfg.Reference("documents", "doc_id", "labels", "doc_id", True)),
    ]
    extra = ["n_orphan_rows", "n_child_rows", "orphan_rate_rows"]
    return quality.union_findings([quality.referential(*e) for e in edges]).select(*FINDING, *extra)


@query(
    "q_panel_index",
    fx.with_views(
        """
SELECT CASE WHEN above > 0 THEN 'FAIL' ELSE 'PASS' END AS status, 'panel-index' AS "check",
       target || '.month_idx' AS target, above AS n_bad, n AS n_total, CAST(NULL AS DOUBLE) AS rate,
       'range [' || lo || ', ' || hi || ']' AS detail
FROM (SELECT 'panel' AS target, count(*) FILTER (WHERE month_idx > 0) AS above, count(*) AS n,
             min(month_idx) AS lo, max(month_idx) AS hi FROM panel
      UNION ALL
      SELECT 'tradelines', count(*) FILTER (WHERE month_idx > 0), count(*), min(month_idx), max(month_idx)
      FROM tradelines)""",
        fx.PANEL_SQL,
        fx.TRADELINES_SQL,
    ),
)
def panel_index(spark, sf_dir):
    checks = [
        quality.panel_index(fx.panel(spark, sf_dir), "panel", "month_idx"),
        quality.panel_index(fx.tradelines(spark, sf_dir), "tradelines", "month_idx"),
    ]
    return quality.union_findings(checks).select(*FINDING, "detail")


@query(
    "q_sentinel_scan",
    """
WITH hits AS (
  SELECT 'part' AS target, 'p_size' AS column_name, count(*) FILTER (WHERE p_size = 24) AS n, count(*) AS n_total FROM part
  UNION ALL
  SELECT 'part', 'p_partkey', count(*) FILTER (WHERE p_partkey = 24), count(*) FROM part)
SELECT 'WARN' AS status, 'days-sentinel' AS "check", target, column_name, n AS n_bad, n_total,
       round(n / n_total, 6) AS rate FROM hits WHERE n > 0
UNION ALL
SELECT 'PASS', 'days-sentinel', 'supplier', NULL, 0, count(*), 0.0 FROM supplier
WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_acctbal = 365243)""",
)
def sentinel_scan(spark, sf_dir):
    scans = [
        quality.sentinel_scan(fx.table(spark, sf_dir, "part"), "part", ["p_size", "p_partkey"], sentinel=24),
        quality.sentinel_scan(fx.table(spark, sf_dir, "supplier"), "supplier", ["s_acctbal"]),
    ]
    return quality.union_findings(scans).select("column_name", *FINDING)


@query(
    "q_rows_preserved",
    fx.with_views(
        """
SELECT CASE WHEN a.n = b.n THEN 'PASS' ELSE 'FAIL' END AS status, 'rows-preserved' AS "check",
       'payments' AS target, abs(a.n - b.n) AS n_bad, a.n AS n_total, CAST(NULL AS DOUBLE) AS rate
FROM (SELECT count(*) AS n FROM payments) a, (SELECT count(*) AS n FROM lineitem) b
UNION ALL
SELECT CASE WHEN a.n = b.n + c.n THEN 'PASS' ELSE 'FAIL' END, 'rows-preserved', 'panel_pooled',
       abs(a.n - b.n - c.n), a.n, NULL
FROM (SELECT count(*) AS n FROM panel) a, (SELECT count(*) AS n FROM panel WHERE product_type = 'CC') b,
     (SELECT count(*) AS n FROM panel WHERE product_type = 'POS') c""",
        fx.PANEL_SQL,
        fx.PAYMENTS_SQL,
    ),
)
def rows_preserved(spark, sf_dir):
    panel = fx.panel(spark, sf_dir)
    card, pos = (panel.filter(F.col("product_type") == p) for p in ("CC", "POS"))
    checks = [
        quality.rows_preserved(fx.payments(spark, sf_dir), [fx.table(spark, sf_dir, "lineitem")], "payments"),
        quality.rows_preserved(panel, [card, pos], "panel_pooled"),
    ]
    return quality.union_findings(checks).select(*FINDING)


@query(
    "q_status_counts",
    """
SELECT 'referential' AS "check", CAST(1 AS BIGINT) AS n_pass, CAST(0 AS BIGINT) AS n_warn, CAST(0 AS BIGINT) AS n_fail
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey))
UNION ALL
SELECT 'key-uniqueness', count(*) FILTER (WHERE n = d), 0, count(*) FILTER (WHERE n <> d) FROM (
  SELECT count(*) AS n, count(DISTINCT o_orderkey) AS d FROM orders UNION ALL
  SELECT count(*), count(DISTINCT l_orderkey) FROM lineitem)""",
)
def status_counts(spark, sf_dir):
    orders, lineitem = fx.table(spark, sf_dir, "orders"), fx.table(spark, sf_dir, "lineitem")
    findings = quality.union_findings(
        [
            quality.key_uniqueness(orders, "orders", ["o_orderkey"]),
            quality.key_uniqueness(lineitem, "lineitem", ["l_orderkey"]),
            quality.referential(
                lineitem, orders, cfg.Reference("lineitem", "l_orderkey", "orders", "o_orderkey")
            ).drop("n_orphan_rows", "n_child_rows", "orphan_rate_rows"),
        ]
    )
    return quality.status_counts(findings)


def _profile_sql(table: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS data_type, count(*) AS n_rows, count(*) - count({c}) AS n_null, "
        f"round((count(*) - count({c})) / count(*), 6) AS null_rate, count(DISTINCT {c}) AS n_distinct FROM {table}"
        for c, t in columns.items()
    )


@query(
    "q_column_profile",
    _profile_sql(
        "customer",
        {
            "c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double",
            "c_mktsegment": "string",
        },
    ),
)
def column_profile(spark, sf_dir):
    return profiling.column_profile(fx.table(spark, sf_dir, "customer"), exact_distinct=True)


@query(
    "q_column_profile_nulls",
    fx.with_views(
        _profile_sql(
            "docs_labeled",
            {"doc_id": "bigint", "lang": "string", "source": "string", "n_chars": "bigint", "quality": "int", "toxic": "int"},
        ),
        fx.DOCS_SQL,
    ),
)
def column_profile_nulls(spark, sf_dir):
    return profiling.column_profile(fx.docs_labeled(spark, sf_dir), exact_distinct=True)


# The sketch variant: distinct counts are estimates, so only rows are checked.
@query("q_column_profile_approx")
def column_profile_approx(spark, sf_dir):
    return profiling.column_profile(fx.table(spark, sf_dir, "lineitem"))


@query(
    "q_null_counts",
    fx.with_views(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count({c}) AS n_valid, count(*) - count({c}) AS n_null FROM payments"
            for c in ("days_entry_payment", "days_late", "is_late", "amt_payment")
        ),
        fx.PAYMENTS_SQL,
    ),
)
def null_counts(spark, sf_dir):
    wanted = fx.payments(spark, sf_dir).select("days_entry_payment", "days_late", "is_late", "amt_payment")
    return profiling.null_counts(wanted)


def _describe_sql(table: str, columns: list[str], percentiles: dict[str, float]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, {r(f'avg({c})')} AS mean, {r(f'stddev_samp({c})')} AS std, "
        f"{r(f'CAST(min({c}) AS DOUBLE)')} AS min, "
        + ", ".join(f"{r(f'quantile_cont({c}, {p})')} AS {n}" for n, p in percentiles.items())
        + f", {r(f'CAST(max({c}) AS DOUBLE)')} AS max FROM {table}"
        for c in columns
    )


@query(
    "q_describe",
    _describe_sql("events", ["value", "user_id"], {"p25": 0.25, "p50": 0.5, "p75": 0.75}),
)
def describe(spark, sf_dir):
    return rounded(profiling.describe(fx.table(spark, sf_dir, "events"), ["value", "user_id"]))


@query(
    "q_describe_p95",
    _describe_sql("lineitem", ["l_discount", "l_extendedprice"], {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}),
)
def describe_p95(spark, sf_dir):
    lineitem = fx.table(spark, sf_dir, "lineitem")
    return rounded(profiling.describe(lineitem, ["l_discount", "l_extendedprice"], (0.25, 0.5, 0.75, 0.95)))


@query(
    "q_describe_text",
    """
WITH v AS (SELECT o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 1)
SELECT 'o_orderpriority' AS "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique",
       (SELECT value FROM v ORDER BY n DESC, value LIMIT 1) AS top, max(n) AS freq FROM v""",
)
def describe_text(spark, sf_dir):
    return profiling.describe_text(fx.table(spark, sf_dir, "orders"), "o_orderpriority")


@query(
    "q_value_counts",
    """
SELECT o_orderstatus, count(*) AS n, round(count(*) / (SELECT count(o_orderstatus) FROM orders), 6) AS share
FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY 1""",
)
def value_counts(spark, sf_dir):
    return rounded(profiling.value_counts(fx.table(spark, sf_dir, "orders"), "o_orderstatus"), 6)


@query(
    "q_value_counts_null",
    fx.with_views(
        """
SELECT quality, count(*) AS n, round(count(*) / (SELECT count(*) FROM docs_labeled), 6) AS share
FROM docs_labeled GROUP BY 1""",
        fx.DOCS_SQL,
    ),
)
def value_counts_null(spark, sf_dir):
    return rounded(profiling.value_counts(fx.docs_labeled(spark, sf_dir), "quality", keep_null=True), 6)


@query("q_distinct_values", fx.with_views("SELECT DISTINCT emp_length FROM loans", fx.LOANS_SQL))
def distinct_values(spark, sf_dir):
    return profiling.distinct_values(fx.loans(spark, sf_dir), "emp_length")


@query(
    "q_set_diff",
    """
SELECT c_custkey FROM customer
EXCEPT SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1997""",
)
def set_diff(spark, sf_dir):
    start, end = F.lit("1997-01-01").cast("timestamp_ntz"), F.lit("1998-01-01").cast("timestamp_ntz")
    year = fx.table(spark, sf_dir, "orders").filter((F.col("o_orderdate") >= start) & (F.col("o_orderdate") < end))
    return sets.values_missing(fx.table(spark, sf_dir, "customer"), year, "c_custkey", "o_custkey")


@query(
    "q_unmapped_status",
    fx.with_views(
        "SELECT DISTINCT loan_status FROM loans WHERE loan_status NOT IN "
        "('Charged Off','Default','Fully Paid','Late (31-120 days)','Current')",
        fx.LOANS_SQL,
    ),
)
def unmapped_status(spark, sf_dir):
    from cohortlake.operators import loans

    return loans.unmapped_statuses(fx.loans(spark, sf_dir))


@query(
    "q_deduplicate",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_extendedprice DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM lineitem)
WHERE rn = 1""",
)
def deduplicate(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    return sets.deduplicate(rows, ["l_orderkey", "l_linenumber"], "l_extendedprice", "l_partkey", "l_suppkey")


@query(
    "q_data_quality_report",
    fx.with_views(
        " UNION ALL ".join(
            f"SELECT count(*) AS n_rows, '{c}' AS \"column\", count(*) - count({c}) AS n_null, "
            f"CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max, "
            f"{r(f'avg(CASE WHEN {c} IS NULL THEN late END)')} AS target_if_null, "
            f"{r(f'avg(CASE WHEN {c} IS NOT NULL THEN late END)')} AS target_if_present FROM p"
            for c in ("account_id", "days_instalment", "days_entry_payment")
        ),
        fx.PAYMENTS_SQL,
        "p AS (SELECT *, CASE WHEN is_short_payment THEN 1 ELSE 0 END AS late FROM payments)",
    ),
)
def data_quality_report(spark, sf_dir):
    rows = fx.payments(spark, sf_dir).select(
        "account_id", "days_instalment", "days_entry_payment", F.col("is_short_payment").cast("int").alias("late")
    )
    return rounded(profiling.data_quality_report(rows, "late"))
