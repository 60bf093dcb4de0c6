import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake import config as cfg
from cohortlake.operators import quality
from cohortlake.plans import clean, gold, ingest, verify
from cohortlake.sources import csv_source, tables
from cohortlake.sources import schema as sch
from cohortlake.sources.workspace import materialise, shared_dir
from tests.conftest import rows

# -- schema policy ----------------------------------------------------------------------


@pytest.mark.parametrize(
    "column, inferred, want",
    [
        ("SK_ID_CURR", "double", ("long", "exact-override")),
        ("CNT_CHILDREN", "long", ("integer", "exact-override")),
        ("CNT_FAM_MEMBERS", "long", ("double", "prefix-override:CNT_")),
        ("NUM_INSTALMENT_NUMBER", "long", ("integer", "exact-override")),
        ("NUM_INSTALMENT_VERSION", "long", ("double", "prefix-override:NUM_INSTALMENT_")),
        ("FLAG_OWN_CAR", "string", ("string", "inferred")),
        ("FLAG_DOCUMENT_2", "long", ("long", "inferred")),
    ],
)
def test_type_precedence(column, inferred, want):
    assert sch.resolve_type(column, inferred) == want


@pytest.mark.parametrize(
    "name, want", [("", "col_3"), ("  ", "col_3"), (None, "col_3"), ("...", "col_3"), ("a b", "a_b"), ("a/b.c", "a_b_c"), ("_row_hash", "_row_hash"), ("x=1;y", "x_1_y")]
)
def test_safe_names(name, want):
    assert sch.safe_name(name, 3) == want


def test_field_metadata():
    f = sch.build_field("AMT BALANCE", "long", 2)
    assert (f.name, f.dataType, f.metadata["type_source"], f.metadata["source_column"]) == (
        "AMT_BALANCE", T.DoubleType(), "prefix-override:AMT_", "AMT BALANCE",
    )
    assert sch.build_field("", "long", 0).metadata["renamed_reason"] == "empty header"
    assert "source_column" not in sch.build_field("x", "string").metadata


def test_schema_round_trip(tmp_path):
    schema = sch.build_schema({"SK_ID_CURR": "long", "": "string", "when": "date"})
    sch.write_schema(schema, "t", tmp_path)
    back = sch.read_schema("t", tmp_path)
    assert back == schema and sch.schema_columns(back) == ["SK_ID_CURR", "col_1", "when"]
    assert sch.fingerprint(back) == sch.fingerprint(schema) and len(sch.fingerprint(back)) == 16
    assert sch.fingerprint(sch.build_schema({"SK_ID_CURR": "long"})) != sch.fingerprint(schema)
    with pytest.raises(FileNotFoundError, match="infer_schema"):
        sch.read_schema("missing", tmp_path)


def test_published_schemas_follow_the_policy(spark):
    for table in sch.PUBLISHED_SCHEMAS:
        for f in sch.published_schema(table).fields:
            wanted, reason = sch.resolve_type(f.name, "x")
            assert reason == "inferred" or sch._TYPES[wanted] == f.dataType, (table, f.name)
    assert len(sch.published_schema("credit_card_balance").fields) == 23


def test_inference_looks_at_every_row(spark):
    n = 5_000
    text = spark.range(n).select(
        F.col("id").cast("string").alias("whole"),
        F.when(F.col("id") == n - 1, "XNA").otherwise(F.col("id").cast("string")).alias("widened"),
        F.when(F.col("id") % 2 == 0, "1.5").otherwise("2").alias("mixed"),
        F.when(F.col("id") % 2 == 0, "true").otherwise("False").alias("flag"),
        F.lit("2020-01-31").alias("day"),
        F.lit("2020-01-31 10:00:00").alias("moment"),
        F.lit(None).cast("string").alias("nothing"),
        F.when(F.col("id") > 9, "007").alias("padded"),
        F.lit("2020").alias("year"),
    )
    scanned = sch.scan_types(text).collect()
    assert [r.column for r in scanned if r.is_widened] == ["widened"]
    got = {r.column: (r.inferred_type, r.n_null) for r in scanned}
    assert got == {
        "whole": ("long", 0), "widened": ("string", 0), "mixed": ("double", 0), "flag": ("boolean", 0), "day": ("date", 0),
        "moment": ("timestamp", 0), "nothing": ("string", n), "padded": ("long", 10), "year": ("long", 0),
    }


def test_profile_digest_ignores_order_and_layout(spark):
    text = spark.range(200).select(F.col("id").cast("string").alias("AMT_X"))
    one = sch.profile_table(spark, text, "t", 200).first()
    other = sch.profile_table(spark, text.orderBy(F.desc("AMT_X")).repartition(5), "t", 199).first()
    assert one.content_digest == other.content_digest
    assert (one.inferred_type, one.final_type, one.is_retyped) == ("long", "double", True)
    assert (one.row_count_matches, other.row_count_matches) == (True, False)
    changed = text.withColumn("AMT_X", F.when(F.col("AMT_X") == "7", "8").otherwise(F.col("AMT_X")))
    assert sch.profile_table(spark, changed, "t").first().content_digest != one.content_digest


# -- files -------------------------------------------------------------------------------


def test_csv_corner_cases(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b,c\n1,"x, ""y""",\nbad,z,2.5\n3,,4\n', encoding="utf-8")
    df = csv_source.scan_csv(spark, str(path), T.StructType.fromDDL("a int, b string, c double"))
    stored = materialise(df, "csv-corner")
    got = {tuple(r) for r in stored.collect()}
    assert (1, 'x, "y"', None, None) in got and (3, None, 4.0, None) in got
    broken = stored.filter(F.col("_corrupt_record").isNotNull()).first()
    assert broken.a is None and broken.c == 2.5 and broken["_corrupt_record"] == "bad,z,2.5"


def test_dictionary_options(spark, tmp_path):
    path = tmp_path / "d.csv"
    path.write_bytes(",Table,Row,Description,Special\n1,t,r,\"café,\nnext line\",\n".encode("iso-8859-1"))
    spec = cfg.TABLES["columns_description"]
    df = csv_source.scan_csv(spark, str(path), sch.published_schema(spec.name), csv_source.read_options(spec))
    assert df.first().Description == "café,\nnext line"


def test_columns_and_trailer(spark, tmp_path):
    import gzip

    path = tmp_path / "l.csv.gz"
    with gzip.open(path, "wt") as out:
        out.write("id,x,y\n1,a,b\n2,c,d\n,total,\n")
    assert csv_source.header(spark, str(path)) == ["id", "x", "y"]
    df = csv_source.scan_columns(spark, str(path), ["id", "x"], required="id", partitions=3)
    assert rows(df) == [("1", "a"), ("2", "c")] and df.rdd.getNumPartitions() == 3


def test_file_inventory(spark, tmp_path):
    (tmp_path / "bureau.csv").write_text("x" * 10)
    (tmp_path / "stray.csv").write_text("y")
    found = {r["name"]: (r["n_bytes"], r["state"]) for r in csv_source.file_inventory(csv_source.list_files(spark, str(tmp_path))).collect()}
    assert found["bureau.csv"] == (10, "present") and found["stray.csv"] == (1, "unexpected")
    assert found["application_train.csv"][1] == "missing" and len(found) == 10


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


# -- tables -------------------------------------------------------------------------------


@pytest.fixture
def database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS sinks")
    yield "sinks"
    spark.sql("DROP DATABASE sinks CASCADE")


def test_write_modes_and_comments(spark, database):
    name = f"{database}.t"
    assert tables.write_table(spark.range(3), name, comment="it's 3 rows")["n_rows"] == 3
    assert tables.write_table(spark.range(9), name, tables.SKIP_EXISTING) == {
        "table": name, "status": "skipped", "n_rows": 3, "duration_sec": 0.0,
    }
    tables.write_table(spark.range(4).withColumn("more", F.lit(1)), name)
    assert spark.table(name).columns == ["id", "more"] and spark.table(name).count() == 4
    tables.comment_on(spark, name, "it's 4 rows")
    assert rows(tables.list_tables(spark, database)) == [("t", "it's 4 rows")]
    with pytest.raises(ValueError):
        tables.write_table(spark.range(1), name, "replace")


def test_audit_takes_new_columns(spark, database):
    name = f"{database}.audit"
    tables.append_audit(spark, [{"table": "a", "n": 1}], "table string, n long", name)
    tables.append_audit(spark, [{"n": 2, "table": "b", "extra": "x"}], "table string, extra string, n long", name)
    tables.append_audit(spark, [{"table": "c", "n": 3}], "table string, n long", name)
    got = spark.table(name)
    assert rows(got.select("table", "n", "extra"), "n") == [("a", 1, None), ("b", 2, "x"), ("c", 3, None)]
    assert got.filter("run_at IS NULL").count() == 0


def test_clustering_splits_a_hot_key(spark):
    df = spark.range(9_000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 50).alias("k"), "id")
    laid = tables.clustered(df, ["k"], partitions=6)
    sizes = [r["count"] for r in laid.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 9_000 and max(sizes) < 3_000
    per_key = laid.select("k", F.spark_partition_id().alias("p")).distinct().groupBy("k").count()
    assert per_key.filter("k = 5").first()["count"] > 1
    assert per_key.agg(F.sum("count")).first()[0] <= 50 + 2 * 6


# -- the whole way from CSV to clean tables ---------------------------------------------------

N_CUSTOMERS = 20


def _write(folder, name, header, lines):
    (folder / name).write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")


def write_extract(folder, duplicate_status=False, orphan_accounts=0, positive_month=False):
    """A 20-customer extract with a sentinel, an orphan customer and missing values."""
    customers = range(1, N_CUSTOMERS + 1)
    _write(folder, "application_train.csv", "SK_ID_CURR,TARGET,AMT_INCOME_TOTAL,DAYS_EMPLOYED,EXT_SOURCE_1,FLAG_OWN_CAR,FLAG_DOCUMENT_2",
           [f"{c},{int(c % 7 == 0)},{1000 * c},{365243 if c % 5 == 0 else -100 * c},{'' if c % 3 == 0 else 0.5},{'YN'[c % 2]},{c % 2}" for c in customers])
    _write(folder, "application_test.csv", "SK_ID_CURR,AMT_INCOME_TOTAL,DAYS_BIRTH", [f"{100 + c},{c},-9000" for c in range(5)])
    _write(folder, "bureau.csv", "SK_ID_CURR,SK_ID_BUREAU,CREDIT_ACTIVE,DAYS_CREDIT,AMT_CREDIT_SUM",
           [f"{c},{1000 + 2 * c + i},Active,-{50 + c},{c * 10}" for c in customers for i in (0, 1)] + ["9999,1999,Closed,-10,5"])
    status = [f"{1000 + 2 * c},-{m},{'4' if m == 4 else 'C'}" for c in customers for m in range(1, 7)]
    _write(folder, "bureau_balance.csv", "SK_ID_BUREAU,MONTHS_BALANCE,STATUS", status + status[:1] * duplicate_status)
    accounts = [(500 + c, c) for c in customers]
    _write(folder, "previous_application.csv", "SK_ID_PREV,SK_ID_CURR,NAME_CONTRACT_TYPE,AMT_CREDIT,DAYS_DECISION",
           [f"{a},{c},Revolving loans,{c * 100},-400" for a, c in accounts])
    held = accounts + [(9000 + i, 1) for i in range(orphan_accounts)]
    _write(folder, "credit_card_balance.csv", "SK_ID_PREV,SK_ID_CURR,MONTHS_BALANCE,AMT_BALANCE,AMT_CREDIT_LIMIT_ACTUAL,AMT_DRAWINGS_ATM_CURRENT,NAME_CONTRACT_STATUS,SK_DPD,SK_DPD_DEF",
           [f"{a},{c},-{m},{m * 10},{0 if c == 1 else 100},{'' if m % 3 else 5},Active,{m if m > 4 else 0},0" for a, c in held for m in range(1, 10)])
    pos = [f"{a},{c},-{m},{'' if m == 2 else 12},Active,0,0" for a, c in accounts for m in range(1, 10)]
    _write(folder, "POS_CASH_balance.csv", "SK_ID_PREV,SK_ID_CURR,MONTHS_BALANCE,CNT_INSTALMENT,NAME_CONTRACT_STATUS,SK_DPD,SK_DPD_DEF",
           pos + [f"{accounts[0][0]},1,4,12,Active,0,0"] * positive_month)
    _write(folder, "installments_payments.csv", "SK_ID_PREV,SK_ID_CURR,NUM_INSTALMENT_NUMBER,DAYS_INSTALMENT,DAYS_ENTRY_PAYMENT,AMT_INSTALMENT,AMT_PAYMENT",
           [f"{a},{c},{i},-{30 * i},-{30 * i - i % 3},100,{50 if i % 4 == 0 else 100}" for a, c in accounts for i in range(1, 7)])
    _write(folder, "HomeCredit_columns_description.csv", ",Table,Row,Description,Special", ['1,t,r,"one, two",', "2,t,s,plain,x"])


def infer_all(spark, folder):
    return {
        s.name: sch.infer_schema(csv_source.scan_text(spark, f"{folder}/{s.filename}", csv_source.read_options(s)))
        for s in cfg.TABLE_SPECS
    }


def read_all(spark, folder):
    schemas = infer_all(spark, folder)
    return {
        s.name: csv_source.scan_csv(spark, f"{folder}/{s.filename}", schemas[s.name], csv_source.read_options(s)).drop("_corrupt_record")
        for s in cfg.TABLE_SPECS
    }


@pytest.fixture
def lake(spark):
    layout = cfg.Layout(None, "t_bronze", "t_silver", "t_gold", "t_reporting")
    names = [layout.bronze, layout.silver, layout.gold, layout.reporting]
    for d in names:
        spark.sql(f"CREATE DATABASE {d}")
    yield layout
    for d in names:
        spark.sql(f"DROP DATABASE {d} CASCADE")


def test_csv_to_silver(spark, tmp_path, lake):
    write_extract(tmp_path)
    schemas = infer_all(spark, tmp_path)
    app = {f.name: f.dataType.simpleString() for f in schemas["application_train"].fields}
    assert (app["FLAG_OWN_CAR"], app["FLAG_DOCUMENT_2"], app["DAYS_EMPLOYED"], app["TARGET"]) == ("string", "bigint", "double", "int")
    assert schemas["columns_description"].fieldNames()[0] == "col_0"

    audit = ingest.ingest_all(spark, str(tmp_path), schemas.__getitem__, layout=lake)
    counts = {r.table: (r.n_rows, r.n_corrupt, r.row_count_ok) for r in audit.collect()}
    assert counts["application_train"] == (20, 0, False) and counts["columns_description"] == (2, 0, None)
    with pytest.raises(quality.GateError):
        ingest.bronze_gate(audit)
    again = ingest.ingest_all(spark, str(tmp_path), schemas.__getitem__, ["bureau"], lake, tables.SKIP_EXISTING)
    assert again.first().status == "skipped" and spark.table("t_reporting.ingestion_audit").count() == 10
    assert {"_row_hash", "_source_file", "_ingested_at"} <= set(spark.table("t_bronze.bureau").columns)
    with pytest.raises(ValueError, match="nope"):
        ingest.select_specs(["nope"])

    bronze = {s.name: spark.table(lake.table("bronze", s.name)) for s in cfg.TABLE_SPECS}
    findings = verify.verify(spark, bronze).cache()
    clean.write_silver(spark, findings, {"application_train": 20}, lake)
    assert {r.status for r in clean.silver_gate(spark, lake).collect()} == {"PASS"}
    app = spark.table("t_silver.application")
    assert app.filter("is_not_employed").count() == 4 and app.filter("DAYS_EMPLOYED IS NULL").count() == 4
    assert dict(app.dtypes)["DAYS_EMPLOYED"] == "int" and "amt_income_total_was_capped" in app.columns
    pooled = spark.table("t_silver.panel_pooled")
    assert {r.product_type: r["count"] for r in pooled.groupBy("product_type").count().collect()} == {"CC": 180, "POS": 180}
    assert pooled.filter("product_type = 'CC' AND utilisation IS NULL").count() == 9
    status = spark.table("t_silver.bureau_balance")
    assert status.filter("is_90_plus").count() == 20 and status.agg(F.max("months_balance_aligned")).first()[0] == -2
    assert spark.table("t_silver.installments_payments").filter("is_short_payment").count() == 20
    profile = clean.silver_profile(spark, lake)
    assert profile.filter("table = 'application' AND column = 'EXT_SOURCE_1'").first().n_null == 6
    assert spark.table("t_reporting.silver_audit").count() == 7
    comments = dict(rows(tables.list_tables(spark, "t_silver")))
    assert comments == clean.COMMENTS

    # On to labels and features, with windows that fit nine months of history.
    cohorts = [cfg.Cohort("dev", -4, 3, 3), cfg.Cohort("oot", -5, 3, 3)]
    rule = cfg.PopulationRule(min_tenure_months=2, min_obs_rows=3, min_perf_rows=3)
    gate = gold.write_population(spark, lake, cohorts, rule)
    assert {r.check: r.status for r in gate.collect()}["min-bads"] == "FAIL"
    with pytest.raises(quality.GateError):
        quality.raise_on_fail(gate)
    target = spark.table("t_gold.target_behaviour")
    assert len(target.columns) == 15 and target.count() == 80
    waterfall = spark.table("t_reporting.exclusion_waterfall").filter("cohort = 'dev' AND step IN (0, 7)")
    assert rows(waterfall.select("step", "n_out"), "step") == [(0, 40), (7, 40)]
    application = spark.table("t_gold.target_application")
    assert application.count() == 20 and application.agg(F.sum("target"), F.max("n_product_types")).first() == (2, 2)
    leak = gold.write_features(spark, lake, cohorts)
    assert leak.first().status == "PASS"
    features = spark.table("t_gold.features_internal")
    assert features.count() == 80 and len(features.columns) == 76
    dictionary = spark.table("t_gold.feature_dictionary")
    assert dictionary.count() == 71 and gold.unbuilt_features(dictionary).count() == 0
    card = features.filter("cohort = 'dev' AND product_type = 'CC' AND SK_ID_PREV = 502").first()
    assert (card.max_dpd_3m, card.util_at_obs, card.cash_adv_amt_3m, card.n_txn_3m) == (6, 0.4, 5.0, None)


def test_verification_of_a_good_extract(spark, tmp_path):
    write_extract(tmp_path)
    found = verify.verify(spark, read_all(spark, tmp_path)).collect()
    by = {(r.check, r.target, r.column_name): r.status for r in found}
    assert all(s == "PASS" for (check, _, _), s in by.items() if check in ("key-uniqueness", "panel-index"))
    assert by["referential", "bureau_balance.SK_ID_BUREAU -> bureau.SK_ID_BUREAU", None] == "PASS"
    assert by["referential", "bureau.SK_ID_CURR -> application_train.SK_ID_CURR", None] == "WARN"
    assert by["days-sentinel", "application_train", "DAYS_EMPLOYED"] == "WARN"
    assert by["days-sentinel", "bureau", None] == "PASS"
    assert by["row-count", "application_train", None] == "FAIL"


@pytest.mark.parametrize(
    "damage, check",
    [({"duplicate_status": True}, "key-uniqueness"), ({"orphan_accounts": 20}, "referential"), ({"positive_month": True}, "panel-index")],
)
def test_verification_of_damaged_extracts(spark, tmp_path, damage, check):
    write_extract(tmp_path, **damage)
    found = verify.verify(spark, read_all(spark, tmp_path)).filter((F.col("check") == check) & (F.col("status") == "FAIL"))
    assert found.count() == 1


def test_missing_tables_only_warn(spark):
    found = verify.verify(spark, {})
    assert {r.status for r in found.collect()} == {"WARN"}
