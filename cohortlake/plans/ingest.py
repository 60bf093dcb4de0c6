"""CSV files to typed bronze tables with an audit trail and a gate."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake import config as cfg
from cohortlake.operators import quality
from cohortlake.sources import csv_source, tables
from cohortlake.sources import schema as sch


def select_specs(names: Sequence[str] = (), specs: Sequence[cfg.TableSpec] = cfg.TABLE_SPECS) -> list[cfg.TableSpec]:
    unknown = sorted(set(names) - {s.name for s in specs})
    if unknown:
        raise ValueError(f"not in the registry: {', '.join(unknown)}")
    return [s for s in specs if not names or s.name in names]


def ingest(
    spark: SparkSession,
    spec: cfg.TableSpec,
    folder: str,
    schema: T.StructType,
    layout: cfg.Layout = cfg.Layout(),
    mode: str = tables.OVERWRITE,
    cluster: bool = True,
) -> dict:
    """Load one file; the counts come from the written table in one aggregate."""
    target = layout.table("bronze", spec.name)
    base = {"table": spec.name, "target": target, "expected_rows": spec.expected_rows}
    if mode == tables.SKIP_EXISTING and spark.catalog.tableExists(target):
        return {**base, "status": "skipped", "n_rows": spark.table(target).count(), "duration_sec": 0.0}

    started = time.monotonic()
    raw = csv_source.scan_csv(spark, f"{folder}/{spec.filename}", schema, csv_source.read_options(spec))
    rows = csv_source.add_lineage(raw, schema.fieldNames())
    if cluster and spec.cluster_by:
        rows = tables.clustered(rows, spec.cluster_by)
    written = tables.overwrite_table(rows, target, f"{spec.description} | grain: {spec.grain}")
    counts = written.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(F.col(sch.CORRUPT_RECORD)).alias("n_corrupt")
    ).first()
    matches = None if spec.expected_rows is None else counts["n_rows"] == spec.expected_rows
    return {
        **base,
        "status": "ingested",
        "n_rows": counts["n_rows"],
        "n_corrupt": counts["n_corrupt"],
        "row_count_ok": matches,
        "schema_fingerprint": sch.fingerprint(schema),
        "n_columns": len(schema.fields),
        "duration_sec": round(time.monotonic() - started, 1),
    }


def ingest_all(
    spark: SparkSession,
    folder: str,
    schema_of: Callable[[str], T.StructType],
    names: Sequence[str] = (),
    layout: cfg.Layout = cfg.Layout(),
    mode: str = tables.OVERWRITE,
    specs: Sequence[cfg.TableSpec] = cfg.TABLE_SPECS,
) -> DataFrame:
    """Ingest the chosen tables, append the audit, return it. The gate is the caller's step."""
    chosen = select_specs(names, specs)
    records = [ingest(spark, s, folder, schema_of(s.name), layout, mode) for s in chosen]
    return tables.append_audit(spark, records, tables.AUDIT, layout.table("reporting", "ingestion_audit"))


def bronze_gate(audit: DataFrame) -> DataFrame:
    findings = quality.ingestion_gate(audit)
    quality.raise_on_fail(findings)
    return findings
