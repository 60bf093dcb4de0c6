"""The raw-data gate: every check over every registered table as one findings DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from cohortlake import config as cfg
from cohortlake.operators import quality as q


def verify(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    specs: Sequence[cfg.TableSpec] = cfg.TABLE_SPECS,
    references: Sequence[cfg.Reference] = cfg.REFERENCES,
    panels: Sequence[str] = cfg.PANEL_TABLES,
    month: str = "MONTHS_BALANCE",
) -> DataFrame:
    """Row counts, keys, references, panel index and sentinels. Missing tables only warn."""
    findings = [q.row_counts(spark, sources, {s.name: s.expected_rows for s in specs})]

    for spec in specs:
        if spec.name in sources:
            findings.append(q.key_uniqueness(sources[spec.name], spec.name, spec.natural_key))
        elif spec.has_natural_key:
            findings.append(q.note(spark, q.WARN, "key-uniqueness", spec.name, "table missing"))

    for edge in references:
        if edge.child in sources and edge.parent in sources:
            found = q.referential(sources[edge.child], sources[edge.parent], edge)
            findings.append(found.drop("n_orphan_rows", "n_child_rows", "orphan_rate_rows"))
        else:
            findings.append(q.note(spark, q.WARN, "referential", edge.target, "table missing"))

    for name in panels:
        if name in sources:
            findings.append(q.panel_index(sources[name], name, month))
        else:
            findings.append(q.note(spark, q.WARN, "panel-index", name, "table missing"))

    for name, df in sources.items():
        scanned = q.sentinel_scan(df, name)
        if scanned is not None:
            findings.append(scanned)
    return q.union_findings(findings)
