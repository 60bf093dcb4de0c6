"""What several of these operators share: words, table reads, typed Arrow passes and connected components."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from cohortlake.sources.workspace import materialise

#: A word: everything between ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORDS = re.compile(WORD_PATTERN)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text) if text else []


def arrow_pass(df: DataFrame, rows: Callable[[Iterator[dict]], Iterator[dict]], ddl: str) -> DataFrame:
    """``mapInArrow`` over dictionaries of columns: every batch comes and goes as ``{column: list or array}``."""
    schema = _parse_datatype_string(ddl)
    assert isinstance(schema, StructType)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def columns() -> Iterator[dict]:
            for b in batches:
                if b.num_rows:
                    yield {n: b.column(i) for i, n in enumerate(b.schema.names)}

        for out in rows(columns()):
            yield pa.RecordBatch.from_arrays([as_array(out[f.name], f.type) for f in arrow], schema=arrow)
        out = None
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Hand freed memory back to the system: Spark keeps workers between tasks, and each would hold on to its peak."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def as_array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit integers (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def components(edges: DataFrame, a: str, b: str, *, label: str = "components", max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected links: one row ``(id, component_id)`` per node that has a link.

    ``component_id`` is the smallest id reachable. Alternating large-star and small-star rounds: links are rewritten
    to point at the smallest neighbour until each component is a star. Every round is one table in the shared folder,
    so neither lineage nor driver state grows; a hub is only ever a join key, which adaptive execution can split.
    Self-links, repeated links and nulls are ignored; no links give an empty table.
    """
    e = (
        edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
        .where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
        .distinct()
    )
    e = materialise(e, label)
    for _ in range(max_rounds):
        if _stars(e):
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialise(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), label)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    members = e.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
    return members.unionByName(roots)


def _stars(e: DataFrame) -> bool:
    """Whether every node points at one other, and none of those points further: the links that rounds no longer change."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("points")).unionByName(e.select(F.col("v").alias("node"), F.lit(0).alias("points")))
    nodes = ends.groupBy("node").agg(F.sum("points").alias("out"), F.min("points").alias("least"))
    return not nodes.where("out > 1 OR (out = 1 AND least = 0)").limit(1).count()
