"""Registry of the runnable queries and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: Run
    oracle: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, run, oracle)
        return run

    return register


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every double, so that summation order does not show in a comparison."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in doubles})


def r(expression: str, digits: int = 4) -> str:
    """The SQL side of ``rounded``; adding zero turns -0.0 into 0.0."""
    return f"(round({expression}, {digits}) + 0.0)"


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"
