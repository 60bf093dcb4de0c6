"""Sums of products of columns, as one distributed pass whatever the number of columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Up to so many columns the sums of products are one generated aggregate; there are fewer than 100 of them.
_NARROW = 12


def gram(df: DataFrame, columns: Sequence[Column]) -> np.ndarray:
    """The matrix of ``sum(a * b)`` over all rows, for every two columns.

    Rows are added up in the tasks; the driver gets one number per pair of columns. A missing value is an error, since
    leaving its row out would go unseen. No rows give zeros. Wider rows become vectors, whose sums merge in a tree.
    """
    names = [f"g{i}" for i in range(len(columns))]
    numbers = df.select(*[c.cast("double").alias(n) for c, n in zip(columns, names)])
    return _by_aggregate(numbers) if len(names) <= _NARROW else _by_vectors(numbers)


def _by_aggregate(numbers: DataFrame) -> np.ndarray:
    n = len(numbers.columns)
    pairs = [(i, j) for i in range(n) for j in range(i + 1)]
    cells = [F.col(c) for c in numbers.columns]
    missing = reduce(Column.__or__, [c.isNull() | F.isnan(c) for c in cells])
    # Sums over blocks of rows first: one long sum of like numbers loses digits.
    blocks = numbers.groupBy(F.shiftright(F.monotonically_increasing_id(), 16).alias("_block")).agg(
        *[F.sum(cells[i] * cells[j]).alias(f"s{k}") for k, (i, j) in enumerate(pairs)], F.count_if(missing).alias("without")
    )
    *sums, without = blocks.agg(*[F.sum(f"s{k}") for k in range(len(pairs))], F.coalesce(F.sum("without"), F.lit(0))).first()
    if without:
        raise ValueError(f"{without} rows have a null or NaN value")
    out = np.zeros((n, n))
    for (i, j), v in zip(pairs, sums):
        out[i, j] = out[j, i] = 0.0 if v is None else v
    return out


def _by_vectors(numbers: DataFrame) -> np.ndarray:
    names = numbers.columns
    nothing = numbers.sparkSession.range(1).select(*[F.lit(0.0).alias(n) for n in names])
    numbers = numbers.union(nothing)  # a table without rows has no sums; zeros add nothing
    rows = VectorAssembler(inputCols=names, outputCol="row", handleInvalid="error").transform(numbers).select("row")
    return RowMatrix(MLUtils.convertVectorColumnsFromML(rows, "row"), numCols=len(names)).computeGramianMatrix().toArray()
