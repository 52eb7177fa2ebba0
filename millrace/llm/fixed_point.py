"""Vectors as integers: which rows take part, and their components times a scale, floored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column

#: Doubles hold every integer below this exactly, so products of matrices do too.
EXACT = 1 << 53


def finite(vector_col: str) -> Column:
    """Whether a vector is there and none of its components is NULL or not finite."""
    vector = column(vector_col).cast("array<double>")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return vector.isNotNull() & F.forall(vector, fine)


def doubles(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``vector`` of the rows whose vector is ``finite``."""
    vector = column(vector_col).cast("array<double>").alias("vector")
    return df.filter(finite(vector_col)).select(column(id_col).alias("id"), vector)


def floored(vectors: pa.Array, scale: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """All components in turn as integers, and the length of every vector. A component
    beyond ``limit`` is an error: results would no longer fit their type."""
    sizes = np.diff(vectors.offsets.to_numpy()).astype(np.int64)
    values = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False))
    if len(values) and np.abs(values).max() > limit:
        raise ValueError(f"a component times {scale} is beyond {limit}")
    return values.astype(np.int64), sizes


def slabs(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The rows of a task in their order, in tables of ``rows`` (the last may be shorter)."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        while batch.num_rows:
            some = batch.slice(0, rows - size)
            batch = batch.slice(some.num_rows)
            held.append(some)
            size += some.num_rows
            if size == rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)
