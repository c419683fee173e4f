"""Shared parts of the vector searches: clean vectors, their lengths, groups of queries."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberfold.storage import materialize

BLOCK_ROWS = 1_024
QUERY_ROWS = 512


def usable_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, vector`` (doubles) of rows with an id and a vector without NULL or non-finite values."""
    return df.select(F.col(id_col).cast("bigint").alias("id"),
                     F.col(vector_col).cast("array<double>").alias("vector")).where(
        F.col("id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0) & F.forall(
            "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def lengths_of(vectors: DataFrame) -> list[int]:
    """The lengths that vectors have, one entry each."""
    return sorted(r[0] for r in vectors.select(F.size("vector")).distinct().collect())


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list<double> column whose lists are equally long and whole."""
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), -1)


def rows_of(values: np.ndarray, kind: str = "<f8") -> pa.Array:
    """One binary value per row of a matrix."""
    return pa.array([v.tobytes() for v in np.ascontiguousarray(values, dtype=kind)], pa.binary())


def query_groups(asking: DataFrame, size: int, *more: str) -> DataFrame:
    """Stored groups of up to ``size`` queries, ``group, ids, vectors`` and a list for each further column.

    A query is named by its group and its place there, so that rows with the same id stay apart.
    """
    columns = ["id", "vector", *more]

    def run(batches):
        name = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first in range(0, batch.num_rows, size):
                part = batch.slice(first, size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), *[pa.array([part.column(c).to_pylist()], pa.list_(part.column(c).type))
                                         for c in columns]], names=["group", *[f"{c}s" for c in columns]])
                name += 1

    # dealt evenly, so that groups are full
    dealt = asking.select(*columns).repartition(max(1, -(-asking.count() // size)))
    kinds = ", ".join(f"{c}s array<{asking.schema[c].dataType.simpleString()}>" for c in columns)
    return materialize(dealt.mapInArrow(run, f"group bigint, {kinds}"), "query-groups")
