"""Small helpers that run inside tasks."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberfold.storage import materialize

# A table is broadcast only if it was stored and its counted bytes stay below this.
BROADCAST_BYTES = 24 * 1024 * 1024
_STORE = "_emberfold_worker_store"


def once(key: tuple, make: Callable[[], object]) -> object:
    """What ``make`` returns, made once per Python worker and key."""
    store = sys.modules.setdefault(_STORE, types.ModuleType(_STORE)).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def pieces(batches: Iterable[pa.RecordBatch], column: str,
           limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose ``column`` holds about ``limit`` bytes at most.

    A single longer value makes a batch of its own. Once all are done, memory that was
    freed goes back to the system, as the worker process lives on.
    """
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy()
        ends = np.cumsum(sizes, dtype=np.int64)
        first = 0
        while first < len(sizes):
            done = ends[first - 1] if first else 0
            last = max(int(np.searchsorted(ends, done + limit, "right")), first + 1)
            yield batch.slice(first, last - first)
            first = last
    give_back()


def give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def small_batches(df: DataFrame, size: str = "8m") -> DataFrame:
    """Have Spark hand rows to Python in batches of a few megabytes, from here on in the session."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    return df


def attach(left: DataFrame, right: DataFrame, on: str | list[str], label: str,
           how: str = "left", row_bytes: int = 64, list_column: str | None = None,
           entry_bytes: int = 8) -> DataFrame:
    """Join a large table to one that has one row per key.

    ``right`` is stored and its size counted (``row_bytes`` a row and ``entry_bytes``
    for each entry of ``list_column``). Small enough, it is broadcast and ``left``
    stays where it is; otherwise the join shuffles. NULL keys find nothing.
    """
    right = materialize(right, label)
    entries = F.sum(F.size(list_column)) if list_column else F.lit(0)
    rows, items = right.agg(F.count(F.lit(1)), F.coalesce(entries, F.lit(0))).first()
    if rows * row_bytes + entry_bytes * items <= BROADCAST_BYTES:
        right = F.broadcast(right)
    return left.join(right, on, how)


def id_arrays(values: list[np.ndarray]) -> pa.ListArray:
    """A list<int> column from one array of ids per row."""
    offsets = np.zeros(len(values) + 1, dtype=np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    flat = np.concatenate(values) if values else np.empty(0)
    return pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.int32)))


def with_ids_crc32(df: DataFrame, ids: str = "ids") -> DataFrame:
    """Replace a column of ids by ``ids_crc32``: of little-endian unsigned 32-bit ids."""
    kept = [f for f in df.schema.fields if f.name != ids]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def digest(batches):
        for batch in batches:
            column = batch.column(ids)
            ends = column.offsets.to_numpy()
            first = ends[0] if len(ends) else 0
            flat = np.ascontiguousarray(column.flatten().to_numpy().astype("<u4"))
            sums = [zlib.crc32(flat[a - first:b - first]) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in kept], pa.array(sums, pa.int64())],
                names=[*[f.name for f in kept], "ids_crc32"])

    return df.mapInArrow(digest, f"{schema}, ids_crc32 bigint")
