"""Folders of small batches, packed into large files.

A sink writes ``<path>/batch_id=N``. Packs lie at ``<path>-packs/<first>-<last>`` and hold the rows of these batches with
their ``batch_id``. The last batch of the last pack is the pointer: readers take the packs, and
only batch folders beyond it. A packed batch that is replayed writes its folder again, which
nobody reads any more.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberfold.storage import delete_folder, folder_bytes, folder_names, is_complete

TARGET_BYTES = 256 * 1024 * 1024


class Pack(NamedTuple):
    first: int
    last: int
    path: str


def packs(spark: SparkSession, path: str) -> list[Pack]:
    """The packs that readers take: from each first batch on the longest finished one."""
    root = f"{path}-packs"
    found = []
    for name in folder_names(spark, root):
        if is_complete(spark, f"{root}/{name}"):
            first, last = map(int, name.split("-"))
            found.append(Pack(first, last, f"{root}/{name}"))
    chain: list[Pack] = []
    while True:
        at = chain[-1].last + 1 if chain else min((p.first for p in found), default=0)
        longest = max((p for p in found if p.first == at), default=None, key=lambda p: p.last)
        if longest is None:
            return chain
        chain.append(longest)


def _batches(spark: SparkSession, path: str) -> list[int]:
    """Batches with a finished folder."""
    return sorted(int(name.split("=")[1]) for name in folder_names(spark, path)
                  if name.startswith("batch_id=") and is_complete(spark, f"{path}/{name}"))


def _read(spark: SparkSession, path: str, taken: list[Pack], batches: list[int]) -> DataFrame:
    frames = []
    if taken:
        frames.append(spark.read.parquet(*[p.path for p in taken]).withColumn("batch_id", F.col("batch_id").cast("bigint")))
    if batches:
        folders = [f"{path}/batch_id={b}" for b in batches]
        frames.append(spark.read.option("basePath", path).parquet(*folders).withColumn(
            "batch_id", F.col("batch_id").cast("bigint")))
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a sink's finished batches, packed or not, with their ``batch_id``."""
    taken = packs(spark, path)
    done = taken[-1].last if taken else -1
    rest = [b for b in _batches(spark, path) if b > done]
    if not taken and not rest:
        raise ValueError(f"no finished batches below {path}")
    return _read(spark, path, taken, rest)


def pack_batches(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES) -> Pack | None:
    """Write the batches behind the last pack as files of about ``target_bytes``; the new pack, or nothing to do.

    A last pack of less than that is written again with them, so that packs grow to the target before the next
    begins. The newest batch stays unpacked, as its writer may still be at work. Folders and packs that a former
    run has replaced are deleted first: readers have the time between two runs to finish. For one caller at a
    time; a run that dies leaves an unfinished pack that nobody reads, and the next writes it anew.
    """
    taken = packs(spark, path)
    done = taken[-1].last if taken else -1
    batches = _batches(spark, path)
    for old in (b for b in batches if b <= done):
        delete_folder(spark, f"{path}/batch_id={old}")
    names = {p.path for p in taken}
    for name in folder_names(spark, f"{path}-packs"):
        if f"{path}-packs/{name}" not in names:
            delete_folder(spark, f"{path}-packs/{name}")
    new = [b for b in batches if b > done][:-1]
    if not new:
        return None
    small = taken[-1:] if taken and folder_bytes(spark, taken[-1].path) < target_bytes else []
    first = small[0].first if small else done + 1 if taken else new[0]
    size = sum(folder_bytes(spark, p) for p in [*[s.path for s in small], *[f"{path}/batch_id={b}" for b in new]])
    pack = Pack(first, new[-1], f"{path}-packs/{first}-{new[-1]}")
    # neighbours are merged without a shuffle
    _read(spark, path, small, new).coalesce(max(1, round(size / target_bytes))).write.mode("overwrite").parquet(pack.path)
    return pack
