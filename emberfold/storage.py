"""Where intermediate tables and checkpoints live."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import cache
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

# Independent jobs submitted at a time; most of the tables they write are small.
PARALLEL_JOBS = 4


# Stored tables of this driver, until they are released.
_STORED: list[str] = []


def run_together(jobs: Mapping[str, Callable[[], T]], at_once: int = PARALLEL_JOBS) -> dict[str, T]:
    """Run independent jobs side by side, so that small ones share the cluster."""
    with ThreadPoolExecutor(at_once) as pool:
        running = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: job.result() for name, job in running.items()}


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="emberfold-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path, never used before, below the folder all executors share.

    The folder is the session's ``spark.checkpoint.dir``, which has to be set when the session
    starts, such as ``build_session(..., **{"spark.checkpoint.dir": folder})``. Only a session whose driver
    and executors are one process may run without; it gets a temporary folder of that process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        base = _own_folder()
    if not base:
        raise ValueError("start the session with spark.checkpoint.dir set to a folder that all executors can "
                         "reach; intermediate tables are written there")
    return f"{base.rstrip('/')}/emberfold/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage with a real table, so a lost executor costs a re-read and
    not a recomputation, and gives the planner the table's true size.
    """
    path = scratch_path(df.sparkSession, label)
    _STORED.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete every table that ``materialize`` stored from this driver; returns how many.

    For the end of a flow, when its results are stored elsewhere: what still reads
    such a table fails afterwards.
    """
    released = 0
    while _STORED:
        released += delete_folder(spark, _STORED.pop())
    return released


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Whether there was one."""
    files, folder = _folder(spark, path)
    return files.delete(folder, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if it is absent."""
    files, folder = _folder(spark, path)
    if not files.exists(folder):
        return []
    return sorted(f.getPath().getName() for f in files.listStatus(folder))


def folder_bytes(spark: SparkSession, path: str) -> int:
    files, folder = _folder(spark, path)
    return files.getContentSummary(folder).getLength()


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether Spark has finished writing the folder."""
    files, _ = _folder(spark, path)
    return files.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS"))
