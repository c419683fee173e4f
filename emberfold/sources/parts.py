"""Tables in parts, of which a batch rewrites only those it touches.

Below a path lie ``rows/version=N/<part>=P``, the parts as batch N wrote them, and
``index/batch_id=N``, which names the version of each part after batch N. Batch N reads the index of N - 1 and writes
its own, so its replay gives the same, and readers see all of a batch or nothing. Batch ids
follow each other without gaps, as a stream's do. An index has a row per part: parts are
buckets of a hash or days.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from emberfold.storage import delete_folder, folder_names, is_complete

# Which version holds each part.
Index = dict[str, int]


@dataclass(frozen=True)
class PartTable:
    """A table below ``path`` in parts by the column ``part``, whose values go into folder names."""

    path: str
    part: str

    def index(self, spark: SparkSession, batch_id: int | None = None) -> Index:
        """As of a batch, by default the last finished one; empty before the first."""
        if batch_id is None:
            done = [int(name.split("=")[1]) for name in folder_names(spark, f"{self.path}/index")
                    if is_complete(spark, f"{self.path}/index/{name}")]
            batch_id = max(done, default=-1)
        if batch_id < 0:
            return {}
        rows = spark.read.schema("part string, version bigint").parquet(f"{self.path}/index/batch_id={batch_id}")
        return {r["part"]: r["version"] for r in rows.collect()}

    def read(self, spark: SparkSession, schema: StructType, index: Index,
             parts: Iterable[str] | None = None) -> DataFrame:
        """The rows of all or of the named ``parts``; no other folder is listed or read."""
        wanted = index if parts is None else [p for p in parts if p in index]
        paths = [f"{self.path}/rows/version={index[p]}/{self.part}={p}" for p in wanted]
        if not paths:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", f"{self.path}/rows").parquet(*paths).select(
            *schema.fieldNames())

    def write(self, rows: DataFrame, batch_id: int, before: Index, touched: Iterable[str]) -> Index:
        """Replace the ``touched`` parts by ``rows``, which has all of them, and return the new index.

        What neither this batch nor the one before refers to is deleted then.
        """
        spark = rows.sparkSession
        folder = f"{self.path}/rows/version={batch_id}"
        # a stream's batches are planned without adaptive execution, where the hint does nothing and every task
        # would write a file to every part
        adaptive = str(spark.conf.get("spark.sql.adaptive.enabled")).lower() == "true"
        dealt = rows.hint("rebalance", F.col(self.part)) if adaptive else rows.repartition(F.col(self.part))
        dealt.write.mode("overwrite").partitionBy(self.part).parquet(folder)
        written = [unquote(name.split("=", 1)[1]) for name in folder_names(spark, folder)
                   if name.startswith(f"{self.part}=")]
        index = {p: v for p, v in before.items() if p not in set(touched)} | dict.fromkeys(written, batch_id)
        spark.createDataFrame(list(index.items()), "part string, version bigint").coalesce(1).write.mode(
            "overwrite").parquet(f"{self.path}/index/batch_id={batch_id}")
        self._release(spark, batch_id - 2, before)
        return index

    def _release(self, spark: SparkSession, batch_id: int, kept: Index) -> None:
        old = f"{self.path}/index/batch_id={batch_id}"
        if batch_id < 0 or not is_complete(spark, old):
            return
        for part, version in self.index(spark, batch_id).items():
            if kept.get(part) != version:
                delete_folder(spark, f"{self.path}/rows/version={version}/{self.part}={part}")
        delete_folder(spark, old)


def parts_of(rows: DataFrame, part: str) -> list[str]:
    """The parts that rows belong to, one entry each."""
    return [r[0] for r in rows.select(F.col(part).cast("string")).distinct().collect()]
