"""Named tables: create, publish, read."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from emberfold.storage import delete_folder, folder_names, is_complete, run_together


def ensure_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")


def read_table(spark: SparkSession, name: str, format: str | None = None) -> DataFrame:
    """A catalog table, or a stored path when ``format`` is given."""
    return spark.read.format(format).load(name) if format else spark.table(name)


def create_table(spark: SparkSession, name: str, columns: str, path: str,
                 format: str = "parquet") -> None:
    """Typed table, if absent."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {format} LOCATION '{path}'")


def publish(df: DataFrame, schema: str, table: str, root: str,
            partition_by: Sequence[str] = (), format: str = "parquet") -> DataFrame:
    """Replace a table by ``df`` and return the stored table.

    The rows go to a new folder first and the table is then pointed at it, so
    readers never see half a table and ``df`` may read the table it replaces. A partitioned
    table, and one whose schema changes, is dropped and created again over the new
    folder: between the two its name is absent for a moment, and a driver that dies
    there leaves the rows without a name. Old folders stay for readers that are still at them.
    Partitioned tables are rebalanced by their partition columns first: few files
    per partition, and a large partition is still written by many tasks.
    """
    spark = df.sparkSession
    name = f"{schema}.{table}"
    path = f"{root.rstrip('/')}/{schema}/{table}/v-{uuid.uuid4().hex}"
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    df.write.format(format).partitionBy(*partition_by).save(path)
    stored = spark.read.format(format).schema(df.schema).load(path)

    ensure_schema(spark, schema)
    if (not partition_by and spark.catalog.tableExists(name)
            and spark.table(name).schema == stored.schema):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored.schema)
        parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        spark.sql(f"CREATE TABLE {name} ({columns}) USING {format}{parts} LOCATION '{path}'")
        if partition_by:
            spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def publish_all(tables: Mapping[str, DataFrame], schema: str, root: str,
                partition_by: Mapping[str, Sequence[str]] | None = None) -> dict[str, DataFrame]:
    ensure_schema(next(iter(tables.values())).sparkSession, schema)
    layout = partition_by or {}
    return run_together({
        name: partial(publish, df, schema, name, root, layout.get(name, ()))
        for name, df in tables.items()})


# Versions of a set that stay, the present one included, for readers that are still at them.
KEEP_VERSIONS = 2


def _set_versions(spark: SparkSession, root: str, schema: str) -> list[int]:
    """Finished versions of a set, in order: those whose list of tables was written, which comes last."""
    base = f"{root.rstrip('/')}/{schema}"
    return sorted(int(name.split("=")[1]) for name in folder_names(spark, base)
                  if name.startswith("set=") and is_complete(spark, f"{base}/{name}/tables"))


def publish_set(tables: Mapping[str, DataFrame], schema: str, root: str,
                partition_by: Mapping[str, Sequence[str]] | None = None, keep: int = KEEP_VERSIONS) -> int:
    """Publish tables as one version of a set and return its number.

    All tables go to ``<root>/<schema>/set=N``; the list of the tables is written last and makes the version
    valid at once, so :func:`read_set` never mixes versions and never sees part of one. Then the view of each name is
    replaced in one step, so a name is never absent; schema and partitions may change. The last ``keep`` versions
    stay and older ones are deleted. One caller publishes a set at a time; what it leaves unfinished is overwritten by the next.
    """
    spark = next(iter(tables.values())).sparkSession
    done = _set_versions(spark, root, schema)
    version = done[-1] + 1 if done else 1
    base, layout = f"{root.rstrip('/')}/{schema}", partition_by or {}

    def write(name: str, df: DataFrame) -> None:
        by = layout.get(name, ())
        if by:
            df = df.hint("rebalance", *[F.col(c) for c in by])
        df.write.mode("overwrite").partitionBy(*by).parquet(f"{base}/set={version}/{name}")

    run_together({name: partial(write, name, df) for name, df in tables.items()})
    spark.createDataFrame([(name, df.schema.json()) for name, df in tables.items()], "name string, fields string").coalesce(
        1).write.mode("overwrite").parquet(f"{base}/set={version}/tables")
    ensure_schema(spark, schema)
    for name, df in tables.items():
        columns = ", ".join(f"`{c}`" for c in df.columns)
        spark.sql(f"CREATE OR REPLACE VIEW {schema}.{name} AS SELECT {columns} FROM parquet.`{base}/set={version}/{name}`")
    for old in done[:len(done) + 1 - keep]:
        delete_folder(spark, f"{base}/set={old}")
    return version


def read_set(spark: SparkSession, schema: str, root: str, version: int | None = None) -> dict[str, DataFrame]:
    """All tables of one version of a set, by default of the newest."""
    done = _set_versions(spark, root, schema)
    version = done[-1] if version is None else version
    folder = f"{root.rstrip('/')}/{schema}/set={version}"
    return {r["name"]: spark.read.schema(StructType.fromJson(json.loads(r["fields"]))).parquet(f"{folder}/{r['name']}")
            for r in spark.read.parquet(f"{folder}/tables").collect()}
