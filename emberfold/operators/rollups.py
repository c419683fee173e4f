"""Questions to the gold tables: impact by place, by cause, across facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from emberfold.operators.joins import MAX_BROADCAST_ROWS, fits_broadcast
from emberfold.sources.parts import PartTable, parts_of
from emberfold.storage import materialize


def count_and_sums(fact: DataFrame, by: Sequence[str], measures: Mapping[str, Column],
                   count: str) -> DataFrame:
    """Rows and summed measures per group."""
    return fact.groupBy(*by).agg(
        F.count(F.lit(1)).alias(count), *[F.sum(c).alias(m) for m, c in measures.items()])


def impact_by(fact: DataFrame, key: str, dimension: DataFrame, dimension_key: str,
              labels: Sequence[str], extra: Sequence[str], measures: Mapping[str, Column],
              count: str = "events", rollup: bool = False,
              max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Count and measures by the dimension's labels and the fact's own columns.

    The dimension's size is counted first. Small enough, it is broadcast to the fact, and
    only the final groups move. Otherwise the fact is reduced to one row per key before
    the join, so a hot key is gone before any row moves.
    """
    # stored, as it is counted and then joined
    labelled = materialize(dimension.select(F.col(dimension_key).alias(key), *labels), "labels")
    if fits_broadcast(labelled, max_broadcast_rows):
        joined = fact.select(key, *extra, F.lit(1).cast("bigint").alias(count), *[
            c.alias(m) for m, c in measures.items()]).join(F.broadcast(labelled), key)
    else:
        joined = count_and_sums(fact, [key, *extra], measures, count).join(labelled, key)
    grouped = joined.rollup(*labels, *extra) if rollup else joined.groupBy(*labels, *extra)
    return grouped.agg(*[F.sum(c).alias(c) for c in [count, *measures]])


def append_sums(path: str, part: str, batch_id: int, sums: DataFrame, measures: Sequence[str]) -> None:
    """Add the sums of a batch to stored ones: a row per group, in parts by the column ``part``, such as a month.

    All columns but ``measures`` name the group. Only the parts that the batch has are read and written
    again, and a replayed batch adds nothing twice.
    """
    spark, table = sums.sparkSession, PartTable(path, part)
    index = table.index(spark, batch_id - 1)
    new = materialize(sums, "batch-sums")
    touched = parts_of(new, part)
    groups = [c for c in new.columns if c not in measures]
    merged = new.unionByName(table.read(spark, new.schema, index, touched)).groupBy(*groups).agg(
        *[F.sum(m).cast(new.schema[m].dataType).alias(m) for m in measures])
    table.write(merged, batch_id, index, touched)


def stored_sums(spark: SparkSession, path: str, part: str, schema: StructType,
                parts: Sequence[str] | None = None) -> DataFrame:
    """Sums of all batches, of all parts or of some; to be summed further by any of the groups."""
    table = PartTable(path, part)
    return table.read(spark, schema, table.index(spark), parts)


def drill_across(counts: Sequence[tuple[DataFrame, str]], on: str) -> DataFrame:
    """Join aggregates of several facts on the conformed key; absent counts are 0.

    Every input is one row per key, so facts never multiply each other.
    """
    joined = reduce(lambda a, b: a.join(b, on, "full"), [df for df, _ in counts])
    return joined.select(on, *[
        F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for _, c in counts])
