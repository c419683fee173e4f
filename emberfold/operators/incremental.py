"""Checks of tables that grow: measured per batch, added up when asked.

Per batch N, below a path: ``sums/batch_id=N``, the rows of the batch that pass each completeness and predicate
constraint; ``keys/batch_id=N``, how often each key value of a unique or foreign key occurs in it, in buckets; and
``totals/batch_id=N``, how many key values are known and how many occur once up to then. A batch reads its own
rows, and of the keys before it those in its own buckets; the table itself is never read again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberfold.operators.joins import lookup_join
from emberfold.operators.quality import Check, _is_one, named_results
from emberfold.storage import materialize

KEY_BUCKETS = 256
_KEYS = "i int, bucket int, key string, n bigint"


def _numbered(checks: Sequence[Check]) -> tuple[list, list, list]:
    """Constraints in order, each with its number: ratios, unique keys, foreign keys."""
    at = 0
    kinds: tuple[list, list, list] = [], [], []
    for t, check in enumerate(checks):
        for found, own in zip(kinds, (check.ratios, check.uniques, check.parents)):
            for constraint in own:
                found.append((at, t, constraint))
                at += 1
    return kinds


def _text(key: Column) -> Column:
    return key.cast("string")


def append_batch(spark: SparkSession, path: str, batch_id: int, checks: Sequence[tuple[DataFrame, Check]],
                 buckets: int = KEY_BUCKETS) -> None:
    """Measure the rows of a batch; ``checks`` pairs each table's new rows with its constraints.

    The constraints are the same in every batch, and batch ids rise from 0 without gaps. A batch that
    is measured again overwrites its own measures and gives the same, as long as no later one was.
    """
    ratios, uniques, parents = _numbered([check for _, check in checks])
    tables = [df for df, _ in checks]
    sums = []
    for t, df in enumerate(tables):
        own = [(i, flag) for i, u, (_, flag, _) in ratios if u == t]
        if own:
            counted = df.agg(F.count(F.lit(1)).alias("seen"), *[
                F.coalesce(F.sum(flag.cast("bigint")), F.lit(0)).alias(f"p{i}") for i, flag in own])
            sums.append(counted.select(F.inline(F.array(*[
                F.struct(F.lit(i).alias("i"), F.col(f"p{i}").alias("passed"), F.col("seen")) for i, _ in own]))))
    if sums:
        reduce(DataFrame.unionByName, sums).coalesce(1).write.mode("overwrite").parquet(f"{path}/sums/batch_id={batch_id}")

    cells = [[(i, F.col(c)) for i, u, (_, c) in uniques if u == t]
             + [(i, F.col(fk.column)) for i, u, (_, fk) in parents if u == t] for t in range(len(tables))]
    if not any(cells):
        return
    # each table is read once; copies of a key meet before they move
    listed = [df.select(F.inline(F.array(*[F.struct(F.lit(i).alias("i"), _text(c).alias("key")) for i, c in own])))
              for df, own in zip(tables, cells) if own]
    bucket = F.pmod(F.xxhash64("i", "key"), F.lit(buckets)).cast("int").alias("bucket")
    counts = reduce(DataFrame.unionByName, listed).groupBy("i", "key").agg(F.count(F.lit(1)).alias("n"))
    folder = f"{path}/keys/batch_id={batch_id}"
    counts.select("i", bucket, "key", "n").hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy(
        "bucket").parquet(folder)
    if not uniques:
        return
    new = spark.read.schema(_KEYS).parquet(folder).where(F.col("key").isNotNull() & F.col("i").isin(
        [i for i, _, _ in uniques]))
    totals = spark.createDataFrame([(i, 0, 0) for i, _, _ in uniques], "i int, known bigint, single bigint")
    if batch_id > 0:
        totals = totals.unionByName(spark.read.schema(totals.schema).parquet(f"{path}/totals/batch_id={batch_id - 1}"))
        touched = [r[0] for r in new.select("bucket").distinct().collect()]
        old = _stored_keys(spark, path, batch_id - 1).where(F.col("bucket").isin(touched)).groupBy("i", "key").agg(
            F.sum("n").alias("old"))
        new = lookup_join(new.select("i", "key", "n"), _met(old, new), ["i", "key"], stored=False)
    else:
        new = new.withColumn("old", F.lit(None).cast("bigint"))
    before, now = F.coalesce(F.col("old"), F.lit(0)), F.coalesce(F.col("old"), F.lit(0)) + F.col("n")
    change = new.select("i", F.col("n").alias("known"), (
        (now == 1).cast("bigint") - (before == 1).cast("bigint")).alias("single"))
    totals.unionByName(change).groupBy("i").agg(
        F.sum("known").alias("known"), F.sum("single").alias("single")).coalesce(1).write.mode("overwrite").parquet(
        f"{path}/totals/batch_id={batch_id}")


def _met(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old keys that the batch has as well: as many as it has keys at most, stored."""
    return materialize(old.join(new.select("i", "key"), ["i", "key"], "left_semi"), "met-keys")


def _stored_keys(spark: SparkSession, path: str, through: int) -> DataFrame:
    return spark.read.schema(f"{_KEYS}, batch_id bigint").parquet(f"{path}/keys").where(F.col("batch_id") <= through)


def batch_results(spark: SparkSession, path: str, checks: Sequence[Check], through: int) -> DataFrame:
    """What ``run_checks`` says of all batches up to ``through``: ``check, constraint, metric, constraint_status``.

    Reads a row per constraint and batch, and for foreign keys the counted key values, which meet the
    parents as they are now. Keys meet as text, so both sides need types that print alike, as whole
    numbers of any width do.
    """
    ratios, uniques, parents = _numbered(checks)
    names = {i: (checks[t].name, c[0]) for i, t, c in [*ratios, *uniques, *parents]}
    holding = {i: holds for i, _, (_, _, holds) in ratios if holds is not _is_one}
    metrics = []
    if ratios:
        sums = spark.read.schema("i int, passed bigint, seen bigint, batch_id bigint").parquet(f"{path}/sums").where(
            F.col("batch_id") <= through)
        metrics.append(sums.groupBy("i").agg(F.try_divide(F.sum("passed"), F.sum("seen")).alias("metric")))
    if uniques:
        totals = spark.read.schema("i int, known bigint, single bigint").parquet(f"{path}/totals/batch_id={through}")
        metrics.append(totals.select("i", F.try_divide("single", "known").alias("metric")))
    if parents:
        # a batch of NULL keys alone still counts
        counts = _stored_keys(spark, path, through).where(F.col("i").isin([i for i, _, _ in parents])).groupBy(
            "i", "key").agg(F.sum("n").alias("n"))
        known = reduce(DataFrame.unionByName, [
            fk.parent.select(F.lit(i).alias("i"), _text(F.col(fk.parent_key)).alias("key")) for i, _, (_, fk) in parents])
        found = counts.join(known.where(F.col("key").isNotNull()).distinct().withColumn("found", F.lit(True)),
                            ["i", "key"], "left")
        none = spark.createDataFrame([(i, 0) for i, _, _ in parents], "i int, n bigint").withColumns(
            {"key": F.lit(None).cast("string"), "found": F.lit(None).cast("boolean")})
        metrics.append(found.unionByName(none).groupBy("i").agg(F.try_divide(
            F.sum(F.when(F.col("found"), F.col("n")).otherwise(0)), F.sum("n")).alias("metric")))
    return named_results(reduce(DataFrame.unionByName, metrics), [names[i] for i in range(len(names))], holding)
