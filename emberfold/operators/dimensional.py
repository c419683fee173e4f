"""Dimensions, facts and their keys."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, LongType, StructField, StructType

from emberfold.functions.scalars import (
    date_key, iso_weekday, row_digest, sunday_first_weekday, surrogate_key)
from emberfold.operators.joins import lookup_join
from emberfold.storage import materialize

# First and last day of the date dimension.
FIRST_DAY = date(37, 1, 1)
LAST_DAY = date(2023, 12, 31)

UNKNOWN_MEMBER = "unknown"


def dim_date(spark: SparkSession, first: date = FIRST_DAY, last: date = LAST_DAY,
             partitions: int | None = None) -> DataFrame:
    """One row per day from ``first`` to ``last``, generated in parallel."""
    days = (last - first).days + 1
    d = F.col("full_date")
    return (
        spark.range(0, days, 1, partitions)
        .select(F.date_add(
            F.to_date(F.lit(first.isoformat())), F.col("id").cast("int")).alias("full_date"))
        .select(
            date_key(F.dayofmonth(d), F.month(d), F.year(d)).alias("date_key"), d,
            F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"),
            F.quarter(d).alias("quarter"), iso_weekday(d).alias("weekday"),
            sunday_first_weekday(d).alias("weekday_sun1"), F.dayofyear(d).alias("day_of_year")))


def build_dimension(df: DataFrame, natural: Column, name: str, key: str,
                    attributes: Mapping[str, Column] | None = None,
                    narrow: bool = False) -> DataFrame:
    """One row per natural value: key, value, attributes.

    Rows that share a value but not their attributes collapse to the smallest
    set of attributes; :func:`attribute_conflicts` lists them. With 64-bit keys
    a NULL value becomes the unknown member; with narrow keys it stays NULL.
    """
    attributes = attributes or {}
    picked = df.select(natural.alias(name), *[c.alias(a) for a, c in attributes.items()])
    if attributes:
        members = picked.groupBy(name).agg(
            F.min(F.struct(*attributes)).alias("_a")).select(name, "_a.*")
    else:
        members = picked.distinct()
    label = F.col(name) if narrow else F.coalesce(F.col(name), F.lit(UNKNOWN_MEMBER))
    return members.select(
        surrogate_key(F.col(name), narrow=narrow).alias(key), label.alias(name), *attributes)


def attribute_conflicts(df: DataFrame, natural: Column, name: str,
                        attributes: Mapping[str, Column]) -> DataFrame:
    """Natural values that come with more than one set of attributes."""
    picked = df.select(natural.alias(name), *[c.alias(a) for a, c in attributes.items()])
    return (
        picked.distinct().groupBy(name).agg(F.count(F.lit(1)).alias("variants"))
        .where(F.col("variants") > 1))


def conformed_dimension(columns: Sequence[tuple[DataFrame, Column]], name: str, key: str,
                        narrow: bool = False) -> DataFrame:
    """Dimension over the values of one column from several tables."""
    values = reduce(DataFrame.union, [df.select(c.alias(name)) for df, c in columns])
    return build_dimension(values, F.col(name), name, key, narrow=narrow)


# Identical rows are numbered in blocks of this many.
NUMBERED_BLOCK = 100_000


def with_row_id(df: DataFrame, name: str, block: int = NUMBERED_BLOCK) -> DataFrame:
    """Add a text id that is unique per row and the same in every run.

    The id is a digest of the row; identical rows are counted first, which
    happens on the map side, and then numbered. Rows with very many copies come
    back in blocks that are spread over all tasks.
    """
    counted = materialize(
        df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n")), "row-counts")
    few = counted.where(F.col("_n") <= block).withColumn("_b", F.lit(0).cast("bigint"))
    many = counted.where(F.col("_n") > block).withColumn(
        "_b", F.explode(F.expr(f"sequence(0L, (_n - 1) div {block})")))
    spread = many.repartition(F.xxhash64(*df.columns, "_b"))
    numbered = few.unionByName(spread).withColumn("_i", F.explode(F.expr(
        f"sequence(_b * {block} + 1, least(_n, (_b + 1) * {block}))")))
    digest = row_digest(*[F.col(c) for c in df.columns], F.col("_i"))
    return numbered.select(digest.alias(name), *df.columns)


def build_fact(df: DataFrame, id_column: tuple[str, Column],
               day: Column, month: Column, year: Column,
               foreign_keys: Mapping[str, Column], measures: Mapping[str, Column],
               narrow: bool = False) -> DataFrame:
    """Fact rows: id, date key, one hash key per dimension, measures."""
    name, value = id_column
    return df.select(
        value.alias(name), date_key(day, month, year).alias("date_key"),
        *[surrogate_key(c, narrow=narrow).alias(k) for k, c in foreign_keys.items()],
        *[c.alias(m) for m, c in measures.items()])


# Rounds in which members look for a free key.
MAX_ATTEMPTS = 100


def narrow_key(name: Column, attempt: int) -> Column:
    """The 31-bit key of a member, and the further keys it tries if that is another's."""
    return surrogate_key(name, narrow=True) if attempt == 0 else surrogate_key(name, F.lit(attempt), narrow=True)


def assign_keys(members: DataFrame, name: str, key: str, key_of: Callable[[Column, int], Column] = narrow_key,
                taken: DataFrame | None = None) -> DataFrame:
    """``name``, ``key``, ``attempt``: one key per member, and no key twice.

    A member gets the first of its keys ``key_of(name, 0)``, ``key_of(name, 1)``, ... that is not ``taken`` (a table with the
    column ``key``); of members that ask for the same key in a round, the smallest name gets it. So the
    keys depend on the members alone. After the first round only the few that collided are looked at.
    """
    spark = members.sparkSession
    same = lambda a, b: a[name].eqNullSafe(b[name])
    left, done = members.select(name).distinct(), []
    for attempt in range(MAX_ATTEMPTS):
        asked = left.withColumn(key, key_of(F.col(name), attempt))
        first = asked.groupBy(key).agg(F.min(F.struct(name)).alias("_m")).select(f"_m.{name}", key)
        for other in [taken, *done]:
            if other is not None:
                first = first.join(other.select(key), key, "left_anti")
        first = materialize(first.select(name, key, F.lit(attempt).alias("attempt")), "assigned-keys")
        done.append(first)
        left = materialize(asked.join(first, same(asked, first), "left_anti").select(name), "colliding-members")
        if left.isEmpty():
            return reduce(DataFrame.unionByName, done)
    raise ValueError(f"{left.count()} members found no free key in {MAX_ATTEMPTS} attempts")


def with_member_key(fact: DataFrame, natural: str, key: str, assigned: DataFrame,
                    key_of: Callable[[Column, int], Column] = narrow_key) -> DataFrame:
    """Add the key that :func:`assign_keys` gave to the member ``natural`` names.

    The key is computed; only the few members that had to move are looked up, so the fact does not
    move for it. Members that were never assigned get their first key.
    """
    value = assigned.drop(key, "attempt").columns[0]
    moved = assigned.where("attempt > 0").select(F.col(value).alias(natural), F.col(key).alias("_moved"))
    joined = lookup_join(fact, moved, [natural], stored=False)
    return joined.withColumn(key, F.coalesce(F.col("_moved"), key_of(F.col(natural), 0))).select(*fact.columns, key)


def merge_members(spark: SparkSession, path: str, batch_id: int, members: DataFrame, name: str, key: str,
                  attributes: Sequence[str], key_of: Callable[[Column, int], Column] = narrow_key) -> None:
    """Bring the members of a batch into a stored dimension.

    ``members/batch_id=N`` below ``path`` gets those that are new, with keys that no stored one has; stored members keep
    theirs and are not written again. ``changes/batch_id=N`` gets the members whose attributes differ from the present
    ones, with the values before. Of a member that a batch has twice the smallest attributes count. A replayed
    batch starts from what the batches before left, and overwrites its own.
    """
    given = materialize(members.groupBy(name).agg(F.min(F.struct(*attributes)).alias("_a")), "given-members")
    present = None
    if batch_id > 0:
        present = dimension_members(spark, path, name, key, given.schema["_a"].dataType, members.schema[name].dataType,
                                    batch_id - 1)
        met = given.join(present, given[name].eqNullSafe(present[name]), "left").select(
            given[name], "_a", present[key].alias("_key"), present["_present"])
        met = materialize(met, "met-members")
        fresh = met.where(F.col("_key").isNull()).select(name, "_a")
        changed = met.where(F.col("_key").isNotNull() & ~F.col("_a").eqNullSafe(F.col("_present")))
    else:
        fresh, changed = given, given.limit(0).withColumns({"_key": F.lit(None).cast("bigint"), "_present": F.col("_a")})
    keys = assign_keys(fresh, name, key, key_of, present)
    keyed = fresh.join(keys, fresh[name].eqNullSafe(keys[name])).select(keys[key], fresh[name], "_a", "attempt")
    keyed.write.mode("overwrite").parquet(f"{path}/members/batch_id={batch_id}")
    changed.select(F.col("_key").alias(key), "_a", F.col("_present").alias("before")).write.mode("overwrite").parquet(
        f"{path}/changes/batch_id={batch_id}")


def dimension_members(spark: SparkSession, path: str, name: str, key: str, attributes: StructType, kind: DataType,
                      through: int) -> DataFrame:
    """``key``, ``name``, ``attempt`` and ``_present``, the attributes as of batch ``through``, from :func:`merge_members`."""
    batch = StructField("batch_id", LongType())
    fields = StructType([StructField(key, LongType()), StructField(name, kind), StructField("_a", attributes),
                         StructField("attempt", IntegerType()), batch])
    stored = spark.read.schema(fields).parquet(f"{path}/members").where(F.col("batch_id") <= through)
    changes = spark.read.schema(StructType([StructField(key, LongType()), StructField("_a", attributes), batch])).parquet(
        f"{path}/changes").where(F.col("batch_id") <= through)
    latest = changes.groupBy(key).agg(F.max_by("_a", "batch_id").alias("_new"))
    return stored.join(latest, key, "left").select(
        key, name, "attempt", F.coalesce(F.col("_new"), F.col("_a")).alias("_present"))
