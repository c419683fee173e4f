"""Left joins against tables with one row per key, safe for hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from emberfold.storage import materialize

# A lookup written in code is broadcast up to this many rows, and joined like a table beyond.
MAX_INLINE_ROWS = 20_000
# A table is broadcast only if its counted rows and bytes stay below these.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# A key is hot if it holds more than this share of the rows, so there are
# never more than 1 / HOT_SHARE hot keys.
HOT_SHARE = 0.001

_ARROW_TYPES = {
    "boolean": pa.bool_(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64(),
    "float": pa.float32(), "double": pa.float64(), "string": pa.string(), "date": pa.date32(),
}


@dataclass(frozen=True)
class Lookup:
    """A lookup table given as rows. ``keys`` name the leading columns.

    A key that is listed twice keeps its last row, so a join never fans out.
    """

    schema: str
    keys: tuple[str, ...]
    rows: Sequence[tuple]

    @property
    def fields(self) -> list[tuple[str, str]]:
        return [tuple(part.strip().rsplit(" ", 1)) for part in self.schema.split(",")]

    @property
    def values(self) -> list[str]:
        return [name for name, _ in self.fields if name not in self.keys]

    def unique_rows(self) -> list[tuple]:
        width = len(self.keys)
        return list({row[:width]: row for row in self.rows}.values())

    def to_df(self, spark: SparkSession) -> DataFrame:
        fields = self.fields
        rows = self.unique_rows()
        columns = [
            pa.array([row[i] for row in rows], _ARROW_TYPES[kind])
            for i, (_, kind) in enumerate(fields)
        ]
        return spark.createDataFrame(pa.table(columns, names=[name for name, _ in fields]))


def fits_broadcast(table: DataFrame, max_rows: int) -> bool:
    """Whether the counted rows and bytes of a table allow a broadcast."""
    width = F.lit(16 * len(table.columns)).cast("bigint")
    for field in table.schema.fields:
        if isinstance(field.dataType, (StringType, BinaryType)):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
    rows, size = table.agg(F.count(F.lit(1)), F.sum(width)).first()
    return rows <= max_rows and (size or 0) <= MAX_BROADCAST_BYTES


def _all_present(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def lookup_join(left: DataFrame, right: DataFrame, on: Sequence[str],
                max_broadcast_rows: int = MAX_BROADCAST_ROWS,
                hot_share: float = HOT_SHARE, stored: bool = True,
                keys: DataFrame | None = None) -> DataFrame:
    """Left join to a table that has one row per key; keeps every left row once.

    The size of ``right`` is counted first. Small enough, it is broadcast and
    ``left`` is not shuffled at all. Otherwise the join shuffles, except for rows
    whose key is NULL or hot: those meet a broadcast of the hot keys' rows, at
    most ``1 / hot_share`` of them. The result reads ``left`` once; its keys are counted
    before, in ``keys`` if given (cheaper rows with the same keys). If ``right`` is not
    a stored table, say so with ``stored=False``.
    """
    on = list(on)
    if fits_broadcast(right, max_broadcast_rows):
        return left.join(F.broadcast(right), on, "left")

    if not stored:
        right = materialize(right, "lookup-rows")
    values = [c for c in right.columns if c not in on]
    present = (left if keys is None else keys).select(*on).where(_all_present(on))
    total = present.count()
    hot_keys = present.groupBy(*on).count().where(F.col("count") > hot_share * total).select(*on)
    hot_rows = materialize(
        right.join(F.broadcast(materialize(hot_keys, "hot-keys")), on, "left_semi").select(
            *on, F.struct(F.lit(True).alias("_is"), *values).alias("_hot")), "hot-rows")
    # rows that need no partner from the shuffle get a place of their own there, and find none
    marked = left.join(F.broadcast(hot_rows), on, "left")
    aside = F.col("_hot").isNotNull() | ~_all_present(on)
    hashed = [f.name for f in left.schema.fields if "map" not in f.dataType.simpleString()]
    spread = F.when(aside, F.pmod(F.xxhash64(*hashed), F.lit(1000)) + 1).otherwise(0)
    joined = marked.withColumn("_place", spread.cast("int")).join(
        right.withColumn("_place", F.lit(0)), [*on, "_place"], "left")
    rest = [c for c in left.columns if c not in on]
    return joined.select(*on, *rest, *[
        F.when(F.col("_hot._is"), F.col("_hot")[c]).otherwise(F.col(c)).alias(c) for c in values])


def one_row_per_key(table: DataFrame, on: Sequence[str], last_by: Sequence[str] = ()) -> DataFrame:
    """The last row of each key by ``last_by``, then by the other columns; NULLs come first."""
    values = [c for c in table.columns if c not in on]
    if not values:
        return table.distinct()
    order = [*last_by, *[c for c in values if c not in last_by]]
    picked = table.groupBy(*on).agg(F.max(F.struct(*order)).alias("_last"))
    return picked.select(*on, *[F.col("_last")[c].alias(c) for c in values])


def join_any_lookup(left: DataFrame, lookup: Lookup | DataFrame, on: Sequence[str],
                    prefix: str, last_by: Sequence[str] = ()) -> DataFrame:
    """Left join with the lookup's value columns renamed to ``prefix + name``.

    Adds ``prefix + "hit"``, which is true where the key was found. Of a key that a
    table lists twice, the last row by ``last_by`` counts, so rows never multiply.
    """
    inline = isinstance(lookup, Lookup) and len(lookup.rows) <= MAX_INLINE_ROWS
    table = lookup.to_df(left.sparkSession) if isinstance(lookup, Lookup) else one_row_per_key(
        lookup, on, last_by)
    renamed = table.select(
        *on, *[F.col(c).alias(prefix + c) for c in table.columns if c not in on],
        F.lit(True).alias(prefix + "hit"))
    if inline:
        return left.join(F.broadcast(renamed), list(on), "left")
    return lookup_join(left, renamed, on, stored=False)
