"""Row repair: overrides, fills, geographic labels, group modes, duplicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emberfold.operators.joins import (
    MAX_BROADCAST_ROWS, Lookup, join_any_lookup, lookup_join)
from emberfold.storage import materialize


def override_by_key(df: DataFrame, lookup: Lookup | DataFrame, on: Sequence[str],
                    columns: Sequence[str], last_by: Sequence[str] = ()) -> DataFrame:
    """Replace ``columns`` wherever the key is listed, whatever they hold."""
    joined = join_any_lookup(df, lookup, on, "_lk_", last_by)
    replaced = {
        c: F.when(F.col("_lk_hit"), F.col("_lk_" + c)).otherwise(F.col(c)) for c in columns}
    return joined.withColumns(replaced).select(*df.columns)


def fill_from_lookup(df: DataFrame, lookup: Lookup | DataFrame, on: Sequence[str],
                     columns: Sequence[str], last_by: Sequence[str] = ()) -> DataFrame:
    """Fill NULLs of each column on its own; other cells and the row count stay.

    A key that is listed twice keeps its last entry, in a table the last by ``last_by``.
    """
    joined = join_any_lookup(df, lookup, on, "_lk_", last_by)
    filled = {c: F.coalesce(F.col(c), F.col("_lk_" + c)) for c in columns}
    return joined.withColumns(filled).select(*df.columns)


class Box(NamedTuple):
    """A longitude/latitude box with its label; the edges belong to it."""

    lon_from: float
    lon_to: float
    lat_from: float
    lat_to: float
    label: str


def bbox_label(df: DataFrame, lon: str, lat: str, boxes: Sequence[Box], target: str) -> DataFrame:
    """Fill a NULL ``target`` with the label of the first box around the point.

    One CASE expression over all boxes: for a handful of them.
    """
    x, y = F.col(lon).cast("double"), F.col(lat).cast("double")
    inside = [
        F.when(x.between(float(b.lon_from), float(b.lon_to))
               & y.between(float(b.lat_from), float(b.lat_to)), F.lit(b.label)) for b in boxes]
    return df.withColumn(target, F.coalesce(F.col(target), *inside))


def box_table(spark: SparkSession, boxes: Sequence[Box]) -> DataFrame:
    """Boxes as rows, ``rank`` giving their priority."""
    columns = list(zip(*boxes)) or [()] * len(Box._fields)
    return spark.createDataFrame(pa.table({
        **{f: pa.array([float(v) for v in c], pa.float64())
           for f, c in zip(Box._fields[:4], columns)},
        "label": pa.array(columns[4], pa.string()),
        "rank": pa.array(range(len(boxes)), pa.int64())}))


# Up to so many boxes given in code, one CASE over all of them is the quicker plan. With more, the method that
# Spark generates around it soon passes the 8,000 bytes beyond which the JVM does not compile one.
FEW_BOXES = 8
# A cell of the tree is split while it holds more boxes than this.
CELL_BOXES = 64
# A cell is split into 8 x 8; a double tells no finer cells apart.
_FINER, _MAX_DEPTH = 8, 16
_AXES = (("_cx", "lon_from", "lon_to"), ("_cy", "lat_from", "lat_to"))
_CELL = ["_cx", "_cy"]


class _Frame(NamedTuple):
    """Origin and extent of the tree on both axes; what lies outside belongs to the cells at the edge."""

    origin: dict[str, float]
    extent: dict[str, float]

    def cell(self, axis: str, value: Column, depth: int) -> Column:
        """Number of the cell; never falls as the value rises, and is that of the cell around it, times 8 and more."""
        share = (value - self.origin[axis]) / self.extent[axis]
        return F.floor(F.least(F.lit(1.0), F.greatest(F.lit(0.0), share)) * float(_FINER ** depth))


class BoxTree(NamedTuple):
    """Cells of a plane with the boxes in them.

    ``leaves`` has ``_depth, _cx, _cy, _boxes``, the boxes in order of priority; ``split[k]`` has the cells
    that were split at depth ``first + k``.
    """

    frame: _Frame
    first: int
    split: list[DataFrame]
    leaves: DataFrame


def box_tree(boxes: DataFrame, most: int = CELL_BOXES) -> BoxTree:
    """Cells that are split by count, until none holds more than ``most`` boxes.

    Each box of a cell is seen as its part within the cell. Of boxes with the same part only the first by rank
    stays, and once a cell that is split has a box all over it, only those before it go on. So equal
    boxes, a common corner and wide boxes over small ones do not fill the cells. Only boxes of
    cells that are too full are dealt again, one round per depth. Boxes without a bound or
    with bounds the wrong way around hold nothing.
    """
    inside = F.lit(True)
    for _, low, high in _AXES:
        inside = inside & (F.col(low) <= F.col(high)) & ~F.isnan(low) & ~F.isnan(high)
    box = F.struct("rank", *[F.col(f).cast("double").alias(f) for f in Box._fields[:4]], "label").alias("_box")
    rows = boxes.where(F.coalesce(inside, F.lit(False))).select(box)
    finite = lambda c: F.when(F.abs(c) < float("inf"), c)
    bounds = rows.agg(F.count(F.lit(1)).alias("n"), *[
        pick(finite(F.col("_box")[f])).alias(f"{name}_{f}") for f in Box._fields[:4]
        for name, pick in (("min", F.min), ("max", F.max))]).first()
    origin, extent = {}, {}
    for axis, low, high in _AXES:
        known = [v for v in (bounds[f"{m}_{f}"] for m in ("min", "max") for f in (low, high)) if v is not None]
        origin[axis] = min(known, default=0.0)
        extent[axis] = (max(known, default=0.0) - origin[axis]) or 1.0
    frame = _Frame(origin, extent)

    def dealt(held: DataFrame, depth: int) -> DataFrame:
        """Each box in the cells it meets, within the cell of the depth before if there is one."""
        within = set(_CELL) <= set(held.columns)
        for axis, low, high in _AXES:
            least, last = (frame.cell(axis, F.col("_box")[f], depth) for f in (low, high))
            if within:
                least = F.greatest(least, F.col(axis) * _FINER)
                last = F.least(last, F.col(axis) * _FINER + (_FINER - 1))
            held = held.withColumn(axis, F.explode(F.sequence(least, last)))
        # a bound that lies in another cell does not show in this one
        part = [F.when(frame.cell(axis, F.col("_box")[f], depth) == F.col(axis), F.col("_box")[f]).alias(f)
                for axis, low, high in _AXES for f in (low, high)]
        return materialize(held.groupBy(*_CELL, *part).agg(F.min("_box").alias("_box")), "box-parts")

    first = depth = 1 if bounds["n"] > most else 0
    held, split, leaves = dealt(rows, depth), [], []
    all_over = F.lit(True)
    for f in Box._fields[:4]:
        all_over = all_over & F.col(f).isNull()
    while True:
        cells = held.groupBy(*_CELL).agg(
            F.count(F.lit(1)).alias("_n"), F.min(F.when(all_over, F.col("_box"))).alias("_cover"))
        full = cells.where(F.col("_n") > most).drop("_n").withColumn("_full", F.lit(True))
        if depth == _MAX_DEPTH or full.isEmpty():
            leaves.append(held.select(F.lit(depth).alias("_depth"), *_CELL, "_box"))
            break
        full = materialize(full, "full-cells")
        marked = lookup_join(held.select(*_CELL, "_box"), full, _CELL)
        leaves.append(marked.where(F.col("_full").isNull()).select(F.lit(depth).alias("_depth"), *_CELL, "_box"))
        split.append(full.select(*_CELL, "_full"))
        depth += 1
        held = dealt(marked.where(F.col("_full") & (
            F.col("_cover").isNull() | (F.col("_box") <= F.col("_cover")))).select(*_CELL, "_box"), depth)
    grid = reduce(DataFrame.unionByName, leaves).groupBy("_depth", *_CELL).agg(
        F.array_sort(F.collect_list("_box")).alias("_boxes"))
    return BoxTree(frame, first, split, materialize(grid, "box-leaves"))


def bbox_range_join(df: DataFrame, lon: str, lat: str, boxes: Sequence[Box] | DataFrame,
                    target: str, cell_boxes: int = CELL_BOXES, few_boxes: int = FEW_BOXES,
                    max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Same result as :func:`bbox_label`, for many boxes, also as a table.

    ``boxes`` as a table has the fields of :class:`Box` and ``rank``, smaller ranks first; of equal ranks the smaller
    bounds, then the smaller label. The boxes lie in a tree of cells, see :func:`box_tree`. A point finds the depth of
    its cell by the cells that were split, and then meets the boxes of that one cell. Each
    lookup is a broadcast if the counted cells allow it and a shuffle otherwise.
    """
    if not isinstance(boxes, DataFrame):
        if len(boxes) <= few_boxes:
            return bbox_label(df, lon, lat, boxes, target)
        boxes = box_table(df.sparkSession, boxes)
    tree = box_tree(boxes, cell_boxes)
    x, y = F.col(lon).cast("double"), F.col(lat).cast("double")
    wanted = F.col(target).isNull()  # rows that keep their label need no cell

    def at(depth: int) -> list[Column]:
        return [F.when(wanted, tree.frame.cell(axis, value, depth)) for axis, value in (("_cx", x), ("_cy", y))]

    located = df.withColumn("_depth", F.lit(tree.first))
    for k, split in enumerate(tree.split):
        keyed = located.withColumns(dict(zip(_CELL, at(tree.first + k))))
        # a cell within one that was not split was not split either
        located = lookup_join(keyed, split, _CELL, max_broadcast_rows).withColumn(
            "_depth", F.col("_depth") + F.when(F.col("_full"), 1).otherwise(0)).drop(*_CELL, "_full")
    deepest = tree.first + len(tree.split)
    cell_of = [F.get(F.array(*c), F.col("_depth") - tree.first)
               for c in zip(*[at(d) for d in range(tree.first, deepest + 1)])]
    joined = lookup_join(located.withColumns(dict(zip(_CELL, cell_of))), tree.leaves, ["_depth", *_CELL],
                         max_broadcast_rows)
    best = F.get(F.filter("_boxes", lambda b: x.between(b["lon_from"], b["lon_to"])
                          & y.between(b["lat_from"], b["lat_to"])), 0)["label"]
    return joined.withColumn(target, F.coalesce(F.col(target), best)).select(*df.columns)


def group_modes(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """Most frequent value of each column per group, one row per group.

    NULL is a candidate like any value. Ties go to the smallest value, NULL
    last. All columns are counted in one pass; both steps combine on the map
    side, so a group with a large share of the rows shrinks before it moves.
    """
    value = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(columns)])
    kinds = [df.schema[c].dataType for c in columns]
    only = lambda i: F.struct(*[  # noqa: E731  one column's value, NULL for the others
        (F.col("_value")[f"v{k}"] if k == i else F.lit(None).cast(kind)).alias(f"v{k}")
        for k, kind in enumerate(kinds)])
    cells = df.where(F.col(group).isNotNull()).select(
        F.col(group).alias("_group"), value.alias("_value")).select("_group", F.explode(F.array(*[
            F.struct(F.lit(i).alias("i"), only(i).alias("v")) for i in range(len(columns))])).alias("_cell"))
    counts = cells.groupBy("_group", F.col("_cell.i").alias("_i"), F.col("_cell.v").alias("_v")).agg(
        F.count(F.lit(1)).alias("_n"))
    rank = lambda i: F.when(F.col("_i") == i, F.struct(
        -F.col("_n"), F.col("_v")[f"v{i}"].isNull(), F.col("_v")[f"v{i}"]))
    return counts.groupBy(F.col("_group").alias(group)).agg(*[
        F.min_by(F.col("_v")[f"v{i}"], rank(i)).alias("_mode_" + c) for i, c in enumerate(columns)])


def impute_group_mode(df: DataFrame, group: str, columns: Sequence[str], default: str = "unknown",
                      max_broadcast_rows: int = MAX_BROADCAST_ROWS, is_stored: bool = False) -> DataFrame:
    """Fill NULLs with the group's most frequent value.

    Where NULL itself is the most frequent, the fill is ``default`` (NULL if the
    column's type cannot hold it). Rows without a group stay as they are. ``df`` is
    stored first, as it is read for the modes and again for the fill; say ``is_stored`` if it is
    a stored table already.
    """
    stored = df if is_stored else materialize(df, "mode-rows")
    modes = materialize(group_modes(stored, group, columns), "group-modes")
    joined = lookup_join(stored, modes, [group], max_broadcast_rows)
    known = F.col(group).isNotNull()
    filled = {
        c: F.coalesce(F.col(c), F.when(known, F.coalesce(
            F.col("_mode_" + c), F.lit(default).try_cast(df.schema[c].dataType)))) for c in columns}
    return joined.withColumns(filled).select(*df.columns)


def keep_first(df: DataFrame, subset: Sequence[str], order_by: Sequence[str],
               few_copies: bool = False) -> DataFrame:
    """One row per value of ``subset``: the first by ``order_by``, NULLs last.

    An aggregate and not a window, so copies of a hot value are dropped on the
    map side. ``order_by`` has to tell rows of a group apart for a stable pick.
    The rows are the same with ``few_copies``, which ranks them in a window: quicker where
    copies are known to be rare, slower where one value holds many rows.
    """
    rest = [c for c in df.columns if c not in subset]
    if few_copies:
        ranked = df.withColumn("_place", F.row_number().over(Window.partitionBy(*subset).orderBy(
            *[F.col(c).asc_nulls_last() for c in order_by or subset])))
        return ranked.where(F.col("_place") == 1).select(*df.columns)
    if not rest:
        return df.distinct()
    if rest == list(order_by) and len(rest) == 1:
        picked = df.groupBy(*subset).agg(F.min(rest[0]).alias(rest[0]))
        return picked.select(*df.columns)
    order = [part for c in order_by for part in (F.col(c).isNull().alias("no_" + c), F.col(c))]
    if sorted(rest) == sorted(order_by):
        first = F.min(F.struct(*order))
    else:
        first = F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*order))
    picked = df.groupBy(*subset).agg(first.alias("_row"))
    return picked.select(*[
        F.col("_row")[c].alias(c) if c in rest else F.col(c) for c in df.columns])
