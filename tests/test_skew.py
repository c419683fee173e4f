"""Hot keys, large lookups, layout: results must not depend on any of them."""

import random
from collections import Counter
from pathlib import Path

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from emberfold import storage
from emberfold.operators.joins import Lookup, lookup_join
from emberfold.operators.repair import (
    Box, bbox_label, bbox_range_join, box_table, box_tree, fill_from_lookup, group_modes, impute_group_mode, keep_first)


def bag(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows on one key, some without a key."""
    rng = random.Random(7)
    rows = [(i, None if i % 11 == 0 else 5 if i % 3 == 0 else rng.randrange(200),
             rng.choice(["x", "y", "z", None])) for i in range(3000)]
    return spark.createDataFrame(rows, "id int, k int, v string").repartition(7)


def test_lookup_join_paths_agree(spark, hot):
    right = spark.createDataFrame([(k, f"v{k}") for k in range(0, 200, 2)] + [(5, "hot")],
                                  "k int, label string")
    plain = bag(hot.join(right, "k", "left"))
    assert bag(lookup_join(hot, right, ["k"])) == plain
    for share in (0.5, 0.01, 0.001):
        assert bag(lookup_join(hot, right, ["k"], max_broadcast_rows=0, hot_share=share)) == plain


def test_group_mode_with_large_group_table(spark, hot):
    want = bag(impute_group_mode(hot, "k", ["v"]))
    assert bag(impute_group_mode(hot, "k", ["v"], max_broadcast_rows=0)) == want
    assert bag(impute_group_mode(hot.repartition(1), "k", ["v"])) == want


def test_group_modes_brute_force(hot):
    counts = {}
    for r in hot.collect():
        if r["k"] is not None:
            counts.setdefault(r["k"], Counter())[r["v"]] += 1
    want = {k: min(c.items(), key=lambda p: (-p[1], p[0] is None, p[0] or ""))[0]
            for k, c in counts.items()}
    assert {r["k"]: r["_mode_v"] for r in group_modes(hot, "k", ["v"]).collect()} == want


def test_keep_first_brute_force(hot):
    rows = sorted(hot.collect(), key=lambda r: r["id"])
    want = {}
    for r in rows:
        want.setdefault((r["k"], r["v"]), r["id"])
    got = {(r["k"], r["v"]): r["id"] for r in keep_first(hot, ["k", "v"], ["id"]).collect()}
    assert got == want


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(-3, 3), st.one_of(st.none(), st.integers(0, 9))),
                min_size=1, max_size=30),
       st.lists(st.tuples(st.integers(-3, 3), st.one_of(st.none(), st.integers(0, 9))),
                max_size=12))
def test_fill_keeps_rows_and_cells(spark, data, entries):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "i int, k int, v int")
    lookup = Lookup("k int, v int", ("k",), entries)
    last = dict(entries)
    got = fill_from_lookup(df, lookup, ["k"], ["v"]).orderBy("i").collect()
    assert [(r["i"], r["k"], r["v"]) for r in got] == [
        (i, k, last.get(k) if v is None else v) for i, (k, v) in enumerate(data)]


def test_box_forms_agree(spark):
    rng = random.Random(3)
    boxes = []
    for i in range(300):
        x, y = rng.randrange(-180, 170), rng.randrange(-90, 80)
        boxes.append(Box(x, x + rng.randrange(0, 60), y, y + rng.randrange(0, 30), f"b{i}"))
    points = [(i, float(rng.randrange(-185, 186)), rng.randrange(-950, 951) / 10, None)
              for i in range(2000)]
    df = spark.createDataFrame(points, "i int, x double, y double, p string")
    want = {}
    for i, x, y, _ in points:
        want[i] = next((b.label for b in boxes if b.lon_from <= x <= b.lon_to
                        and b.lat_from <= y <= b.lat_to), None)
    for most in (16, 32, 1000):
        got = bbox_range_join(df, "x", "y", boxes, "p", cell_boxes=most)
        assert {r["i"]: r["p"] for r in got.collect()} == want
    few = boxes[:40]
    plain = bag(bbox_label(df, "x", "y", few, "p"))
    assert plain == bag(bbox_range_join(df, "x", "y", few, "p"))
    assert plain == bag(bbox_range_join(df, "x", "y", few, "p", few_boxes=0))


def test_odd_boxes(spark):
    """No bounds, bounds the wrong way around, points without extent, endless boxes, equal ranks, no boxes."""
    inf, nan = float("inf"), float("nan")
    rows = [(3, -inf, inf, 0.0, inf, "north"), (2, 1.0, 1.0, 1.0, 1.0, "dot"), (1, 5.0, 4.0, 0.0, 9.0, "none"),
            (1, None, 4.0, 0.0, 9.0, "none"), (1, nan, 4.0, 0.0, 9.0, "none"), (4, 0.0, 2.0, -1.0, 1.0, "b"),
            (4, 0.0, 2.0, -1.0, 1.0, "a"), (2, 7.0, 8.0, 1.0, 2.0, None)]
    table = spark.createDataFrame(
        rows, "rank int, lon_from double, lon_to double, lat_from double, lat_to double, label string")
    points = [(1.0, 1.0, None), (1.0, 0.0, None), (1.0, -0.5, None), (-1e300, 7.0, None), (3.0, -1.0, None),
              (None, 1.0, None), (nan, 1.0, None), (1.0, 1.0, "kept"), (7.5, 1.5, None)]
    df = spark.createDataFrame(points, "x double, y double, p string")
    want = ["dot", "north", "a", "north", None, None, None, "kept", None]
    for most in (3, 32):
        got = bbox_range_join(df, "x", "y", table, "p", cell_boxes=most).collect()
        assert [r["p"] for r in sorted(got, key=lambda r: [str(c) for c in points].index(str(tuple(
            [r["x"], r["y"], "kept" if r["p"] == "kept" else None]))))] == want
    assert bag(bbox_range_join(df.where("x < 5"), "x", "y", table.limit(0), "p")) == bag(df.where("x < 5"))


def test_dense_boxes_stay_few_per_cell(spark):
    """Small boxes in one place, copies of one box, a common corner, wide boxes: a point meets few of them."""
    rng = random.Random(8)
    boxes = [Box(x, x + 0.01, y, y + 0.01, f"s{n}") for n, (x, y) in enumerate(
        (10 + 5 * rng.random(), 40 + 5 * rng.random()) for _ in range(4000))]
    boxes += [Box(12, 12.5, 42, 42.5, f"copy{n}") for n in range(500)]
    boxes += [Box(11, 11 + n / 100, 41, 41 + n / 90, f"corner{n}") for n in range(1, 400)]
    boxes += [Box(10, 15, 40 + n / 60, 40 + n / 60 + 0.5, f"wide{n}") for n in range(200)]
    boxes += [Box(-180, 180, -90, 90, f"world{n}") for n in range(300)]
    rng.shuffle(boxes)
    tree = box_tree(box_table(spark, boxes), 32)
    largest, rows = tree.leaves.agg(F.max(F.size("_boxes")), F.sum(F.size("_boxes"))).first()
    assert largest <= 32 and rows < 20 * len(boxes)
    points = [(n, 9.9 + 5.2 * rng.random(), 39.9 + 5.2 * rng.random(), None) for n in range(400)]
    df = spark.createDataFrame(points, "i int, x double, y double, p string")
    want = {n: next(b.label for b in boxes if b.lon_from <= x <= b.lon_to and b.lat_from <= y <= b.lat_to)
            for n, x, y, _ in points}
    for most in (1_000_000, 0):
        got = bbox_range_join(df, "x", "y", boxes, "p", max_broadcast_rows=most)
        assert {r["i"]: r["p"] for r in got.collect()} == want


def test_long_row_lists_join_like_tables(spark):
    lookup = Lookup("k int, v int", ("k",), [(i, i) for i in range(20_001)] + [(5, -5)])
    df = spark.createDataFrame([(5, None), (20_000, None), (20_001, None), (None, 1)], "k int, v int")
    assert bag(fill_from_lookup(df, lookup, ["k"], ["v"])) == Counter(
        [(5, -5), (20_000, 20_000), (20_001, None), (None, 1)])


def test_repeated_keys_of_tables_keep_the_last(spark, hot, monkeypatch):
    from emberfold.operators import joins
    rows = [(k, n, f"{n}-{k}") for k in range(0, 200, 3) for n in range(3)] + [(5, 9, "hot")]
    right = spark.createDataFrame(rows, "k int, n int, v string")
    last = {k: v for k, n, v in sorted(rows, key=lambda r: r[1])}
    want = Counter((r["id"], r["k"], r["v"] or last.get(r["k"])) for r in hot.collect())
    for most in (1_000_000, 0):
        monkeypatch.setattr(joins.lookup_join, "__defaults__", (most, *joins.lookup_join.__defaults__[1:]))
        assert bag(fill_from_lookup(hot, right, ["k"], ["v"], last_by=["n"])) == want


def test_many_boxes_and_world_wide_ones(spark):
    rng = random.Random(5)
    boxes = [Box(x, x + 0.4, y, y + 0.3, f"b{n}") for n, (x, y) in enumerate(
        (rng.uniform(-180, 179), rng.uniform(-90, 89)) for _ in range(20_500))]
    boxes.insert(15_000, Box(-180, 180, -90, 90, "world"))
    points = [(n, rng.uniform(-180, 180), rng.uniform(-90, 90), None) for n in range(300)]
    df = spark.createDataFrame(points, "i int, x double, y double, p string")
    want = {n: next(b.label for b in boxes if b.lon_from <= x <= b.lon_to and b.lat_from <= y <= b.lat_to)
            for n, x, y, _ in points}
    for most in (1_000_000, 0):
        got = bbox_range_join(df, "x", "y", boxes, "p", max_broadcast_rows=most)
        assert {r["i"]: r["p"] for r in got.collect()} == want


def test_group_mode_of_numbers(spark):
    df = spark.createDataFrame([(1, 9), (1, 10), (1, None), (2, None), (2, None), (2, 3)], "v int, n int")
    assert bag(impute_group_mode(df, "v", ["n"])) == Counter(
        [(1, 9), (1, 10), (1, 9), (2, None), (2, None), (2, 3)])


def test_sizes_are_counted(spark):
    from emberfold.operators import joins
    wide = spark.range(10).select("id", F.repeat(F.lit("x"), 1000).alias("t"))
    assert joins.fits_broadcast(wide, 10) and not joins.fits_broadcast(wide, 9)
    old = joins.MAX_BROADCAST_BYTES
    try:
        joins.MAX_BROADCAST_BYTES = 9_000
        assert not joins.fits_broadcast(wide, 10)
    finally:
        joins.MAX_BROADCAST_BYTES = old


def test_keep_first_forms_agree(spark):
    rows = [(i % 7, None if i % 5 == 0 else i % 3, i) for i in range(200)] + [(None, 1, 1), (None, 0, 2)]
    df = spark.createDataFrame(rows, "k int, v int, id int")
    for subset, order in ((["k"], ["v", "id"]), (["k", "v"], ["id"]), (["k", "v", "id"], [])):
        assert bag(keep_first(df, subset, order)) == bag(keep_first(df, subset, order, few_copies=True))


def test_release_deletes_what_was_stored(spark, monkeypatch):
    monkeypatch.setattr(storage, "_STORED", [])
    stored = storage.materialize(spark.range(10), "t-release")
    path = stored.inputFiles()[0]
    assert stored.count() == 10 and storage.release(spark) == 1 and storage.release(spark) == 0
    assert not Path(path.removeprefix("file://")).exists()
