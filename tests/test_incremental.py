"""What is kept up to date by batches: the same as over the whole, after replays too, and no more is touched."""

import os
import random
import subprocess
import sys
import tempfile
from collections import Counter
from datetime import date, datetime, timedelta
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from emberfold import storage
from emberfold.operators import dimensional
from emberfold.operators.carry import carried_codes
from emberfold.operators.dimensional import (
    assign_keys, dimension_members, merge_members, narrow_key, with_member_key)
from emberfold.operators.incremental import append_batch, batch_results
from emberfold.operators.learn import exact_split
from emberfold.operators.quality import Check, ForeignKey, run_checks
from emberfold.sources.parts import PartTable
from emberfold.sources.tables import publish_set, read_set
from emberfold.storage import delete_folder, folder_names, scratch_path
from emberfold.streaming import weather as w
from emberfold.streaming.packing import pack_batches, packs, read_batches


def bag(df):
    return Counter(map(tuple, df.collect()))


def test_parts_are_replaced_alone(spark):
    table = PartTable(scratch_path(spark, "t-parts"), "p")
    rows = lambda batch, parts: spark.createDataFrame([(batch, p) for p in parts], "v int, p int")
    schema, index = rows(0, [0]).schema, {}
    assert table.index(spark) == {} and table.read(spark, schema, {}).count() == 0
    for batch, parts in enumerate(([0, 1, 2], [1], [1, 3], [1])):
        index = table.write(rows(batch, parts), batch, index, map(str, parts))
        assert table.index(spark) == index
    assert index == {"0": 0, "1": 3, "2": 0, "3": 2}
    assert bag(table.read(spark, schema, index)) == Counter([(0, 0), (0, 2), (3, 1), (2, 3)])
    assert bag(table.read(spark, schema, index, ["3", "9"])) == Counter([(2, 3)])
    # versions that neither of the last two batches refers to are gone
    assert "p=1" not in folder_names(spark, f"{table.path}/rows/version=0")
    assert "p=1" not in folder_names(spark, f"{table.path}/rows/version=1")
    # a part that ends without rows leaves the index
    assert "0" not in table.write(rows(4, [1]).limit(0), 4, index, ["0"])


def daily(spark, rows):
    return spark.createDataFrame([(s, date(2024, 7, d), 15.0 + d, 40.0, 9.0, float(d % 3)) for s, d in rows],
                                 "st string, day date, temperature double, rh double, ws double, rain double")


def test_silent_stations_are_not_rewritten(spark):
    out = scratch_path(spark, "t-buckets")
    sink = w.carry_sink(f"{out}/codes", f"{out}/state", "st", buckets=8)
    stations = [f"s{n}" for n in range(20)]
    batches = [[(s, 1) for s in stations], [("s3", 2), ("s4", 2)], [("s3", 3)], [(s, 4) for s in stations]]
    state = PartTable(f"{out}/state", "bucket")
    for batch_id, rows in enumerate(batches):
        sink(daily(spark, rows), batch_id)
        sink(daily(spark, rows).repartition(3), batch_id)
        if batch_id == 2:
            versions = Counter(state.index(spark).values())
            assert versions[2] == 1 and versions[0] >= 5
            assert len(folder_names(spark, f"{out}/state/rows/version=2")) <= 3  # one part and the marks of the write
    want = carried_codes(daily(spark, [r for rows in batches for r in rows]), "st")
    assert bag(spark.read.parquet(f"{out}/codes").select(want.columns)) == bag(want)


def test_windows_keep_every_row(spark):
    out, start = scratch_path(spark, "t-windows"), datetime(2024, 3, 1)
    rng = random.Random(2)
    rows = [(n, None if n % 40 == 0 else start + timedelta(hours=rng.uniform(0, 12) + 12 * (n // 100)),
             rng.choice("ab"), n) for n in range(600)]
    rows += [(1000 + n, start + timedelta(hours=n), "a", 1) for n in range(5)]  # long behind the others
    frame = spark.createDataFrame(rows, "id int, ts timestamp, kind string, v int")
    measures = {"n": w.Measure(F.count(F.lit(1)), F.sum), "top": w.Measure(F.max("v"), F.max)}
    sink = w.window_sink(out, "ts", "kind", "6 hours", measures, late="10 hours")
    for batch, (a, b) in enumerate([(0, 100), (100, 300), (300, 600), (1000, 1005)]):
        for _ in range(2):
            sink(frame.where((F.col("id") >= a) & (F.col("id") < b)), batch)
    schema = spark.createDataFrame([], "window_start timestamp, window_end timestamp, kind string, n bigint, top int, day string").schema
    windows = w.stored_windows(spark, out, schema)
    late = spark.read.parquet(f"{out}/late")
    assert windows.agg(F.sum("n")).first()[0] + late.count() == len(rows)
    assert late.where("id >= 1000").count() == 5 and late.where("ts IS NULL").count() == 15
    assert w.window_progress(spark, out).where("batch_id = 3").first()["n_late"] == late.count()
    kept = frame.join(late.select("id"), "id", "left_anti")
    want = kept.groupBy(F.window("ts", "6 hours").alias("w"), "kind").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("top"))
    assert bag(windows.drop("day")) == bag(want.select("w.start", "w.end", "kind", "n", "top"))
    # the last batch changed no day, so no file is its own; one day alone is read from its own folder
    assert not [n for n in folder_names(spark, f"{out}/windows/rows/version=3") if n.startswith("day=")]
    one = w.stored_windows(spark, out, schema, ["2024-03-01"])
    assert one.inputFiles() and all("day=2024-03-01" in f for f in one.inputFiles())


def test_packed_batches(spark):
    path = scratch_path(spark, "t-packed")
    write = lambda b: spark.range(b * 10, b * 10 + 10, 1, 4).write.mode("overwrite").parquet(f"{path}/batch_id={b}")
    with pytest.raises(ValueError):
        read_batches(spark, path)
    assert pack_batches(spark, path) is None
    for b in range(23):
        write(b)
        if b % 5 == 4:
            pack_batches(spark, path)
    # all but what came since the last run, and its newest batch, is one file
    want = Counter((n, n // 10) for n in range(230))
    assert bag(read_batches(spark, path)) == want
    assert [p[:2] for p in packs(spark, path)] == [(0, 18)]
    assert len(read_batches(spark, path).inputFiles()) <= 1 + 4 * 4
    # a packed batch that is replayed, even with other rows, changes nothing
    spark.range(5).write.mode("overwrite").parquet(f"{path}/batch_id=3")
    assert bag(read_batches(spark, path)) == want
    # an unfinished pack is not read, and made anew
    spark.range(5).withColumn("batch_id", F.lit(0)).write.parquet(f"{path}-packs/0-20")
    delete_folder(spark, f"{path}-packs/0-20/_SUCCESS")
    assert bag(read_batches(spark, path)) == want
    assert pack_batches(spark, path)[:2] == (0, 21)
    assert pack_batches(spark, path) is None and bag(read_batches(spark, path)) == want
    assert [n for n in folder_names(spark, path) if "batch" in n] == ["batch_id=22"]
    # a full pack stays as it is and the next begins
    write(23)
    assert pack_batches(spark, path, target_bytes=10)[:2] == (22, 22)
    assert [p[:2] for p in packs(spark, path)] == [(0, 21), (22, 22)]
    assert bag(read_batches(spark, path)) == want + Counter((n, 23) for n in range(230, 240))


def test_measured_batches_add_up(spark, monkeypatch):
    rng, path = random.Random(4), scratch_path(spark, "t-measures")
    parent = spark.createDataFrame([(n,) for n in range(0, 40, 2)], "id int")
    rows = [(rng.choice([None, *range(60)]), rng.choice([None, "x", *map(str, range(300))]), rng.choice([None, 1.5, 2.5]))
            for _ in range(400)]
    check = lambda: (Check("t").is_complete("k").has_completeness("v", lambda m: m > 0.2).satisfies("v > 2", "large")
                     .is_unique("name", "k").has_parent("known", ForeignKey("k", parent, "id")))
    frame = lambda some: spark.createDataFrame(some, "k bigint, name string, v double")
    other = Check("empty").is_complete("k").is_unique("k").has_parent("known", ForeignKey("k", parent, "id"))
    for batch, (a, b) in enumerate([(0, 150), (150, 150), (150, 390), (390, 400)]):
        for _ in range(2):
            append_batch(spark, path, batch, [(frame(rows[a:b]), check()), (frame([]), other)], buckets=16)
        got = {tuple(r) for r in batch_results(spark, path, [check(), other], batch).collect()}
        assert got == {tuple(r) for r in run_checks([(frame(rows[:b]), check()), (frame([]), other)]).collect()}
    # results of an earlier batch stay to be had
    assert {tuple(r) for r in batch_results(spark, path, [check(), other], 0).collect()} == {
        tuple(r) for r in run_checks([(frame(rows[:150]), check()), (frame([]), other)]).collect()}


@pytest.mark.parametrize("counts", [[40, 18], [0, 7], [500, 3], [299, 1, 10], [1, 1, 1]])
def test_exact_split(spark, counts):
    rows = [(n % 150, "same" if n % 3 == 0 else f"v{n}") for n in range(300)] + [(7, "hot")] * 200 + [(None, "x")] * 3
    df = spark.createDataFrame(rows, "k int, v string").repartition(5)
    got = exact_split(df, "k", counts).collect()
    left, want = len(rows), []
    for n in counts:
        want.append(min(n, left))
        left -= want[-1]
    assert [sum(r["split"] == i for r in got) for i in range(len(counts))] == want
    assert Counter((r["k"], r["v"]) for r in got) == Counter(rows)
    again = exact_split(df.repartition(3), "k", counts)
    assert Counter(map(tuple, got)) == bag(again)


def test_exact_split_of_many_rows(spark):
    df = spark.range(0, 30_000, 1, 6)
    got = exact_split(df, "id", [9_999, 1])
    assert got.groupBy("split").count().orderBy("split").collect() == [(None, 20_000), (0, 9_999), (1, 1)]


def few_keys(name, attempt):
    """Narrow keys of 12 bits, so that 2,000 members collide often."""
    return F.pmod(narrow_key(name, attempt), F.lit(1 << 12))


def test_every_member_has_its_own_key(spark, monkeypatch):
    members = spark.createDataFrame([(f"m{n}",) for n in range(2000)] + [(None,), ("m5",)], "name string")
    keys = assign_keys(members.repartition(4), "name", "key", few_keys)
    assert keys.count() == 2001 == keys.select("key").distinct().count()
    assert keys.where("attempt > 0").count() > 100
    assert bag(keys) == bag(assign_keys(members.repartition(2), "name", "key", few_keys))
    fact = spark.createDataFrame([(f"m{n % 2000}", n) for n in range(5000)] + [(None, -1)], "owner string, n int")
    joined = with_member_key(fact, "owner", "key", keys, few_keys).join(keys, "key")
    assert joined.count() == 5001 and joined.where("NOT owner <=> name").count() == 0
    monkeypatch.setattr(dimensional, "MAX_ATTEMPTS", 2)
    with pytest.raises(ValueError):
        assign_keys(members, "name", "key", lambda name, attempt: F.lit(1))


def test_members_are_merged(spark):
    path = scratch_path(spark, "t-members")
    first = [(f"m{n}", n % 5) for n in range(300)]
    second = [(f"m{n}", 9 if n % 10 == 0 else n % 5) for n in range(250, 600)] + [(None, 1)]
    third = [("m300", 77), ("m300", 78)]
    frame = lambda rows: spark.createDataFrame(rows, "name string, a int")
    keys = {}
    for batch, rows in enumerate((first, second, third)):
        for _ in range(2):
            merge_members(spark, path, batch, frame(rows), "name", "key", ["a"], few_keys)
        kinds = frame(first).select("name", F.struct("a").alias("a")).schema
        got = dimension_members(spark, path, "name", "key", kinds["a"].dataType, kinds["name"].dataType, batch).collect()
        now = {r["name"]: r["key"] for r in got}
        assert len(set(now.values())) == len(got) == len(now) and all(now[n] == k for n, k in keys.items())
        keys = now
    want = {**dict(first), **dict(second), "m300": 77}
    assert {r["name"]: r["_present"]["a"] for r in got} == want
    changes = spark.read.parquet(f"{path}/changes")
    assert {r["before"]["a"] for r in changes.where("batch_id = 1").collect()} == {0}
    assert changes.where("batch_id = 2").count() == 1 and changes.where("batch_id = 0").count() == 0


def test_sets_are_published_at_once(spark):
    root, schema = scratch_path(spark, "t-sets"), "t_sets"
    one = {"a": spark.range(3), "b": spark.range(4).withColumn("p", F.col("id") % 2)}
    assert publish_set(one, schema, root, {"b": ["p"]}) == 1
    old = read_set(spark, schema, root)
    two = {"a": spark.range(5).withColumn("x", F.lit(1)), "b": spark.range(6).withColumn("p", F.lit(None).cast("int"))}
    # a run that dies before its list of tables is written leaves the old set valid
    two["a"].write.parquet(f"{root}/{schema}/set=2/a")
    assert read_set(spark, schema, root)["a"].count() == 3 == spark.table(f"{schema}.a").count()
    assert publish_set(two, schema, root, {"b": ["p"]}) == 2
    assert spark.table(f"{schema}.a").columns == ["id", "x"] and spark.table(f"{schema}.b").count() == 6
    assert read_set(spark, schema, root)["b"].count() == 6 and old["b"].count() == 4
    assert read_set(spark, schema, root, 1)["a"].count() == 3
    assert publish_set(one, schema, root) == 3
    assert [n for n in folder_names(spark, f"{root}/{schema}") if n.startswith("set=")] == ["set=2", "set=3"]


@pytest.mark.parametrize("master, told", [("local", False), ("local[8]", False), ("local-cluster[2,1,900]", True),
                                          ("yarn", True), ("spark://host:7077", True)])
def test_sessions_without_a_shared_folder(master, told):
    """One process may use a folder of its own; a cluster has to be given one."""
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default),
                              sparkContext=SimpleNamespace(master=master))
    if told:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            storage.scratch_path(session, "x")
    else:
        assert Path(storage.scratch_path(session, "x")).parent.parent.exists()


def test_a_plain_local_session_stores_tables():
    """In a process of its own, as the setting belongs to the session's start."""
    code = ("from emberfold.session import build_session\n"
            "from emberfold.storage import materialize\n"
            "spark = build_session('local[1]')\n"
            "assert spark.conf.get('spark.checkpoint.dir', None) is None\n"
            "print('stored', materialize(spark.range(7), 'x').count())\n")
    env = {k: v for k, v in os.environ.items() if not k.startswith("SPARK_CONF")}
    with tempfile.TemporaryDirectory() as conf:
        run = subprocess.run([sys.executable, "-c", code], env={**env, "SPARK_CONF_DIR": conf}, capture_output=True,
                             text=True, cwd=Path(__file__).parent.parent, timeout=120)
    assert "stored 7" in run.stdout, run.stderr[-2000:]


def test_a_part_is_one_file_in_a_stream_too(spark, tmp_path):
    from emberfold.sources.parts import PartTable

    rows = spark.range(800).repartition(8).withColumn("bucket", (F.col("id") % 3).cast("int"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # as in the batches of a stream with state
    try:
        PartTable(str(tmp_path), "bucket").write(rows, 0, {}, [])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    for part in range(3):
        assert len(list((tmp_path / "rows" / "version=0" / f"bucket={part}").glob("*.parquet"))) == 1
    stored = spark.read.parquet(str(tmp_path / "rows" / "version=0"))
    assert sorted(r["id"] for r in stored.collect()) == list(range(800))
