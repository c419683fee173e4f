"""Small cases with known answers."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from emberfold.functions import scalars as s
from emberfold.functions.fire import fire_codes, risk_level
from emberfold.operators.dimensional import build_dimension, dim_date, with_row_id
from emberfold.operators.joins import Lookup
from emberfold.operators.quality import (
    Check, ForeignKey, QualityGateError, foreign_key_flags, gate, orphans, run_checks)
from emberfold.operators.repair import (
    Box, bbox_label, bbox_range_join, fill_from_lookup, impute_group_mode, keep_first,
    override_by_key)
from emberfold.plans import cleaning, fixed_values as fixed
from emberfold.streaming.weather import is_reading, normalize_payload, parse_messages


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_fire_codes(spark):
    cases = [
        (1, 25.0, 45.0, 12.0, 0.0, 7, (92.5, 34.71, 26.0088, 11.1979, 33.2986)),
        (2, 10.0, 80.0, 5.0, 3.0, 1, (48.2426, 24.9128, 43.0737, 0.1687, 21.8681)),
        (3, 35.0, 15.0, 30.0, 0.0, 8, (92.5, 65.9, 31.3296, 18.5, 64.4658)),
        (4, -5.0, 95.0, 0.0, 10.0, 12, (28.6, 17.8231, 163.4924, 0.0023, 32.8866)),
        (5, None, 45.0, 12.0, 0.0, 7, (92.5, None, None, 11.1979, None)),
    ]
    df = spark.createDataFrame(
        [c[:6] for c in cases], "n int, temperature float, rh float, ws float, rain float, m int")
    got = fire_codes(df, F.col("m")).orderBy("n").select(
        "ffmc", "dmc", "dc", "isi", "bui").collect()
    for row, case in zip(got, cases):
        assert tuple(row) == pytest.approx(case[6], abs=1e-4) if None not in case[6] else [
            None if v is None else round(v, 4) for v in row] == list(case[6])


def test_duff_code_without_a_start(spark):
    df = spark.createDataFrame([(20.0, 50.0, 10.0, 5.0)],
                               "temperature double, rh double, ws double, rain double")
    code = fire_codes(df, F.lit(6), prev_dmc=F.lit(0.0)).first()["dmc"]
    wet = 20 * (1 - 0.001 * (0.92 * 5 - 1.27) * 100)
    expected = wet / (1 + wet / 280) + 11.5 * 1.6 * 21.1 * 50 / 1000
    assert code == pytest.approx(expected, rel=1e-6)


def test_risk(spark):
    df = spark.createDataFrame([(v,) for v in (4.99, 5.0, 10.0, 20.0, 29.99, 30.0, None)], "v double")
    levels = [r[0] for r in df.select(risk_level(F.col("v"))).collect()]
    assert levels == ["Very Low", "Low", "Moderate", "High", "High", "Very High/Extreme", None]


def test_date_keys_and_weekdays(spark):
    df = spark.createDataFrame(
        [(1, 1, 1998), (31, 12, 2023), (1, None, 2000), (30, 2, 2000)], "d int, m int, y int")
    keys = [r[0] for r in df.select(s.date_key(F.col("d"), F.col("m"), F.col("y"))).collect()]
    assert keys == [1011998, 31122023, None, 30022000]
    day = dim_date(spark, date(2023, 1, 1), date(2023, 1, 1)).first()
    assert (day["weekday"], day["weekday_sun1"], day["date_key"]) == (7, 1, 1012023)


def test_whole_date_dimension(spark):
    days = dim_date(spark)
    first = days.agg(F.min("full_date").cast("string"), F.max("full_date"), F.count("*"),
                     F.countDistinct("date_key")).first()
    assert tuple(first) == ("0037-01-01", date(2023, 12, 31), 725_736, 725_736)
    assert days.where("date_key = 30022000").isEmpty()


def test_coordinates(spark):
    df = spark.createDataFrame(
        [("51.5, -2.5",), ("51.5,-2.5",), ("51.5",), ("x, y",), (None,)], "c string")
    got = rows(df.select(s.pair_part(F.col("c"), 0), s.pair_part(F.col("c"), 1)))
    assert got == [(51.5, -2.5), (51.5, -2.5), (51.5, None), (None, None), (None, None)]


def test_decode(spark):
    df = spark.createDataFrame([(0,), (4,), (9,), (None,)], "c int")
    got = [r[0] for r in df.select(s.decode("c", fixed.DEATHS_SCALE)).collect()]
    assert got == ["None", "Very many (over 1000 deaths)", "9", None]
    assert df.where("c = 0").select(s.decode("c", {0: "it's \\ x"})).first()[0] == "it's \\ x"


def test_casts(spark):
    df = spark.createDataFrame([("12",), (None,), ("abc",), ("12.0",), (" -7 ",)], "c string")
    c = F.col("c")
    assert [r[0] for r in df.select(s.whole_number("c")).collect()] == [12, None, None, 12, -7]
    assert df.where(s.castable_or_null(c, "int")).count() == 3
    assert df.where(s.castable(c, "int")).count() == 2


def test_null_rule(spark):
    df = spark.createDataFrame([(None, 1, None), (None, 1, 5), (1, 1, None)], "m int, d int, n int")
    kept = df.where(s.dated_or_counted([F.col("m"), F.col("d")], F.col("n")))
    assert rows(kept) == [(None, 1, 5), (1, 1, None)]


def test_narrow_keys(spark):
    df = spark.createDataFrame([("a",), (None,)], "c string")
    got = rows(df.select(s.surrogate_key(F.col("c"), narrow=True), F.abs(F.hash("c")).cast("bigint"),
                         s.surrogate_key(F.col("c"))))
    assert got[0][0] == got[0][1] and got[1][0] == 42 and got[1][2] == -1


def test_group_mode(spark):
    data = ([("A", "x"), ("A", "x"), ("A", "y"), ("A", None)]
            + [("B", None), ("B", None), ("B", "x")] + [("C", "x"), ("C", "y"), ("C", None)]
            + [(None, None)])
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "i int, g string, v string")
    got = {r["i"]: r["v"] for r in impute_group_mode(df, "g", ["v"]).collect()}
    assert [got[i] for i in (3, 4, 5, 9, 10)] == ["x", "unknown", "unknown", "x", None]


def test_boxes(spark):
    boxes = [Box(0, 10, 0, 10, "first"), Box(5, 15, 5, 15, "second")]
    df = spark.createDataFrame(
        [(1, 7.0, 7.0, None), (2, 15.0, 15.0, None), (3, 7.0, 7.0, "kept"), (4, 99.0, 0.0, None),
         (5, 0.0, 10.0, None), (6, None, 1.0, None)], "i int, x double, y double, p string")
    want = ["first", "second", "kept", None, "first", None]
    for label in (bbox_label, bbox_range_join):
        got = label(df, "x", "y", boxes, "p").orderBy("i").collect()
        assert [r["p"] for r in got] == want
    brazil = spark.createDataFrame([(-44.3, -22.9, None)], "x double, y double, p string")
    assert bbox_range_join(brazil, "x", "y", cleaning.COUNTRY_BOXES, "p").first()["p"] == "Brazil"


def test_lookup_last_entry_wins(spark):
    lookup = Lookup("k int, v string", ("k",), [(1, "old"), (2, "two"), (1, "new")])
    df = spark.createDataFrame([(1, None), (1, "own"), (2, None), (3, None), (None, None)],
                               "k int, v string")
    assert sorted(map(str, rows(fill_from_lookup(df, lookup, ["k"], ["v"])))) == sorted(map(str, [
        (1, "new"), (1, "own"), (2, "two"), (3, None), (None, None)]))
    assert sorted(map(str, rows(override_by_key(df, lookup, ["k"], ["v"])))) == sorted(map(str, [
        (1, "new"), (1, "new"), (2, "two"), (3, None), (None, None)]))


def test_fixed_tables():
    assert len(cleaning.EARTHQUAKE_OVERRIDES.unique_rows()) == 53
    assert len(cleaning.EARTHQUAKE_DATES.unique_rows()) == 83
    assert len(cleaning.TSUNAMI_PLACES.unique_rows()) == 63
    assert len(cleaning.ERUPTION_DATES.unique_rows()) == 161
    assert len(cleaning.COUNTRY_BOXES) == 45
    last = {r[:3]: r[3:] for r in cleaning.ERUPTION_DATES.unique_rows()}
    assert last[("Tungurahua", 2010, "Ecuador")] == (1, 5)


def test_keep_first(spark):
    df = spark.createDataFrame(
        [(1, "a", 3), (1, "a", 2), (1, "a", None), (2, "b", None), (None, None, 7), (None, None, 6)],
        "k int, v string, id int")
    assert sorted(map(str, rows(keep_first(df, ["k", "v"], ["id"])))) == sorted(map(str, [
        (1, "a", 2), (2, "b", None), (None, None, 6)]))
    assert sorted(map(str, rows(keep_first(df, ["k"], ["id"])))) == sorted(map(str, [
        (1, "a", 2), (2, "b", None), (None, None, 6)]))


def test_entity_dimension_has_one_row_per_key(spark):
    df = spark.createDataFrame([("v", 5), ("v", 3), (None, 1)], "n string, e int")
    got = rows(build_dimension(df, F.col("n"), "n", "k", {"e": F.col("e")}), "n")
    assert [(n, e) for _, n, e in got] == [("unknown", 1), ("v", 3)]


def test_row_ids(spark):
    df = spark.createDataFrame([("a", 1)] * 7 + [("a", None)] * 2 + [("b", 1)], "x string, y int")
    for block in (2, 100):
        got = with_row_id(df, "id", block)
        assert got.select("id").distinct().count() == 10
        assert sorted(map(str, rows(got.drop("id")))) == sorted(map(str, rows(df)))
    assert rows(with_row_id(df, "id", 2), "id") == rows(with_row_id(df.repartition(3), "id"), "id")


def test_checks(spark):
    df = spark.createDataFrame([(1, 1), (2, None), (2, 5)], "k int, v int")
    check = (Check("t").is_unique("k").has_completeness("v", lambda m: m > 0.5)
             .is_complete("v").satisfies("v < 3", "small"))
    got = {r["constraint"]: (r["metric"], r["constraint_status"])
           for r in run_checks([(df, check)]).collect()}
    assert got == {
        "unique(k)": (pytest.approx(1 / 3), "Failure"),
        "completeness(v)": (pytest.approx(2 / 3), "Success"),
        "complete(v)": (pytest.approx(2 / 3), "Failure"),
        "small": (pytest.approx(1 / 3), "Failure")}
    with pytest.raises(QualityGateError, match="3 constraints failed"):
        gate(run_checks([(df, check)]))
    gate(run_checks([(df, Check("t").is_complete("k"))]))


def test_empty_table_fails(spark):
    empty = spark.createDataFrame([], "k int")
    got = run_checks([(empty, Check("t").is_complete("k").is_unique("k"))]).collect()
    assert [r["constraint_status"] for r in got] == ["Failure", "Failure"]


def test_foreign_keys(spark):
    fact = spark.createDataFrame([(1, 10), (2, 20), (3, None), (4, 10)], "id int, fk int")
    dim = spark.createDataFrame([(10, "a"), (10, "b"), (30, "c"), (None, "d")], "k bigint, n string")
    key = ForeignKey("fk", dim, "k")
    for limit in (1000, 0):
        flagged = foreign_key_flags(fact, {"ok": key}, limit)
        assert rows(flagged.select("id", "ok"), "id") == [(1, 1), (2, 0), (3, 0), (4, 1)]
        assert rows(orphans(fact, key, limit).select("id"), "id") == [(2,), (3,)]
    share = run_checks([(fact, Check("f").has_parent("fk", key))]).first()
    assert share["metric"] == 0.5


def test_messages(spark):
    df = spark.createDataFrame([('{"Temperature":"x","RH":2}',), ("junk",), (None,)], "value string")
    got = rows(parse_messages(df).select("temperature", "rh", is_reading()))
    assert got == [(None, 2.0, True), (None, None, False), (None, None, False)]


def test_payload(spark):
    df = spark.createDataFrame([
        ('{"main":{"temp":20.5,"humidity":40},"wind":{"speed":10},"rain":{"1h":0.4}}',),
        ('{"main":{"temp":20.5,"humidity":40},"wind":{"speed":10}}',)], "p string")
    got = rows(normalize_payload(df, "p").drop("p"))
    assert got == [(20.5, 40.0, 36.0, 0.4), (20.5, 40.0, 36.0, 0.0)]
