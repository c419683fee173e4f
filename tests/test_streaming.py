"""Streams: same rows as a batch, no second copy after a replay."""

import json

from pyspark.sql import functions as F

from emberfold.operators.carry import carried_codes, daily_readings
from emberfold.streaming import weather as w
from emberfold.storage import scratch_path

READINGS = [{"Temperature": 20.0 + i, "RH": 40.0, "Ws": 10.0, "Rain": float(i % 3)}
            for i in range(12)]


def land(path, name, readings):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(json.dumps(r) for r in readings) + "\n")


def test_stream_equals_batch_over_several_runs(spark, tmp_path):
    inbox, out = tmp_path / "in", scratch_path(spark, "t-sinks")
    sinks = w.batch_sinks(f"{out}/raw", f"{out}/features", f"{out}/bad", F.lit(7))
    for i in range(3):
        land(inbox, f"{i}.json", READINGS[i * 4:(i + 1) * 4])
        if i == 2:
            (inbox / "junk.json").write_text("junk\n{}\n")
        messages = w.text_stream(spark, str(inbox), max_files=1)
        w.start_sinks(messages, sinks, f"{out}/checkpoint").awaitTermination()

    features = spark.read.parquet(f"{out}/features")
    assert features.count() == 12 and features.select("id").distinct().count() == 12
    assert spark.read.parquet(f"{out}/raw").count() == 14
    assert spark.read.parquet(f"{out}/bad").count() == 2
    lines = spark.read.text(str(inbox))
    batch = w.weather_features(w.parse_messages(lines).where(w.is_reading()), F.lit(7))
    columns = [*w.FIELDS, "ffmc", "dmc", "dc", "isi", "bui"]
    assert sorted(map(tuple, features.select(columns).collect())) == sorted(
        map(tuple, batch.select(columns).collect()))


def test_replayed_batch_leaves_one_copy(spark):
    out = scratch_path(spark, "t-replay")
    write = w.batch_sinks(f"{out}/raw", f"{out}/features", None, F.lit(7))
    lines = spark.createDataFrame([(json.dumps(r),) for r in READINGS], "value string")
    parsed = w.parse_messages(lines)
    write(parsed, 0)
    write(parsed, 0)
    write(parsed, 1)
    assert spark.read.parquet(f"{out}/features").count() == 24
    assert spark.read.parquet(f"{out}/raw").groupBy("batch_id").count().where(
        "count <> 12").isEmpty()


def test_position_gives_the_id(spark):
    out = scratch_path(spark, "t-position")
    lines = spark.createDataFrame(
        [("t", 0, i, json.dumps(READINGS[0])) for i in range(3)],
        "topic string, partition int, offset bigint, value string")
    for run in (0, 1):
        w.batch_sinks(f"{out}/raw{run}", f"{out}/f{run}", None, F.lit(7))(
            w.parse_messages(lines), 0)
    first, again = ({r["id"] for r in spark.read.parquet(f"{out}/f{run}").collect()}
                    for run in (0, 1))
    assert first == again and len(first) == 3


def test_windows_over_several_batches(spark, tmp_path):
    out, schema = scratch_path(spark, "t-windows"), "ts timestamp, kind string, value int"
    rows = [(f"2024-01-0{d} 0{h}:00:00", k, d * h) for d in (1, 2, 3) for h in (1, 2) for k in "ab"]
    frame = spark.createDataFrame(rows, "t string, kind string, value int").select(
        F.col("t").cast("timestamp").alias("ts"), "kind", "value")
    measures = {"n": F.count(F.lit(1)), "total": F.sum("value")}
    for i, half in enumerate((frame.where("hour(ts) = 1"), frame.where("hour(ts) = 2"))):
        half.write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        w.window_metrics(stream, "ts", "kind", "1 day", measures, late="10 days").writeStream \
            .foreachBatch(w.versioned_sink(f"{out}/rows")).outputMode("update") \
            .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True) \
            .start().awaitTermination()
    got = w.newest_version(spark, f"{out}/rows", ["window_start", "window_end", "kind"])
    want = w.window_metrics(frame, "ts", "kind", "1 day", measures)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_latest(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", 3)], "id string, ingestion_time int")
    assert w.latest_reading(df).first()["id"] == "b"


def test_carried_codes_start_each_day_from_the_last(spark):
    rows = [("s", f"2024-07-0{d} {h}:00:00", 20.0 + d, 40.0, 10.0, 0.0)
            for d in (1, 2, 3) for h in (10, 14)] + [("q", "2024-07-01 10:00:00", None, 40.0, 10.0, 0.0)]
    df = spark.createDataFrame(
        rows, "st string, ts string, temperature double, rh double, ws double, rain double")
    got = carried_codes(daily_readings(df, "st", "ts"), "st").orderBy("st", "day").collect()
    dmc = 6.0
    for r, d in zip(got[1:], (1, 2, 3)):
        dmc = min(65.9, dmc + 12.5 * 1.6 * (20.0 + d + 1.1) * 60 / 1000)
        assert abs(r["dmc"] - dmc) < 1e-9
    assert got[0]["st"] == "q" and got[0]["dmc"] is None and got[0]["ffmc"] is not None


def test_carried_stream_equals_batch(spark, tmp_path):
    out = scratch_path(spark, "t-carry")
    schema = "st string, ts timestamp, temperature double, rh double, ws double, rain double"
    days = [[(st, f"2024-07-{d:02d} {h:02d}:00:00", 15.0 + d % 7 + len(st), 35.0 + d, 8.0,
              4.0 if d % 4 == 0 else 0.0) for st in ("a", "bb") for h in (9, 15)
             if not (st == "bb" and d == 5)] for d in range(1, 13)]
    for i in range(0, 12, 3):
        rows = [r for day in days[i:i + 3] for r in day]
        spark.createDataFrame(rows, schema.replace("timestamp", "string")).withColumn(
            "ts", F.col("ts").cast("timestamp")).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        w.daily_stream(stream, "st", "ts", "0 seconds").writeStream.foreachBatch(
            w.carry_sink(f"{out}/codes", f"{out}/state", "st")).outputMode("append").option(
            "checkpointLocation", f"{out}/checkpoint").trigger(
            availableNow=True).start().awaitTermination()
    got = spark.read.parquet(f"{out}/codes").drop("batch_id")
    everything = spark.read.schema(schema).parquet(str(tmp_path / "in"))
    # the last day stays open until a later reading arrives
    want = carried_codes(daily_readings(everything, "st", "ts"), "st").where("day < '2024-07-12'")
    columns = want.columns
    assert got.count() == 21
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(
        map(tuple, want.collect()))


def test_replayed_messages_keep_their_ids(spark, monkeypatch):
    monkeypatch.setattr(w, "COPY_BLOCK", 4)
    lines = spark.createDataFrame([("same",)] * 11 + [("other",), (None,), (None,)], "value string")
    runs = [sorted(map(tuple, w.with_message_id(df, batch).collect()), key=str) for df, batch in (
        (lines.coalesce(1), 3), (lines.repartition(5), 3), (lines, 4))]
    assert runs[0] == runs[1] and len({i for _, i in runs[0]}) == 14
    assert sorted(str(v) for v, _ in runs[0]) == sorted(str(r[0]) for r in lines.collect())
    assert not {i for _, i in runs[0]} & {i for _, i in runs[2]}
