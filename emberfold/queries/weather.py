"""Fire codes and streams over readings derived from the events."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from emberfold.functions.fire import RISK_LEVELS, fire_codes, risk_level
from emberfold.operators.carry import carried_codes, daily_readings
from emberfold.queries.base import amount, query, sql_money, sql_text, table
from emberfold.storage import materialize, scratch_path
from emberfold.streaming import weather as w
from emberfold.streaming.packing import pack_batches, read_batches


def readings(spark, sf_dir):
    """One reading per event, with missing values and junk put in by event id."""
    k = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        k, "ts", "user_id",
        F.when(k % 29 != 0, ((k * 37) % 450) / 10.0 - 5.0).cast("float").alias("temperature"),
        (((k * 53) % 800) / 10.0 + 15.0).cast("float").alias("rh"),
        (F.col("value") / 8.0).cast("float").alias("ws"),
        F.when(k % 4 == 0, ((k * 17) % 120) / 10.0).otherwise(0.0).cast("float").alias("rain"),
        (k % 12 + 1).cast("int").alias("month"))


READINGS_SQL = """(SELECT event_id, ts, user_id,
    CAST(CASE WHEN event_id % 29 = 0 THEN NULL ELSE ((event_id * 37) % 450) / 10.0::DOUBLE - 5.0 END
         AS FLOAT) AS temperature,
    CAST(((event_id * 53) % 800) / 10.0::DOUBLE + 15.0 AS FLOAT) AS rh,
    CAST(value / 8.0 AS FLOAT) AS ws,
    CAST(CASE WHEN event_id % 4 = 0 THEN ((event_id * 17) % 120) / 10.0::DOUBLE ELSE 0.0 END
         AS FLOAT) AS rain,
    CAST(event_id % 12 + 1 AS INTEGER) AS month
  FROM events)"""


def _clamp(expr: str, lo: float, hi: float) -> str:
    return f"(CASE WHEN ({expr}) IS NULL THEN NULL ELSE greatest({lo}, least({hi}, {expr})) END)"


def codes_sql(source: str, month: str = "month", ffmc0="85.0", dmc0="6.0", dc0="15.0",
              keep: str = "*") -> str:
    """First three codes in double precision, as f, d, c, over columns t, h, v, r."""
    m0 = (f"(147.2::DOUBLE * (101.0 - {ffmc0}) / (59.5 + {ffmc0}) + CASE WHEN r > 0.5 THEN "
          f"42.5::DOUBLE * (r - 0.5) * (1.0 - 0.0015::DOUBLE * (r - 0.5)) ELSE 0 END)")
    m = f"greatest(0.0, {m0} - 250.0 * (1.0 - h / 100.0))"
    f = _clamp(f"59.5 * (250.0 - {m}) / (147.2::DOUBLE + {m})", 28.6, 92.5)
    mo = (f"((20.0 + 280.0 / (1.0 + 280.0 / {dmc0})) * (1.0 - 0.001::DOUBLE * (0.92::DOUBLE * r "
          f"- 1.27::DOUBLE) * (100.0 / (0.5 * {dmc0}))))")
    d = _clamp(f"CASE WHEN r > 1.5 THEN {mo} / (1.0 + {mo} / 280.0) ELSE {dmc0} END + CASE WHEN "
               f"t > -1.1 THEN (5.5 + {month}) * (1.6::DOUBLE * (t + 1.1::DOUBLE) * (100.0 - h) "
               f"/ 1000.0) ELSE 0 END", 1.1, 65.9)
    c = _clamp(f"{dc0} + CASE WHEN r > 2.8 THEN 400.0 * ((0.83::DOUBLE * r - 1.27::DOUBLE) / "
               f"(3.937::DOUBLE + {dc0})) ELSE 0 END + CASE WHEN t > -2.8 THEN 0.36::DOUBLE * "
               f"(t + 2.8::DOUBLE) * ((4 + {month}) / 10.0::DOUBLE) ELSE 0 END", 7.0, 220.4)
    return (f"(SELECT {keep}, CASE WHEN h IS NULL OR r IS NULL THEN NULL ELSE {f} END AS f, "
            f"CASE WHEN t IS NULL OR h IS NULL OR r IS NULL THEN NULL ELSE {d} END AS d, "
            f"CASE WHEN t IS NULL OR r IS NULL THEN NULL ELSE {c} END AS c FROM {source})")


def indices_sql(f: str, d: str, c: str, v: str) -> tuple[str, str]:
    m = f"(147.2::DOUBLE * (101.0 - {f}) / (59.5 + {f}))"
    isi = _clamp(f"19.115::DOUBLE * exp(-0.1386::DOUBLE * {m}) * (1.0 + pow({m}, 5.31::DOUBLE) "
                 f"/ 4.93e7::DOUBLE) * exp(0.05039::DOUBLE * {v})", 0.0, 18.5)
    k = f"((1.0 - 0.8::DOUBLE * {d} / ({d} + {c})) * (0.1::DOUBLE * {c}))"
    bui = _clamp(f"CASE WHEN {d} <= 0.4::DOUBLE * {c} THEN {d} + {k} ELSE {d} - {k} END", 1.1, 68.0)
    return isi, bui


def float_codes_sql(source: str, month: str = "month") -> str:
    """All five codes rounded to float, as ffmc..bui, next to the columns of ``source``."""
    first = codes_sql(
        f"(SELECT *, CAST(temperature AS DOUBLE) AS t, CAST(rh AS DOUBLE) AS h, "
        f"CAST(ws AS DOUBLE) AS v, CAST(rain AS DOUBLE) AS r FROM {source} s0) s1", month)
    isi, bui = indices_sql("CAST(ffmc AS DOUBLE)", "CAST(dmc AS DOUBLE)", "CAST(dc AS DOUBLE)", "v")
    return (f"(SELECT *, CAST({isi} AS FLOAT) AS isi, CAST({bui} AS FLOAT) AS bui FROM "
            f"(SELECT *, CAST(f AS FLOAT) AS ffmc, CAST(d AS FLOAT) AS dmc, CAST(c AS FLOAT) AS dc "
            f"FROM {first} s2) s3)")


CODES = ["ffmc", "dmc", "dc", "isi", "bui"]
ROUNDED_CODES_SQL = ", ".join(f"round(CAST({c} AS DOUBLE), 3) AS {c}" for c in CODES)


def rounded_codes():
    return [F.round(F.col(c).cast("double"), 3).alias(c) for c in CODES]


@query("f1_fire_codes",
       f"SELECT event_id, month, {ROUNDED_CODES_SQL} FROM {float_codes_sql(READINGS_SQL)} x")
def f1_fire_codes(spark, sf_dir):
    coded = fire_codes(readings(spark, sf_dir), F.col("month"))
    return coded.select("event_id", "month", *rounded_codes())


def _risk_sql(column: str, at: int) -> str:
    branches = " ".join(f"WHEN {column} < {row[0]} THEN {sql_text(row[at])}"
                        for row in RISK_LEVELS[:-1])
    return (f"CASE WHEN {column} IS NULL THEN NULL {branches} "
            f"ELSE {sql_text(RISK_LEVELS[-1][at])} END")


@query("f3_risk_bucket", f"""
    SELECT event_id, v AS fwi, {_risk_sql('v', 1)} AS level, {_risk_sql('v', 2)} AS meaning,
           {_risk_sql('v', 3)} AS color
    FROM (SELECT event_id, CASE WHEN event_id % 40 = 0 THEN NULL WHEN event_id % 41 = 0 THEN 30.0
                 ELSE value END AS v FROM events) e""")
def f3_risk_bucket(spark, sf_dir):
    k, v = F.col("event_id"), F.col("fwi")
    fwi = F.when(k % 40 == 0, None).when(k % 41 == 0, 30.0).otherwise(F.col("value"))
    return table(spark, sf_dir, "events").select(k, fwi.alias("fwi")).select(
        k, v, risk_level(v).alias("level"), risk_level(v, "meaning").alias("meaning"),
        risk_level(v, "color").alias("color"))


def _landed_messages(spark, sf_dir) -> str:
    """Readings as JSON lines below a new folder; every 50th line is junk."""
    path = scratch_path(spark, "messages")
    message = F.when(F.col("event_id") % 50 == 7, F.lit("junk")).otherwise(w.to_message())
    readings(spark, sf_dir).select(message.alias("value")).write.text(path)
    return path


# Junk lines parse to four NULLs.
_PARSED_COLUMNS_SQL = ", ".join(f"CASE WHEN event_id % 50 = 7 THEN NULL ELSE {c} END AS {c}" for c in w.FIELDS)
_PARSED_SQL = f"(SELECT {_PARSED_COLUMNS_SQL} FROM {READINGS_SQL} r)"
_USABLE_SQL = "(" + " OR ".join(f"{c} IS NOT NULL" for c in w.FIELDS) + ")"


@query("s1_stream_parse", f"SELECT *, {_USABLE_SQL} AS is_reading FROM {_PARSED_SQL} p")
def s1_stream_parse(spark, sf_dir):
    out = scratch_path(spark, "parsed")
    parsed = w.parse_messages(w.text_stream(spark, _landed_messages(spark, sf_dir)))
    parsed.select(*w.FIELDS, w.is_reading().alias("is_reading")).writeStream.format(
        "parquet").option("checkpointLocation", out + "-checkpoint").trigger(
        availableNow=True).start(out).awaitTermination()
    return spark.read.parquet(out)


def _run_sinks(spark, sf_dir) -> str:
    out = scratch_path(spark, "sinks")
    sinks = w.batch_sinks(f"{out}/raw", f"{out}/features", f"{out}/quarantine", F.lit(7))
    messages = w.text_stream(spark, _landed_messages(spark, sf_dir))
    w.start_sinks(messages, sinks, f"{out}/checkpoint").awaitTermination()
    return out


@query("s4_dual_sink", f"""
    SELECT temperature, rh, ws, rain, {ROUNDED_CODES_SQL}
    FROM {float_codes_sql(f'(SELECT * FROM {_PARSED_SQL} p WHERE {_USABLE_SQL})', '7')} x""")
def s4_dual_sink(spark, sf_dir):
    out = _run_sinks(spark, sf_dir)
    return spark.read.parquet(f"{out}/features").select(*w.FIELDS, *rounded_codes())


@query("s4_sink_counts", f"""
    SELECT 'raw' AS sink, COUNT(*) AS stored FROM {_PARSED_SQL} p
    UNION ALL SELECT 'features', COUNT(*) FILTER ({_USABLE_SQL}) FROM {_PARSED_SQL} p
    UNION ALL SELECT 'quarantine', COUNT(*) FILTER (NOT {_USABLE_SQL}) FROM {_PARSED_SQL} p""")
def s4_sink_counts(spark, sf_dir):
    out = _run_sinks(spark, sf_dir)
    counts = [spark.read.parquet(f"{out}/{sink}").agg(
        F.lit(sink).alias("sink"), F.count(F.lit(1)).alias("stored"))
        for sink in ("raw", "features", "quarantine")]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("s4_compacted", f"""
    SELECT batch_id, temperature, rh, ws, rain, {ROUNDED_CODES_SQL}
    FROM {float_codes_sql(f"""(SELECT * FROM (SELECT CAST(event_id % 5 AS BIGINT) AS batch_id, {_PARSED_COLUMNS_SQL}
        FROM {READINGS_SQL} r) p WHERE {_USABLE_SQL})""", '7')} x""")
def s4_compacted(spark, sf_dir):
    """Five batches, packed after the third and the fifth; a packed batch is replayed in between."""
    out = scratch_path(spark, "packed")
    write = w.batch_sinks(f"{out}/raw", f"{out}/features", None, F.lit(7))
    message = F.when(F.col("event_id") % 50 == 7, F.lit("junk")).otherwise(w.to_message())
    landed = materialize(readings(spark, sf_dir).select(
        (F.col("event_id") % 5).alias("batch"), message.alias("value")), "batches")
    for b in range(5):
        write(w.parse_messages(landed.where(F.col("batch") == b).select("value")), b)
        if b in (2, 4):
            pack_batches(spark, f"{out}/features")
        if b == 3:
            write(w.parse_messages(landed.where(F.col("batch") == 1).select("value")), 1)
    return read_batches(spark, f"{out}/features").select("batch_id", *w.FIELDS, *rounded_codes())


@query("s6_ingestion_time", f"""
    SELECT temperature, rh, ws, rain, TIMESTAMP '2024-07-01 12:30:00' AS ingestion_time
    FROM {_PARSED_SQL} p WHERE {_USABLE_SQL}""")
def s6_ingestion_time(spark, sf_dir):
    out = scratch_path(spark, "stamped")
    write = w.batch_sinks(f"{out}/raw", f"{out}/features", None, F.lit(7), clock=F.lit("2024-07-01 12:30:00").cast("timestamp"))
    write(w.parse_messages(spark.read.text(_landed_messages(spark, sf_dir))), 0)
    return spark.read.parquet(f"{out}/features").select(
        *w.FIELDS, F.col("ingestion_time").cast("timestamp_ntz").alias("ingestion_time"))


@query("s5_replay_ids", f"""
    SELECT run, CAST(2 * COUNT(*) AS BIGINT) AS ids
    FROM {_PARSED_SQL} p, (VALUES ('first'), ('again'), ('both')) AS r(run)
    WHERE {_USABLE_SQL} GROUP BY run""")
def s5_replay_ids(spark, sf_dir):
    """Every message lands twice; the batch is replayed in another layout and keeps its ids."""
    out = scratch_path(spark, "replay")
    lines = spark.read.text(_landed_messages(spark, sf_dir))
    parsed = w.parse_messages(lines.unionByName(lines))
    write = w.batch_sinks(f"{out}/raw", f"{out}/features", None, F.lit(7))
    write(parsed, 0)
    first = materialize(spark.read.parquet(f"{out}/features").select("id"), "ids").distinct()
    write(parsed.repartition(7), 0)
    again = spark.read.parquet(f"{out}/features").select("id").distinct()
    runs = {"first": first, "again": again, "both": first.intersect(again)}
    counts = [df.agg(F.lit(run).alias("run"), F.count(F.lit(1)).alias("ids")) for run, df in runs.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


_METRICS_SQL = f"""
    SELECT CAST(ts AS DATE)::TIMESTAMP AS window_start,
           CAST(ts AS DATE)::TIMESTAMP + INTERVAL 1 DAY AS window_end, event_type,
           COUNT(*) AS readings, {sql_money('value')} AS total,
           MAX(value) AS highest
    FROM events GROUP BY 1, 2, event_type"""


@query("s8_stream_window", _METRICS_SQL)
def s8_stream_window(spark, sf_dir):
    out = scratch_path(spark, "windows")
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(
        sf_dir)
    metrics = w.window_metrics(events, "ts", "event_type", "1 day", {
        "readings": F.count(F.lit(1)),
        "total": F.sum(amount("value")) / 100.0,
        "highest": F.max("value")}, late="2 days")
    metrics.writeStream.foreachBatch(w.versioned_sink(f"{out}/rows")).outputMode("update").option(
        "checkpointLocation", f"{out}/checkpoint").trigger(
        availableNow=True).start().awaitTermination()
    newest = w.newest_version(
        spark, f"{out}/rows", ["window_start", "window_end", "event_type"])
    return newest.withColumns({
        c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


# Every tenth event comes with the second batch, when the others have moved the watermark on.
_SECOND = "event_id % 10 = 0"
_LATE_ROWS_SQL = f"""(SELECT *, CAST(ts AS DATE) AS day, {_SECOND} AND CAST(ts AS DATE)::TIMESTAMP + INTERVAL 1 DAY <=
      (SELECT MAX(CAST(ts AS TIMESTAMP)) - INTERVAL 9 DAY FROM events WHERE NOT ({_SECOND})) AS is_late FROM events)"""


def _merged_windows(spark, sf_dir) -> tuple[str, object]:
    """Both batches through the sink, the second twice, as after a failure; and the schema of its windows."""
    out = scratch_path(spark, "merged-windows")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    sink = w.window_sink(out, "ts", "event_type", "1 day", {
        "readings": w.Measure(F.count(F.lit(1)), F.sum), "cents": w.Measure(F.sum(amount("value")), F.sum),
        "highest": w.Measure(F.max("value"), F.max)}, late="9 days")
    for batch_id, rows in ((0, events.where(f"NOT ({_SECOND})")), (1, events.where(_SECOND)),
                           (1, events.where(_SECOND))):
        sink(rows, batch_id)
    schema = ("window_start timestamp, window_end timestamp, event_type string, readings bigint, cents bigint, "
              "highest double, day string")
    return out, spark.createDataFrame([], schema).schema


@query("s7_late_rows", f"""
    SELECT 'window' AS kept, CAST(day AS VARCHAR) AS day, event_type, COUNT(*) AS readings,
           {sql_money('value')} AS total FROM {_LATE_ROWS_SQL} e WHERE NOT is_late GROUP BY day, event_type
    UNION ALL
    SELECT 'late', CAST(day AS VARCHAR), event_type, COUNT(*), {sql_money('value')}
    FROM {_LATE_ROWS_SQL} e WHERE is_late GROUP BY day, event_type
    UNION ALL
    SELECT 'counted late', NULL, NULL, COUNT(*), NULL FROM {_LATE_ROWS_SQL} e WHERE is_late""")
def s7_late_rows(spark, sf_dir):
    """Windows and late rows hold every event once."""
    out, schema = _merged_windows(spark, sf_dir)
    windows = w.stored_windows(spark, out, schema).select(
        F.lit("window").alias("kept"), "day", "event_type", "readings", (F.col("cents") / 100.0).alias("total"))
    late = spark.read.parquet(f"{out}/late").groupBy(
        F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("readings"), F.sum(amount("value")).alias("cents")).select(
        F.lit("late").alias("kept"), "day", "event_type", "readings", (F.col("cents") / 100.0).alias("total"))
    counted = w.window_progress(spark, out).where("batch_id = 1").select(
        F.lit("counted late").alias("kept"), F.lit(None).cast("string").alias("day"),
        F.lit(None).cast("string").alias("event_type"), F.col("n_late").alias("readings"),
        F.lit(None).cast("double").alias("total"))
    return windows.unionByName(late).unionByName(counted)


@query("s8_window_merge", f"""
    SELECT CAST(day AS TIMESTAMP) AS window_start, event_type, COUNT(*) AS readings,
           {sql_money('value')} AS total, MAX(value) AS highest
    FROM {_LATE_ROWS_SQL} e WHERE NOT is_late GROUP BY day, event_type""")
def s8_window_merge(spark, sf_dir):
    """A second batch changes some days; only these are rewritten."""
    out, schema = _merged_windows(spark, sf_dir)
    return w.stored_windows(spark, out, schema).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "readings",
        (F.col("cents") / 100.0).alias("total"), "highest")


_LATEST_SQL = f"""
    SELECT event_id, ts, {ROUNDED_CODES_SQL}
    FROM {float_codes_sql(f'(SELECT * FROM {READINGS_SQL} r ORDER BY ts DESC, event_id LIMIT 1)')} x
    """


@query("l3_latest_stored", _LATEST_SQL)
def l3_latest_stored(spark, sf_dir):
    """From a table stored by day, of which the last day is read."""
    path = scratch_path(spark, "by-day")
    by_day = readings(spark, sf_dir).withColumn("day", F.to_date("ts"))
    by_day.hint("rebalance", F.col("day")).write.partitionBy("day").parquet(path)
    newest = w.latest_reading(spark.read.parquet(path), "ts", "event_id", partition="day")
    return fire_codes(newest, F.col("month")).select("event_id", "ts", *rounded_codes())


@query("l3_latest_reading", _LATEST_SQL)
def l3_latest_reading(spark, sf_dir):
    newest = w.latest_reading(readings(spark, sf_dir), "ts", "event_id")
    return fire_codes(newest, F.col("month")).select("event_id", "ts", *rounded_codes())


_isi, _bui = indices_sql("f", "d", "c", "v")
_STEP_SQL = codes_sql(
    "(SELECT n.station, n.i, n.day, n.t, n.h, n.v, n.r, CAST(month(n.day) AS INTEGER) AS month, "
    "COALESCE(p.f, 85.0) AS f0, COALESCE(p.d, 6.0) AS d0, COALESCE(p.c, 15.0) AS c0 "
    "FROM codes p JOIN daily n ON n.station = p.station AND n.i = p.i + 1) s",
    ffmc0="f0", dmc0="d0", dc0="c0", keep="station, i, day, v")


_CARRY_SQL = f"""
    WITH RECURSIVE daily AS (
      SELECT user_id AS station, CAST(ts AS DATE) AS day,
             row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE)) AS i,
             AVG(CAST(temperature AS DOUBLE)) AS t, AVG(CAST(rh AS DOUBLE)) AS h,
             AVG(CAST(ws AS DOUBLE)) AS v, SUM(CAST(rain AS DOUBLE)) AS r
      FROM {READINGS_SQL} e GROUP BY user_id, CAST(ts AS DATE)),
    codes AS (
      SELECT DISTINCT station, CAST(0 AS BIGINT) AS i, CAST(NULL AS DATE) AS day,
             CAST(NULL AS DOUBLE) AS v, CAST(NULL AS DOUBLE) AS f, CAST(NULL AS DOUBLE) AS d,
             CAST(NULL AS DOUBLE) AS c FROM daily
      UNION ALL SELECT * FROM {_STEP_SQL} step)
    SELECT station, CAST(day AS VARCHAR) AS day, round(f, 3) AS ffmc, round(d, 3) AS dmc, round(c, 3) AS dc,
           round({_isi}, 3) AS isi, round({_bui}, 3) AS bui
    FROM codes WHERE i > 0"""


@query("s9_fwi_carry", _CARRY_SQL)
def s9_fwi_carry(spark, sf_dir):
    rows = readings(spark, sf_dir).withColumns(
        {c: F.col(c).cast("double") for c in w.FIELDS}).withColumnRenamed("user_id", "station")
    return carried_codes(daily_readings(rows, "station", "ts"), "station").select(
        "station", F.col("day").cast("string").alias("day"), *rounded_codes())


@query("s9_stream_carry", _CARRY_SQL)
def s9_stream_carry(spark, sf_dir):
    """As a stream that lands in three parts, each finished batch written twice, as after a failure."""
    out = scratch_path(spark, "carried")
    rows = readings(spark, sf_dir).select(
        F.col("user_id").alias("station"), F.col("ts").cast("timestamp").alias("ts"),
        *[F.col(c).cast("double").alias(c) for c in w.FIELDS])
    first, last = rows.agg(F.min("ts"), F.max("ts")).first()
    third = (last - first) / 3
    # a reading of no station, long after the others, closes their last day
    end = spark.createDataFrame([(-1, last + timedelta(days=30))], "station bigint, ts timestamp").select(
        "*", *[F.lit(None).cast("double").alias(c) for c in w.FIELDS])
    parts = [rows.where(F.col("ts") < first + third),
             rows.where((F.col("ts") >= first + third) & (F.col("ts") < first + 2 * third)),
             rows.where(F.col("ts") >= first + 2 * third).unionByName(end)]
    sink = w.carry_sink(f"{out}/codes", f"{out}/state", "station", buckets=32)

    def twice(batch, batch_id):
        # the days that the stream closed are worked out once; the session outside the stream plans adaptively
        batch.write.parquet(f"{out}/days/batch_id={batch_id}")
        days = spark.read.schema(batch.schema).parquet(f"{out}/days/batch_id={batch_id}")
        sink(days, batch_id)
        sink(days, batch_id)

    for part in parts:
        part.write.mode("append").parquet(f"{out}/landed")
        stream = spark.readStream.schema(rows.schema).parquet(f"{out}/landed")
        w.daily_stream(stream, "station", "ts", "0 seconds").writeStream.foreachBatch(twice).outputMode(
            "append").option("checkpointLocation", f"{out}/checkpoint").trigger(
            availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{out}/codes").select(
        "station", F.col("day").cast("string").alias("day"), *rounded_codes())
