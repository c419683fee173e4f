"""Weather readings: message parsing, fire features, sinks, windowed metrics."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from emberfold.functions.fire import fire_codes
from emberfold.functions.scalars import any_present, row_digest
from emberfold.operators.carry import CODES, carried_codes, last_codes
from emberfold.sources.parts import PartTable, parts_of
from emberfold.storage import materialize

# Fields of a reading and of the provider's payload.
MESSAGE_SCHEMA = "Temperature float, RH float, Ws float, Rain float"
PAYLOAD_SCHEMA = (
    "main struct<temp: double, humidity: double>, wind struct<speed: double>, "
    "rain struct<`1h`: double>")
KMH_PER_MS = 3.6

FIELDS = {"temperature": "Temperature", "rh": "RH", "ws": "Ws", "rain": "Rain"}


def text_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Messages as lines of text files, in a column ``value``."""
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def kafka_stream(spark: SparkSession, servers: str, topic: str,
                 options: Mapping[str, str] | None = None) -> DataFrame:
    """Messages of a topic from its beginning; needs the Kafka connector."""
    return (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic).option("startingOffsets", "earliest")
        .options(**(options or {})).load())


def parse_messages(df: DataFrame, value: str = "value") -> DataFrame:
    """Add the four readings as floats; a field that does not parse is NULL."""
    data = F.from_json(F.col(value).cast("string"), MESSAGE_SCHEMA)
    parsed = df.withColumn("_data", data)
    return parsed.select(
        "*", *[F.col("_data")[f].alias(name) for name, f in FIELDS.items()]).drop("_data")


def is_reading() -> Column:
    """False for messages without a single usable field: those go to quarantine."""
    return any_present(*[F.col(name) for name in FIELDS])


def normalize_payload(df: DataFrame, payload: str) -> DataFrame:
    """Add readings from the provider's JSON: wind to km/h, missing rain to 0."""
    # a column of its own, so that each payload is parsed once and not once per field
    parsed = df.withColumn("_data", F.from_json(payload, PAYLOAD_SCHEMA))
    return parsed.withColumns({
        "temperature": F.col("_data.main.temp"), "rh": F.col("_data.main.humidity"),
        "ws": F.col("_data.wind.speed") * KMH_PER_MS,
        "rain": F.coalesce(F.col("_data.rain.1h"), F.lit(0.0)),
    }).drop("_data")


def to_message() -> Column:
    """Readings as a JSON message."""
    return F.to_json(F.struct(*[F.col(name).alias(f) for name, f in FIELDS.items()]))


def weather_features(df: DataFrame, month: Column | None = None) -> DataFrame:
    """Readings with their fire codes, batch or stream; the month defaults to today's."""
    return fire_codes(df, F.month(F.current_date()) if month is None else month)


# Equal messages are numbered in blocks of so many, which tasks share out.
COPY_BLOCK = 10_000


def with_message_id(batch: DataFrame, batch_id: int) -> DataFrame:
    """Add ``id``, the same when the batch is replayed.

    A digest of the message's position where the source gives one. Otherwise of the batch
    and the whole row, equal rows being numbered: they are counted first, so a message
    with many copies is one row when it moves, and counted out again in blocks.
    """
    position = ["topic", "partition", "offset"]
    if set(position) <= set(batch.columns):
        return batch.withColumn("id", row_digest(*[F.col(c) for c in position]))
    rows = [F.col(f"`{c}`") for c in batch.columns]
    counted = batch.groupBy(*rows).agg(F.count(F.lit(1)).alias("_n"))
    blocks = counted.withColumn("_first", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.col("_n") - 1, F.lit(COPY_BLOCK).cast("bigint")))).hint("rebalance")
    copies = blocks.withColumn("_copy", F.explode(F.sequence(
        F.col("_first"), F.least(F.col("_first") + COPY_BLOCK, F.col("_n")) - 1)))
    return copies.select(*rows, row_digest(F.lit(batch_id), *rows, F.col("_copy")).alias("id"))


def batch_sinks(raw_path: str, feature_path: str, quarantine_path: str | None = None,
                month: Column | None = None, clock: Column | None = None) -> Callable[[DataFrame, int], None]:
    """Writer of one micro-batch to a raw, a feature and a quarantine table.

    Features carry the ingestion time of ``clock``, by default the time the batch is written.

    Every batch owns one folder per table and overwrites it, so a batch that is
    replayed after a failure leaves no second copy. Errors are not caught: the
    batch fails and is replayed from the checkpoint.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            raw = batch.select(to_message().alias("document"))
            raw.write.mode("overwrite").parquet(f"{raw_path}/batch_id={batch_id}")
            readings = with_message_id(batch.where(is_reading()), batch_id)
            features = weather_features(readings, month).select(
                "id", *FIELDS, "ffmc", "dmc", "dc", "isi", "bui",
                (F.current_timestamp() if clock is None else clock).alias("ingestion_time"))
            features.write.mode("overwrite").parquet(f"{feature_path}/batch_id={batch_id}")
            if quarantine_path:
                batch.where(~is_reading()).write.mode("overwrite").parquet(
                    f"{quarantine_path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return write


def start_sinks(messages: DataFrame, sinks: Callable[[DataFrame, int], None], checkpoint: str,
                every: str | None = None) -> StreamingQuery:
    """Parse a message stream into the sinks; without ``every``, up to its present end."""
    writer = (
        parse_messages(messages).writeStream.foreachBatch(sinks).outputMode("append")
        .option("checkpointLocation", checkpoint))
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def latest_reading(features: DataFrame, time: str = "ingestion_time", tie: str = "id",
                   partition: str | None = None) -> DataFrame:
    """The newest row.

    ``partition`` names a partition column that never falls while ``time`` rises, such as the
    sinks' ``batch_id`` or a day. Its largest value is looked up without reading any
    stored column, and only that partition is then read.
    """
    if partition is not None:
        newest = features.agg(F.max(partition)).first()[0]
        features = features.where(F.col(partition).eqNullSafe(F.lit(newest)))
    return features.orderBy(F.col(time).desc(), F.col(tie).asc()).limit(1)


def window_metrics(df: DataFrame, ts: str, by: str, width: str, measures: Mapping[str, Column],
                   late: str | None = None) -> DataFrame:
    """Tumbling-window aggregates, batch or stream; ``late`` sets the watermark."""
    timed = df.withColumn(ts, F.col(ts).cast("timestamp"))
    if late:
        timed = timed.withWatermark(ts, late)
    grouped = timed.groupBy(F.window(ts, width).alias("w"), by).agg(
        *[c.alias(m) for m, c in measures.items()])
    return grouped.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), by, *measures)


def versioned_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Writer of updated window rows, one folder per batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def newest_version(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The last written row of every key of a versioned sink."""
    rows = spark.read.parquet(path)
    rest = [c for c in rows.columns if c not in (*keys, "batch_id")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("_r")).select(
        *keys, "_r.*")


def daily_stream(df: DataFrame, station: str, ts: str, late: str) -> DataFrame:
    """Daily readings of a stream; a day comes out once, when its watermark has passed."""
    timed = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    grouped = timed.groupBy(F.window(ts, "1 day").alias("w"), station).agg(
        F.avg("temperature").alias("temperature"), F.avg("rh").alias("rh"),
        F.avg("ws").alias("ws"), F.sum("rain").alias("rain"))
    return grouped.select(station, F.to_date("w.start").alias("day"),
                          "temperature", "rh", "ws", "rain")


# Parts of the stations' state; each is rewritten whole, so many small ones.
STATE_BUCKETS = 256


def carry_sink(code_path: str, state_path: str, station: str,
               buckets: int = STATE_BUCKETS) -> Callable[[DataFrame, int], None]:
    """Writer of carried codes for finished days.

    The state, a row per station, lies in ``buckets`` parts by a hash of the station. Batch N reads the parts of its own
    stations as batch N - 1 left them and writes these parts alone; a replay of N therefore computes and
    overwrites the same, and stations that are silent cost nothing.
    """
    state = PartTable(state_path, "bucket")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64(station), F.lit(buckets)).cast("int")
        schema = batch.select(station, "day", *[F.lit(None).cast("double").alias(c) for c in CODES],
                              bucket.alias("bucket")).schema
        index = state.index(spark, batch_id - 1)
        batch = batch.persist()
        try:
            touched = parts_of(batch.select(bucket.alias("bucket")), "bucket")
            before = state.read(spark, schema, index, touched).drop("bucket")
            codes = carried_codes(batch, station, before)
            path = f"{code_path}/batch_id={batch_id}"
            codes.write.mode("overwrite").parquet(path)
        finally:
            batch.unpersist()
        stored = spark.read.schema(codes.schema).parquet(path)
        state.write(last_codes(stored, station, before).withColumn("bucket", bucket), batch_id, index, touched)

    return write


def last_states(spark: SparkSession, state_path: str, schema: StructType) -> DataFrame:
    """The last day and codes of every station, with its ``bucket``."""
    state = PartTable(state_path, "bucket")
    return state.read(spark, schema, state.index(spark))


class Measure(NamedTuple):
    """An aggregate of rows, and how its parts are merged: ``Measure(F.count(F.lit(1)), F.sum)``."""

    part: Column
    merge: Callable[[str], Column]


def window_sink(path: str, ts: str, by: str, width: str, measures: Mapping[str, Measure],
                late: str) -> Callable[[DataFrame, int], None]:
    """Writer of tumbling windows that keeps late rows.

    The watermark is the latest time of the batches before, less ``late``. A row whose window ends at or before it is late
    and goes to ``<path>/late/batch_id=N``, as do rows without a time; nothing vanishes. All others are reduced to
    their windows and merged into ``<path>/windows``, parts by the day a window starts on, of which a batch reads
    and rewrites only those it changes. ``<path>/progress/batch_id=N`` has the latest time and how many
    rows were late so far. A replayed batch starts from what the batch before left and gives the same.
    """
    table = PartTable(f"{path}/windows", "day")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        index = table.index(spark, batch_id - 1)
        latest, n_late = None, 0
        if batch_id > 0:
            latest, n_late = window_progress(spark, path).where(F.col("batch_id") == batch_id - 1).select(
                "latest", "n_late").first()
        timed = batch.withColumn(ts, F.col(ts).cast("timestamp"))
        # a window is told by its own start, so that rows without a time keep their place
        start = F.window(F.coalesce(F.col(ts), F.lit(0).cast("timestamp")), width)
        mark = F.lit(latest).cast("timestamp") - F.expr(f"INTERVAL {late}")
        is_late = F.col(ts).isNull() | F.coalesce(F.col("_w.end") <= mark, F.lit(False))
        rows = timed.withColumn("_w", start).withColumn("_late", is_late).persist()
        try:
            rows.where("_late").drop("_w", "_late").write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")
            parts = materialize(rows.where("not _late").groupBy(
                F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), by).agg(
                *[m.part.alias(name) for name, m in measures.items()]).withColumn(
                "day", F.date_format("window_start", "yyyy-MM-dd")), "window-parts")
            new_latest, new_late = rows.agg(F.max(ts), F.count_if("_late")).first()
        finally:
            rows.unpersist()
        touched = parts_of(parts, "day")  # the days that a batch spans
        keys = ["window_start", "window_end", by, "day"]
        merged = parts.unionByName(table.read(spark, parts.schema, index, touched)).groupBy(*keys).agg(
            *[m.merge(name).alias(name) for name, m in measures.items()])
        table.write(merged, batch_id, index, touched)
        times = [t for t in (latest, new_latest) if t is not None]
        spark.createDataFrame([(max(times, default=None), n_late + new_late)], _PROGRESS).coalesce(1).write.mode(
            "overwrite").parquet(f"{path}/progress/batch_id={batch_id}")

    return write


_PROGRESS = "latest timestamp, n_late bigint"


def window_progress(spark: SparkSession, path: str) -> DataFrame:
    """Per batch of a :func:`window_sink`: ``latest, n_late, batch_id``."""
    return spark.read.schema(f"{_PROGRESS}, batch_id bigint").parquet(f"{path}/progress")


def stored_windows(spark: SparkSession, path: str, schema: StructType, days: list[str] | None = None) -> DataFrame:
    """Windows of a :func:`window_sink`, of all days or of some."""
    table = PartTable(f"{path}/windows", "day")
    return table.read(spark, schema, table.index(spark), days)
