"""Fire codes that start from the codes of the day before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberfold.functions import fire

CODES = ["ffmc", "dmc", "dc"]
# The fold takes its result type from its start value, so that type has to
# allow NULL codes.
_FOLDED = "array<struct<day: date, ffmc: double, dmc: double, dc: double>>"
# Days folded in one go. Appending a day copies the days of its block, appending a block
# those of all blocks, so the copies per day stay few.
_BLOCK = 365


def daily_readings(df: DataFrame, station: str, ts: str) -> DataFrame:
    """One reading per station and day: mean temperature, humidity, wind; sum of rain."""
    return df.groupBy(station, F.to_date(ts).alias("day")).agg(
        F.avg("temperature").alias("temperature"), F.avg("rh").alias("rh"),
        F.avg("ws").alias("ws"), F.sum("rain").alias("rain"))


def _next_day(codes: Column, r: Column) -> Column:
    before = F.element_at(codes, -1)
    ffmc, dmc, dc = (
        F.coalesce(before[c], F.lit(start)) for c, start in
        zip(CODES, (fire.START_FFMC, fire.START_DMC, fire.START_DC)))
    month = F.month(r["day"])
    return F.concat(codes, F.array(F.struct(
        r["day"].alias("day"),
        fire.ffmc(r["rh"], r["rain"], ffmc).alias("ffmc"),
        fire.dmc(r["temperature"], r["rh"], r["rain"], month, dmc).alias("dmc"),
        fire.dc(r["temperature"], r["rain"], month, dc).alias("dc"))))


def carried_codes(daily: DataFrame, station: str, before: DataFrame | None = None) -> DataFrame:
    """``day, ffmc, dmc, dc, isi, bui`` per station, each day building on the last.

    ``before`` holds the last codes of stations seen earlier (``station, ffmc,
    dmc, dc``); other stations begin with the fixed start codes.

    The recurrence runs in order within a station. Its input is one row per
    station and day, so a station can never hold more rows than the calendar
    has days, however many readings it sent.
    """
    rows = F.array_sort(F.collect_list(F.struct("day", "temperature", "rh", "ws", "rain")))
    grouped = daily.groupBy(station).agg(rows.alias("_rows"))
    if before is not None:
        grouped = grouped.join(before.select(station, *CODES), station, "left")
    else:
        grouped = grouped.withColumns({c: F.lit(None).cast("double") for c in CODES})
    start = F.array(F.struct(
        F.lit(None).cast("date").alias("day"), *[F.col(c) for c in CODES])).cast(_FOLDED)
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("_rows") - 1) / _BLOCK).cast("int")),
        lambda k: F.slice("_rows", k * _BLOCK + 1, F.lit(_BLOCK)))
    folded = grouped.select(station, "_rows", F.slice(
        F.aggregate(blocks, start, lambda codes, block: F.concat(codes, F.slice(F.aggregate(
            block, F.slice(codes, -1, 1).cast(_FOLDED), _next_day), F.lit(2), F.size(block)))),
        2, F.size("_rows")).alias("_codes"))
    per_day = folded.select(
        station, F.explode(F.arrays_zip("_rows", "_codes")).alias("_d")).select(
        station, "_d._rows.day", "_d._rows.ws",
        *[F.col("_d._codes")[c].alias(c) for c in CODES])
    return per_day.select(
        station, "day", *CODES, fire.isi(F.col("ffmc"), F.col("ws")).alias("isi"),
        fire.bui(F.col("dmc"), F.col("dc")).alias("bui"))


def last_codes(codes: DataFrame, station: str, before: DataFrame | None = None) -> DataFrame:
    """The latest codes per station, from ``codes`` where it has the station."""
    newest = codes.select(station, "day", *CODES)
    if before is not None:
        newest = newest.unionByName(before)
    return newest.groupBy(station).agg(
        F.max_by(F.struct("day", *CODES), "day").alias("_r")).select(station, "_r.*")
