"""Raw hazard feeds to cleaned tables.

Every feed arrives as text columns under its own header names and leaves typed,
with snake_case names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberfold.functions.scalars import (
    any_present, castable, clean_token, dated_or_counted, decode, pair_part, timestamp_parts,
    whole_number)
from emberfold.operators.joins import Lookup
from emberfold.operators.repair import (
    Box, bbox_range_join, fill_from_lookup, impute_group_mode, keep_first, override_by_key)
from emberfold.plans import fixed_values as fixed
from emberfold.sources.files import project
from emberfold.storage import materialize

# Columns read from each feed, and their names from here on.
EARTHQUAKE_COLUMNS = {
    "ID Earthquake": "id_earthquake", "Year": "year", "Month": "month", "Day": "day",
    "EQ Primary": "eq_primary", "Country": "country", "Earthquake : Deaths": "deaths",
    "Earthquake : Deaths Description": "deaths_description",
    "Earthquake : Damage Description": "damage_description", "Coordinates": "coordinates",
}
TSUNAMI_COLUMNS = {
    "Sr.no": "id", "Year": "year", "Mo": "month", "Dy": "day", "Hr": "hour", "Mn": "minute",
    "Country": "country", "LocationNanName": "location", "Latitude": "latitude",
    "Longitude": "longitude", "DeathNanDescription": "death_description",
    "InjuriesNanDescription": "injuries_description", "TotalNanDeaths": "total_deaths",
    "TotalNanInjuries": "total_injuries", "TsunamiNanEventNanValidity": "event_validity",
    "TsunamiNanCauseNanCode": "cause_code", "TotalNanHousesNanDestroyed": "houses_destroyed",
    "TotalNanHousesNanDamaged": "houses_damaged",
}
LANDSLIDE_COLUMNS = [
    "event_id", "event_date", "landslide_category", "landslide_trigger", "landslide_size",
    "landslide_setting", "fatality_count", "injury_count", "country_name", "longitude",
    "latitude",
]
LANDSLIDE_IMPUTED = [
    "landslide_category", "landslide_trigger", "landslide_size", "landslide_setting",
]
LANDSLIDE_DATE_FORMAT = "MM/dd/yyyy hh:mm:ss a"
VOLCANO_COLUMNS = {
    "Year": "year", "Month": "month", "Day": "day", "Volcano Name": "volcano_name",
    "Country": "country", "Elevation": "elevation", "Volcano Type": "volcano_type",
    "Status": "status", "Volcanic Explosivity Index": "explosivity",
    "Volcano : Deaths Description": "deaths_description",
    "Total Effects : Deaths": "total_deaths", "Coordinates": "coordinates",
}

EARTHQUAKE_OVERRIDES = Lookup(
    "id_earthquake int, year int, coordinates string", ("id_earthquake", "year"),
    fixed.EARTHQUAKE_COORDINATES)
EARTHQUAKE_DATES = Lookup(
    "id_earthquake int, month int, day int", ("id_earthquake",), fixed.EARTHQUAKE_DATES)
TSUNAMI_PLACES = Lookup(
    "country string, location string, longitude double, latitude double",
    ("country", "location"), fixed.TSUNAMI_COORDINATES)
ERUPTION_DATES = Lookup(
    "volcano_name string, year int, country string, month int, day int",
    ("volcano_name", "year", "country"), fixed.ERUPTION_DATES)
COUNTRY_BOXES = [Box(*row) for row in fixed.COUNTRY_BOXES]


def _whole(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: whole_number(c) for c in columns})


def _number(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})


def _located(df: DataFrame, kind: str) -> DataFrame:
    pair = F.col("coordinates")
    return df.withColumns({
        "latitude": pair_part(pair, 0).cast(kind), "longitude": pair_part(pair, 1).cast(kind),
    }).drop("coordinates")


def clean_earthquakes(raw: DataFrame, overrides: Lookup | DataFrame = EARTHQUAKE_OVERRIDES,
                      dates: Lookup | DataFrame = EARTHQUAKE_DATES) -> DataFrame:
    typed = _number(_whole(
        project(raw, list(EARTHQUAKE_COLUMNS), list(EARTHQUAKE_COLUMNS.values())),
        "id_earthquake", "year", "month", "day", "deaths", "deaths_description",
        "damage_description"), "eq_primary")
    kept = typed.where(F.col("year") > 0).where(
        dated_or_counted([F.col("month"), F.col("day")], F.col("deaths")))
    placed = override_by_key(kept, overrides, ["id_earthquake", "year"], ["coordinates"])
    dated = fill_from_lookup(placed, dates, ["id_earthquake"], ["month", "day"])
    return _located(dated, "float")


def clean_tsunamis(raw: DataFrame, places: Lookup | DataFrame = TSUNAMI_PLACES) -> DataFrame:
    typed = _number(_whole(
        project(raw, list(TSUNAMI_COLUMNS), list(TSUNAMI_COLUMNS.values())),
        "id", "year", "month", "day", "hour", "minute", "death_description",
        "injuries_description", "total_deaths", "total_injuries", "event_validity",
        "cause_code", "houses_destroyed", "houses_damaged"), "latitude", "longitude")
    kept = typed.where(F.col("event_validity") != -1).where(
        any_present(F.col("month"), F.col("day")))
    named = kept.withColumns({c: clean_token(F.col(c)) for c in ("country", "location")})
    placed = fill_from_lookup(named, places, ["country", "location"], ["longitude", "latitude"])
    return placed.withColumns({
        "event_validity": decode("event_validity", fixed.TSUNAMI_VALIDITY),
        "cause_code": decode("cause_code", fixed.TSUNAMI_CAUSE),
        "death_description": decode("death_description", fixed.DEATHS_SCALE),
        "injuries_description": decode("injuries_description", fixed.INJURIES_SCALE),
    })


def clean_landslides(raw: DataFrame, boxes: list[Box] = COUNTRY_BOXES) -> DataFrame:
    read = project(raw, LANDSLIDE_COLUMNS)
    counts = ["fatality_count", "injury_count"]
    usable = read.where(castable(F.col("longitude"), "double"))
    for c in counts:
        usable = usable.where(whole_number(c).isNotNull() | F.col(c).isNull())
    typed = _number(_whole(usable, "event_id", *counts), "longitude", "latitude")
    single = keep_first(typed, [c for c in LANDSLIDE_COLUMNS if c != "event_id"], ["event_id"])
    timed = single.withColumn(
        "event_date", F.try_to_timestamp("event_date", F.lit(LANDSLIDE_DATE_FORMAT))
    ).withColumns(timestamp_parts(F.col("event_date"))).drop("event_date")
    labelled = bbox_range_join(timed, "longitude", "latitude", boxes, "country_name")
    # imputing reads its input twice; the stored rows spare a second deduplication
    stored = materialize(labelled, "labelled-landslides")
    return impute_group_mode(stored, "country_name", LANDSLIDE_IMPUTED, is_stored=True)


def clean_volcanoes(raw: DataFrame, dates: Lookup | DataFrame = ERUPTION_DATES) -> DataFrame:
    typed = _whole(
        project(raw, list(VOLCANO_COLUMNS), list(VOLCANO_COLUMNS.values())),
        "year", "month", "day", "elevation", "explosivity", "deaths_description",
        "total_deaths")
    single = typed.where(F.col("year") > 0).distinct()
    dated = fill_from_lookup(
        single, dates, ["volcano_name", "year", "country"], ["month", "day"])
    return _located(dated, "double").withColumn(
        "explosivity", decode("explosivity", fixed.EXPLOSIVITY))
