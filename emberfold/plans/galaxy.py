"""Cleaned hazard tables to nine dimensions and four facts, and their checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberfold.operators.dimensional import (
    build_dimension, build_fact, conformed_dimension, dim_date, with_row_id)
from emberfold.operators.quality import Check, ForeignKey

UNNAMED = "Unnamed"


def build_dimensions(spark: SparkSession, silver: Mapping[str, DataFrame],
                     narrow: bool = False) -> dict[str, DataFrame]:
    quakes, tsunamis = silver["earthquake"], silver["tsunami"]
    slides, volcanoes = silver["landslide"], silver["volcano"]

    def codes(df: DataFrame, column: str, name: str, key: str) -> DataFrame:
        return build_dimension(df, F.col(column), name, key, narrow=narrow)

    return {
        "dim_date": dim_date(spark),
        "dim_location": conformed_dimension(
            [(quakes, F.upper("country")), (volcanoes, F.upper("country")),
             (tsunamis, F.upper("country")), (slides, F.upper("country_name"))],
            "location", "location_key", narrow),
        "dim_volcano": build_dimension(
            volcanoes.where(F.col("volcano_name") != UNNAMED), F.col("volcano_name"),
            "volcano_name", "volcano_key",
            {"elevation": F.abs("elevation"), "volcano_type": F.col("volcano_type"),
             "status": F.col("status")}, narrow),
        "dim_landslide_category": codes(
            slides, "landslide_category", "landslide_category", "category_key"),
        "dim_landslide_trigger": codes(
            slides, "landslide_trigger", "landslide_trigger", "trigger_key"),
        "dim_landslide_size": codes(slides, "landslide_size", "landslide_size", "size_key"),
        "dim_landslide_setting": codes(
            slides, "landslide_setting", "landslide_setting", "setting_key"),
        "dim_tsunami_validity": codes(
            tsunamis, "event_validity", "tsunami_event_validity", "validity_key"),
        "dim_tsunami_cause": codes(tsunamis, "cause_code", "tsunami_cause_code", "cause_key"),
    }


def _fact(df: DataFrame, id_column: str, source_id: str, keys: Mapping[str, Column],
          measures: Sequence[str], narrow: bool) -> DataFrame:
    return build_fact(
        df, (id_column, F.col(source_id)), F.col("day"), F.col("month"), F.col("year"), keys,
        {m: F.col(m) for m in measures}, narrow)


def fact_volcano(silver: DataFrame, narrow: bool = False) -> DataFrame:
    """Eruptions of named volcanoes; the source has no id, so rows get one."""
    named = with_row_id(silver.where(F.col("volcano_name") != UNNAMED), "id_volcano")
    return _fact(
        named, "id_volcano", "id_volcano",
        {"location_key": F.upper("country"), "volcano_key": F.col("volcano_name")},
        ["explosivity", "deaths_description", "total_deaths", "latitude", "longitude"], narrow)


def fact_earthquake(silver: DataFrame, narrow: bool = False) -> DataFrame:
    return _fact(
        silver, "id_earthquake", "id_earthquake", {"location_key": F.upper("country")},
        ["eq_primary", "deaths", "deaths_description", "damage_description", "latitude",
         "longitude"], narrow)


def fact_tsunami(silver: DataFrame, narrow: bool = False) -> DataFrame:
    """Tsunamis with a complete date."""
    rows = _fact(
        silver, "id_tsunami", "id",
        {"location_key": F.upper("country"), "validity_key": F.col("event_validity"),
         "cause_key": F.col("cause_code")},
        ["hour", "minute", "latitude", "longitude", "death_description", "injuries_description",
         "total_deaths", "total_injuries", "houses_destroyed", "houses_damaged"], narrow)
    return rows.where(F.col("date_key").isNotNull())


def fact_landslide(silver: DataFrame, narrow: bool = False) -> DataFrame:
    return _fact(
        silver, "id_landslide", "event_id",
        {"location_key": F.upper("country_name"), "category_key": F.col("landslide_category"),
         "trigger_key": F.col("landslide_trigger"), "size_key": F.col("landslide_size"),
         "setting_key": F.col("landslide_setting")},
        ["fatality_count", "injury_count", "longitude", "latitude", "hour", "minute"], narrow)


FACTS = {"fact_volcano": fact_volcano, "fact_earthquake": fact_earthquake,
         "fact_tsunami": fact_tsunami, "fact_landslide": fact_landslide}


def build_facts(silver: Mapping[str, DataFrame], narrow: bool = False) -> dict[str, DataFrame]:
    return {name: build(silver[name.removeprefix("fact_")], narrow)
            for name, build in FACTS.items()}


# Key and natural column of the dimensions that hold just these two.
CODE_DIMENSIONS = {
    "dim_location": ("location_key", "location"),
    "dim_tsunami_validity": ("validity_key", "tsunami_event_validity"),
    "dim_tsunami_cause": ("cause_key", "tsunami_cause_code"),
    "dim_landslide_category": ("category_key", "landslide_category"),
    "dim_landslide_trigger": ("trigger_key", "landslide_trigger"),
    "dim_landslide_size": ("size_key", "landslide_size"),
    "dim_landslide_setting": ("setting_key", "landslide_setting"),
}

# Foreign keys of each fact with the dimension they point to.
FOREIGN_KEYS = {
    "fact_earthquake": {"date_key": "dim_date", "location_key": "dim_location"},
    "fact_volcano": {"date_key": "dim_date", "location_key": "dim_location",
                     "volcano_key": "dim_volcano"},
    "fact_tsunami": {"date_key": "dim_date", "location_key": "dim_location",
                     "validity_key": "dim_tsunami_validity", "cause_key": "dim_tsunami_cause"},
    "fact_landslide": {"date_key": "dim_date", "location_key": "dim_location",
                       "category_key": "dim_landslide_category",
                       "trigger_key": "dim_landslide_trigger",
                       "size_key": "dim_landslide_size",
                       "setting_key": "dim_landslide_setting"},
}
FACTS_WITH_COORDINATES = ("fact_earthquake", "fact_volcano", "fact_landslide")


def gold_checks(gold: Mapping[str, DataFrame]) -> list[tuple[DataFrame, Check]]:
    """The 73 constraints of the 13 tables."""
    checks = [
        (gold["dim_date"], Check("dim_date").is_complete("date_key").is_unique("date_key")
         .has_completeness("full_date", lambda share: share == 1.0)),
        (gold["dim_volcano"], Check("dim_volcano").is_complete("volcano_key", "volcano_name")
         .is_unique("volcano_key").has_completeness("elevation", lambda share: share > 0.9)
         .satisfies("elevation > 0", "Elevation Must Be Positive")),
    ]
    for name, (key, natural) in CODE_DIMENSIONS.items():
        checks.append((gold[name], Check(name).is_complete(key, natural).is_unique(key)))
    for name, keys in FOREIGN_KEYS.items():
        fact_id = name.replace("fact_", "id_")
        check = Check(name).is_complete(fact_id, *keys).is_unique(fact_id)
        if name in FACTS_WITH_COORDINATES:
            check.satisfies("latitude BETWEEN -90 AND 90", "Valid Latitude")
            check.satisfies("longitude BETWEEN -180 AND 180", "Valid Longitude")
        for key, dim in keys.items():
            label = f"{key.replace('_', ' ').title()} Missing in {dim}"
            check.has_parent(label, ForeignKey(key, gold[dim], key))
        checks.append((gold[name], check))
    return checks
