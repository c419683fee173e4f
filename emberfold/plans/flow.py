"""The batch flow in order: clean, publish, model, publish, check."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberfold.operators.quality import gate, run_checks
from emberfold.plans.cleaning import (
    clean_earthquakes, clean_landslides, clean_tsunamis, clean_volcanoes)
from emberfold.plans.galaxy import build_dimensions, build_facts, gold_checks
from emberfold.sources.files import read_csv
from emberfold.sources.tables import ensure_schema, publish, publish_all
from emberfold.storage import run_together

CLEANERS = {
    "earthquake": clean_earthquakes, "tsunami": clean_tsunamis,
    "landslide": clean_landslides, "volcano": clean_volcanoes,
}

# Path below the landing zone, and separator, of each feed.
FEEDS = {
    "earthquake": ("earthquakes/significant-earthquake-database.csv", ";"),
    "tsunami": ("tsunami-events-dataset-1900-present/"
                "tsunamis-2023-09-11_22-13-51_ 0530 (2).csv", ","),
    "landslide": ("global-landslide-data/Global_Landslide_Catalog_Export.csv", ","),
    "volcano": ("significant-volcanic-eruption-database/"
                "significant-volcanic-eruption-database.csv", ";"),
}


def read_feeds(spark: SparkSession, bronze: str) -> dict[str, DataFrame]:
    return {
        name: read_csv(spark, f"{bronze.rstrip('/')}/{path}", sep=sep)
        for name, (path, sep) in FEEDS.items()}


def run_batch(spark: SparkSession, feeds: Mapping[str, DataFrame], root: str,
              silver_schema: str = "silver", gold_schema: str = "gold",
              narrow: bool = False, enforce: bool = True,
              by_decade: bool = False) -> dict[str, DataFrame]:
    """Run everything and return the gold tables and ``check_results``.

    Each stage reads the stored tables of the one before, so no cleaning is
    repeated for the 13 gold tables. The check results are stored before the
    gate may raise. ``by_decade`` adds that column to the facts and partitions
    them by it, so that a query over some years reads only their files.
    """
    def clean(name: str, raw: DataFrame) -> DataFrame:
        return publish(CLEANERS[name](raw), silver_schema, f"df_{name}", root)

    ensure_schema(spark, silver_schema)
    silver = run_together({name: partial(clean, name, raw) for name, raw in feeds.items()})
    facts, layout = build_facts(silver, narrow), {}
    if by_decade:
        year = F.col("date_key") % 10_000  # the last four digits of DDMMYYYY
        facts = {name: df.withColumn("decade", year - year % 10) for name, df in facts.items()}
        layout = {name: ["decade"] for name in facts}
    gold = publish_all(
        {**build_dimensions(spark, silver, narrow), **facts}, gold_schema, root, layout)
    results = publish(run_checks(gold_checks(gold)), gold_schema, "check_results", root)
    if enforce:
        gate(results)
    return {**gold, "check_results": results}
