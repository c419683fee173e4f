"""The hazard flow: four cleaned tables, dimensions, facts, checks, rollups."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberfold.operators.quality import run_checks
from emberfold.operators.rollups import drill_across, impact_by
from emberfold.plans import cleaning, fixed_values as fixed, galaxy
from emberfold.plans.flow import FEEDS
from emberfold.queries import feeds
from emberfold.queries.base import query, sql_decode
from emberfold.queries.repairs import boxes_sql, lookup_sql
from emberfold.sources.files import read_csv
from emberfold.storage import materialize, run_together, scratch_path


def _ints(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS INTEGER) AS {c.split('.')[-1]}" for c in columns)


def _lat_lon(kind: str) -> str:
    return ", ".join(
        f"CAST(TRY_CAST(trim(list_extract(regexp_split_to_array(coordinates, ',\\s*'), {i})) "
        f"AS DOUBLE) AS {kind}) AS {n}" for i, n in ((1, "latitude"), (2, "longitude")))


EARTHQUAKE_SILVER = f"""(SELECT {_ints('id_earthquake', 'year', 'month', 'day')}, eq_primary,
    country, {_ints('deaths', 'deaths_description', 'damage_description')}, {_lat_lon('FLOAT')}
  FROM (SELECT q.id AS id_earthquake, q.year, COALESCE(q.month, f.month) AS month,
               COALESCE(q.day, f.day) AS day, q.eq_primary, q.country, q.deaths,
               q.deaths_description, q.damage_description,
               CASE WHEN c.id_earthquake IS NOT NULL THEN c.coordinates ELSE q.coordinates END
                 AS coordinates
        FROM {feeds.EARTHQUAKES_SQL} q
        LEFT JOIN {lookup_sql(cleaning.EARTHQUAKE_OVERRIDES, 'c')}
          ON q.id = c.id_earthquake AND q.year = c.year
        LEFT JOIN {lookup_sql(cleaning.EARTHQUAKE_DATES, 'f')} ON q.id = f.id_earthquake
        WHERE q.year > 0 AND NOT ((q.month IS NULL OR q.day IS NULL) AND q.deaths IS NULL)) x)"""

TSUNAMI_SILVER = f"""(SELECT {_ints('id', 'year', 'month', 'day', 'hour', 'minute')},
    t.country, t.location, CAST(COALESCE(t.latitude, p.latitude) AS DOUBLE) AS latitude,
    CAST(COALESCE(t.longitude, p.longitude) AS DOUBLE) AS longitude,
    {sql_decode('death_description', fixed.DEATHS_SCALE)} AS death_description,
    {sql_decode('injuries_description', fixed.INJURIES_SCALE)} AS injuries_description,
    {_ints('total_deaths', 'total_injuries')},
    {sql_decode('event_validity', fixed.TSUNAMI_VALIDITY)} AS event_validity,
    {sql_decode('cause_code', fixed.TSUNAMI_CAUSE)} AS cause_code,
    {_ints('houses_destroyed', 'houses_damaged')}
  FROM {feeds.TSUNAMIS_SQL} t LEFT JOIN {lookup_sql(cleaning.TSUNAMI_PLACES, 'p')}
    ON t.country = p.country AND t.location = p.location
  WHERE event_validity <> -1 AND (month IS NOT NULL OR day IS NOT NULL))"""

_SUBSET = [c for c in cleaning.LANDSLIDE_COLUMNS if c != "event_id"]
_LABELLED = f"""(SELECT * REPLACE (COALESCE(country_name,
      {boxes_sql(cleaning.COUNTRY_BOXES, 'longitude', 'latitude')}) AS country_name),
    TRY_STRPTIME(event_date, '%m/%d/%Y %I:%M:%S %p') AS t
  FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(_SUBSET)} ORDER BY event_id) AS r
        FROM (SELECT * REPLACE (TRY_CAST(longitude AS DOUBLE) AS longitude,
                                TRY_CAST(fatality_count AS INTEGER) AS fatality_count)
              FROM {feeds.LANDSLIDES_SQL} f
              WHERE TRY_CAST(longitude AS DOUBLE) IS NOT NULL AND (
                TRY_CAST(fatality_count AS INTEGER) IS NOT NULL OR fatality_count IS NULL)) s) d
  WHERE r = 1)"""


def _imputed(column: str) -> str:
    return (f"COALESCE({column}, CASE WHEN country_name IS NOT NULL THEN COALESCE((SELECT v FROM "
            f"(SELECT country_name AS g, {column} AS v, row_number() OVER (PARTITION BY "
            f"country_name ORDER BY COUNT(*) DESC, {column} ASC NULLS LAST) AS r FROM labelled "
            f"WHERE country_name IS NOT NULL GROUP BY 1, 2) m WHERE r = 1 AND "
            f"m.g = l.country_name), 'unknown') END) AS {column}")


LANDSLIDE_SILVER = f"""(WITH labelled AS {_LABELLED}
  SELECT {_ints('event_id')}, {', '.join(_imputed(c) for c in cleaning.LANDSLIDE_IMPUTED)},
         {_ints('fatality_count', 'injury_count')}, country_name, longitude, latitude,
         CAST(year(t) AS INTEGER) AS year, CAST(month(t) AS INTEGER) AS month,
         CAST(day(t) AS INTEGER) AS day, CAST(hour(t) AS INTEGER) AS hour,
         CAST(minute(t) AS INTEGER) AS minute
  FROM labelled l)"""

VOLCANO_SILVER = f"""(SELECT CAST(v.year AS INTEGER) AS year,
    CAST(COALESCE(v.month, d.month) AS INTEGER) AS month,
    CAST(COALESCE(v.day, d.day) AS INTEGER) AS day, v.volcano_name, v.country,
    {_ints('elevation')}, volcano_type, status,
    {sql_decode('explosivity', fixed.EXPLOSIVITY)} AS explosivity,
    {_ints('deaths_description', 'total_deaths')}, {_lat_lon('DOUBLE')}
  FROM (SELECT DISTINCT * FROM {feeds.VOLCANOES_SQL} x WHERE year > 0) v
  LEFT JOIN {lookup_sql(cleaning.ERUPTION_DATES, 'd')}
    ON v.volcano_name = d.volcano_name AND v.year = d.year AND v.country = d.country)"""


# Cleaning reads landed CSV files and modelling reads stored tables, as in the
# batch flow. Both are stored once per application and folder, when a query
# first needs them.
_STORED: dict[tuple[str, str, str], DataFrame] = {}


def _once(spark, sf_dir, name: str, build) -> DataFrame:
    place = (spark.sparkContext.applicationId, sf_dir, name)
    if place not in _STORED:
        _STORED[place] = build()
    return _STORED[place]


def _stored(spark, sf_dir, name: str, build) -> DataFrame:
    return _once(spark, sf_dir, name, lambda: materialize(build(), name))


# A packed file is read by one task, so a feed lands in files of so many rows.
LANDED_ROWS = 50_000


def _feed(spark, sf_dir, name: str, shape) -> DataFrame:
    """A feed as packed CSV files, written where its rows are read, without a shuffle."""
    def land():
        path, sep = scratch_path(spark, f"feed-{name}"), FEEDS[name][1]
        shape(spark, sf_dir).write.options(
            header=True, sep=sep, compression="gzip", maxRecordsPerFile=LANDED_ROWS,
            **{"zlib.compress.level": "BEST_SPEED"}).csv(path)
        return read_csv(spark, path, sep=sep)

    return _once(spark, sf_dir, f"feed-{name}", land)


@query("silver_earthquake", f"SELECT * FROM {EARTHQUAKE_SILVER} s")
def silver_earthquake(spark, sf_dir):
    return cleaning.clean_earthquakes(_feed(spark, sf_dir, "earthquake", feeds.earthquakes))


@query("silver_tsunami", f"SELECT * FROM {TSUNAMI_SILVER} s")
def silver_tsunami(spark, sf_dir):
    return cleaning.clean_tsunamis(_feed(spark, sf_dir, "tsunami", feeds.tsunamis))


@query("silver_landslide", f"SELECT * FROM {LANDSLIDE_SILVER} s")
def silver_landslide(spark, sf_dir):
    return cleaning.clean_landslides(_feed(spark, sf_dir, "landslide", feeds.landslides))


@query("silver_volcano", f"SELECT * FROM {VOLCANO_SILVER} s")
def silver_volcano(spark, sf_dir):
    return cleaning.clean_volcanoes(_feed(spark, sf_dir, "volcano", feeds.volcanoes))


def _silver(spark, sf_dir) -> dict[str, DataFrame]:
    cleaners = {"earthquake": silver_earthquake, "tsunami": silver_tsunami,
                "landslide": silver_landslide, "volcano": silver_volcano}
    return run_together({
        name: partial(_stored, spark, sf_dir, f"silver-{name}", partial(clean, spark, sf_dir))
        for name, clean in cleaners.items()})


def _gold(spark, sf_dir, *names: str) -> dict[str, DataFrame]:
    silver = _silver(spark, sf_dir)
    dims = galaxy.build_dimensions(spark, silver)

    def build(name):
        if name in dims:
            return dims[name]
        return galaxy.FACTS[name](silver[name.removeprefix("fact_")])

    return run_together({
        name: partial(_stored, spark, sf_dir, name, partial(build, name))
        for name in names or (*dims, *galaxy.FACTS)})


_SILVER_CTES = f"""quake AS MATERIALIZED (SELECT * FROM {EARTHQUAKE_SILVER} s1),
  wave AS MATERIALIZED (SELECT * FROM {TSUNAMI_SILVER} s2),
  slide AS MATERIALIZED (SELECT * FROM {LANDSLIDE_SILVER} s3),
  cone AS MATERIALIZED (SELECT * FROM {VOLCANO_SILVER} s4)"""

_LOCATIONS = """(SELECT DISTINCT upper(country) AS location FROM (
    SELECT country FROM quake UNION ALL SELECT country FROM wave
    UNION ALL SELECT country FROM cone UNION ALL SELECT country_name FROM slide) c)"""

_MEMBERS = [
    ("dim_location", f"(SELECT location AS v FROM {_LOCATIONS} l)"),
    ("dim_volcano", "(SELECT DISTINCT volcano_name AS v FROM cone "
                    "WHERE volcano_name <> 'Unnamed')"),
    ("dim_landslide_category", "(SELECT DISTINCT landslide_category AS v FROM slide)"),
    ("dim_landslide_trigger", "(SELECT DISTINCT landslide_trigger AS v FROM slide)"),
    ("dim_landslide_size", "(SELECT DISTINCT landslide_size AS v FROM slide)"),
    ("dim_landslide_setting", "(SELECT DISTINCT landslide_setting AS v FROM slide)"),
    ("dim_tsunami_validity", "(SELECT DISTINCT event_validity AS v FROM wave)"),
    ("dim_tsunami_cause", "(SELECT DISTINCT cause_code AS v FROM wave)"),
]


@query("gold_dimensions", f"WITH {_SILVER_CTES} " + " UNION ALL ".join(
    f"SELECT '{name}' AS dimension, COALESCE(v, 'unknown') AS member, "
    f"v IS NULL AS is_unknown_key FROM {source} m" for name, source in _MEMBERS))
def gold_dimensions(spark, sf_dir):
    dims = galaxy.build_dimensions(spark, _silver(spark, sf_dir))  # built anew, not read
    naturals = {**{n: k for n, k in galaxy.CODE_DIMENSIONS.items()},
                "dim_volcano": ("volcano_key", "volcano_name")}
    parts = [
        dims[name].select(
            F.lit(name).alias("dimension"), F.col(natural).alias("member"),
            (F.col(key) == -1).alias("is_unknown_key"))
        for name, (key, natural) in naturals.items()]
    members = parts[0]
    for part in parts[1:]:
        members = members.unionByName(part)
    return members


@query("gold_dim_volcano", f"""
    WITH {_SILVER_CTES}
    SELECT volcano_name, elevation, volcano_type, status FROM (
      SELECT volcano_name, abs(elevation) AS elevation, volcano_type, status,
             row_number() OVER (PARTITION BY volcano_name
                                ORDER BY abs(elevation), volcano_type, status) AS r
      FROM cone WHERE volcano_name <> 'Unnamed') t WHERE r = 1""")
def gold_dim_volcano(spark, sf_dir):
    dims = galaxy.build_dimensions(spark, _silver(spark, sf_dir))
    return dims["dim_volcano"].drop("volcano_key")


def _date_key_sql() -> str:
    return "CAST(day * 1000000 + month * 10000 + year AS INTEGER) AS date_key"


@query("gold_fact_earthquake", f"""
    SELECT id_earthquake, {_date_key_sql()}, COALESCE(upper(country), 'unknown') AS location,
           eq_primary, deaths, deaths_description, damage_description, latitude, longitude
    FROM {EARTHQUAKE_SILVER} s""")
def gold_fact_earthquake(spark, sf_dir):
    gold = _gold(spark, sf_dir, "dim_location", "fact_earthquake")
    return gold["fact_earthquake"].join(gold["dim_location"], "location_key").drop("location_key")


@query("gold_fact_volcano", f"""
    SELECT {_date_key_sql()}, COALESCE(upper(country), 'unknown') AS location, volcano_name,
           explosivity, deaths_description, total_deaths, latitude, longitude
    FROM {VOLCANO_SILVER} s WHERE volcano_name <> 'Unnamed'""")
def gold_fact_volcano(spark, sf_dir):
    gold = _gold(spark, sf_dir, "dim_location", "dim_volcano", "fact_volcano")
    volcano = gold["dim_volcano"].select("volcano_key", "volcano_name")
    return gold["fact_volcano"].join(gold["dim_location"], "location_key").join(
        volcano, "volcano_key").drop("location_key", "volcano_key", "id_volcano")


@query("gold_fact_tsunami", f"""
    SELECT * FROM (SELECT id AS id_tsunami, {_date_key_sql()},
           COALESCE(upper(country), 'unknown') AS location,
           COALESCE(event_validity, 'unknown') AS tsunami_event_validity,
           COALESCE(cause_code, 'unknown') AS tsunami_cause_code, hour, minute, latitude, longitude,
           death_description, injuries_description, total_deaths, total_injuries,
           houses_destroyed, houses_damaged
    FROM {TSUNAMI_SILVER} s) f WHERE date_key IS NOT NULL""")
def gold_fact_tsunami(spark, sf_dir):
    dims = ("dim_location", "dim_tsunami_validity", "dim_tsunami_cause")
    gold = _gold(spark, sf_dir, "fact_tsunami", *dims)
    fact = gold["fact_tsunami"]
    for name in dims:
        key = galaxy.CODE_DIMENSIONS[name][0]
        fact = fact.join(gold[name], key).drop(key)
    return fact


@query("gold_fact_landslide", f"""
    SELECT event_id AS id_landslide, {_date_key_sql()},
           COALESCE(upper(country_name), 'unknown') AS location,
           {', '.join(f"COALESCE({c}, 'unknown') AS {c}" for c in cleaning.LANDSLIDE_IMPUTED)},
           fatality_count, injury_count, longitude, latitude, hour, minute
    FROM {LANDSLIDE_SILVER} s""")
def gold_fact_landslide(spark, sf_dir):
    dims = {k: d for k, d in galaxy.FOREIGN_KEYS["fact_landslide"].items() if d != "dim_date"}
    gold = _gold(spark, sf_dir, "fact_landslide", *dims.values())
    fact = gold["fact_landslide"]
    for key, name in dims.items():
        fact = fact.join(gold[name], key).drop(key)
    return fact


def _metric(check: str, constraint: str, expr: str, source: str, holds: str = "= 1.0") -> str:
    return (f"SELECT '{check}' AS \"check\", '{constraint}' AS \"constraint\", m AS metric, "
            f"CASE WHEN m {holds} THEN 'Success' ELSE 'Failure' END AS constraint_status "
            f"FROM (SELECT {expr} AS m FROM {source}) q")


def _share(predicate: str) -> str:
    return f"AVG(CASE WHEN {predicate} THEN 1.0 ELSE 0.0 END)"


def _unique(column: str, source: str) -> str:
    return (f"(SELECT CAST(COUNT(*) FILTER (n = 1) AS DOUBLE) / SUM(n) AS u FROM (SELECT COUNT(*) "
            f"AS n FROM {source} z WHERE {column} IS NOT NULL GROUP BY {column}) g)")


def _gold_checks_sql() -> str:
    """Metrics from the natural values: the keys are one to one with them."""
    span = "(SELECT 1 AS full_date)"  # the date dimension holds every day once
    parts = [
        _metric("dim_date", "complete(date_key)", "1.0::DOUBLE", span),
        _metric("dim_date", "unique(date_key)", "1.0::DOUBLE", span),
        _metric("dim_date", "completeness(full_date)", "1.0::DOUBLE", span),
        _metric("dim_volcano", "complete(volcano_key)", "1.0::DOUBLE", span),
        _metric("dim_volcano", "complete(volcano_name)", "1.0::DOUBLE", span),
        _metric("dim_volcano", "unique(volcano_key)", "1.0::DOUBLE", span),
        _metric("dim_volcano", "completeness(elevation)", _share("e IS NOT NULL"), "vol", "> 0.9"),
        _metric("dim_volcano", "Elevation Must Be Positive", _share("e > 0"), "vol"),
    ]
    for name, (key, natural) in galaxy.CODE_DIMENSIONS.items():
        for label in (f"complete({key})", f"complete({natural})", f"unique({key})"):
            parts.append(_metric(name, label, "1.0::DOUBLE", span))
    facts = {
        "fact_earthquake": ("quake", "id_earthquake"),
        "fact_volcano": ("(SELECT * FROM cone WHERE volcano_name <> 'Unnamed')", None),
        "fact_tsunami": (
            "(SELECT * FROM wave WHERE month IS NOT NULL AND day IS NOT NULL)", "id"),
        "fact_landslide": ("slide", "event_id"),
    }
    dated = "year IS NOT NULL AND month IS NOT NULL AND day IS NOT NULL"
    real_day = ("year BETWEEN 37 AND 2023 AND TRY_CAST(lpad(CAST(year AS VARCHAR), 4, '0') || '-' "
                "|| month || '-' || day AS DATE) IS NOT NULL")
    for name, (source, key) in facts.items():
        fact_id = name.replace("fact_", "id_")
        rows = f"{source} f"
        parts.append(_metric(name, f"complete({fact_id})",
                             _share(f"{key} IS NOT NULL" if key else "TRUE"), rows))
        parts.append(_metric(name, f"unique({fact_id})", "u" if key else "1.0::DOUBLE",
                             f"{_unique(key, source)} u0" if key else span))
        for fk, dim in galaxy.FOREIGN_KEYS[name].items():
            is_date = fk == "date_key"
            parts.append(_metric(name, f"complete({fk})", _share(dated) if is_date else
                                 _share("TRUE"), rows))
            label = f"{fk.replace('_', ' ').title()} Missing in {dim}"
            parts.append(_metric(
                name, label, _share(real_day) if is_date else _share("TRUE"), rows))
        if name in galaxy.FACTS_WITH_COORDINATES:
            parts.append(_metric(name, "Valid Latitude",
                                 _share("latitude BETWEEN -90 AND 90"), rows))
            parts.append(_metric(name, "Valid Longitude",
                                 _share("longitude BETWEEN -180 AND 180"), rows))
    vol = ("vol AS (SELECT volcano_name, MIN(abs(elevation)) AS e FROM cone "
           "WHERE volcano_name <> 'Unnamed' GROUP BY 1)")
    return f"WITH {_SILVER_CTES}, {vol} " + " UNION ALL ".join(parts)


@query("gold_checks", _gold_checks_sql())
def gold_checks(spark, sf_dir):
    return run_checks(galaxy.gold_checks(_gold(spark, sf_dir)))


@query("gold_impact_rollup", f"""
    SELECT location, year, COUNT(*) AS events, CAST(SUM(deaths) AS BIGINT) AS deaths
    FROM (SELECT COALESCE(upper(country), 'unknown') AS location,
                 CASE WHEN month IS NOT NULL AND day IS NOT NULL THEN year END AS year, deaths
          FROM {EARTHQUAKE_SILVER} s) f
    GROUP BY ROLLUP (location, year)""")
def gold_impact_rollup(spark, sf_dir):
    gold = _gold(spark, sf_dir, "dim_location", "fact_earthquake")
    # the last four digits of the date key are the year
    quakes = gold["fact_earthquake"].withColumn("year", F.col("date_key") % 10_000)
    return impact_by(quakes, "location_key", gold["dim_location"], "location_key", ["location"],
                     ["year"], {"deaths": F.col("deaths")}, rollup=True)


@query("gold_cause_rollup", f"""
    SELECT COALESCE(cause_code, 'unknown') AS tsunami_cause_code, COUNT(*) AS events,
           CAST(SUM(total_deaths) AS BIGINT) AS deaths,
           CAST(SUM(houses_destroyed) AS BIGINT) AS houses
    FROM {TSUNAMI_SILVER} s
    WHERE year IS NOT NULL AND month IS NOT NULL AND day IS NOT NULL GROUP BY 1""")
def gold_cause_rollup(spark, sf_dir):
    gold = _gold(spark, sf_dir, "dim_tsunami_cause", "fact_tsunami")
    return impact_by(
        gold["fact_tsunami"], "cause_key", gold["dim_tsunami_cause"], "cause_key",
        ["tsunami_cause_code"], [],
        {"deaths": F.col("total_deaths"), "houses": F.col("houses_destroyed")})


@query("gold_drill_across", f"""
    WITH {_SILVER_CTES},
      q AS (SELECT COALESCE(upper(country), 'unknown') AS location, COUNT(*) AS quakes
            FROM quake GROUP BY 1),
      w AS (SELECT COALESCE(upper(country), 'unknown') AS location, COUNT(*) AS waves FROM wave
            WHERE year IS NOT NULL AND month IS NOT NULL AND day IS NOT NULL GROUP BY 1),
      l AS (SELECT COALESCE(upper(country_name), 'unknown') AS location, COUNT(*) AS slides
            FROM slide GROUP BY 1),
      v AS (SELECT COALESCE(upper(country), 'unknown') AS location, COUNT(*) AS eruptions
            FROM cone WHERE volcano_name <> 'Unnamed' GROUP BY 1)
    SELECT location, COALESCE(quakes, 0) AS quakes, COALESCE(waves, 0) AS waves,
           COALESCE(slides, 0) AS slides, COALESCE(eruptions, 0) AS eruptions
    FROM q FULL JOIN w USING (location) FULL JOIN l USING (location) FULL JOIN v USING (location)""")
def gold_drill_across(spark, sf_dir):
    gold = _gold(spark, sf_dir)
    counts = [
        (gold[fact].groupBy("location_key").agg(F.count(F.lit(1)).alias(name)), name)
        for fact, name in (("fact_earthquake", "quakes"), ("fact_tsunami", "waves"),
                           ("fact_landslide", "slides"), ("fact_volcano", "eruptions"))]
    return drill_across(counts, "location_key").join(
        gold["dim_location"], "location_key").drop("location_key")

