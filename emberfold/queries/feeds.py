"""Hazard feeds shaped from the driver tables: raw text columns with dirt.

Every feed row stems from one table row. The keys of the fixed lookup tables
are dealt out by row key, so every lookup entry meets rows; missing values and
junk are put in by row key as well. ``*_SQL`` builds the same feed, with plain
names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberfold.operators.joins import Lookup
from emberfold.plans import fixed_values as fixed
from emberfold.queries.base import sql_values, table

_PLACES = Lookup("slot bigint, listed_country string, listed_location string", ("slot",),
                 [(i, r[0], r[1]) for i, r in enumerate(fixed.TSUNAMI_COORDINATES)])
_VOLCANOES = Lookup(
    "slot bigint, listed_name string, listed_year int, listed_country string", ("slot",),
    [(i, r[0], r[1], r[2]) for i, r in enumerate(fixed.ERUPTION_DATES)])
_QUAKES = Lookup("slot bigint, listed_year int", ("slot",),
                 [(r[0], r[1]) for r in fixed.EARTHQUAKE_COORDINATES])


def _text(c: Column) -> Column:
    return c.cast("string")


def _listed(df: DataFrame, lookup: Lookup) -> DataFrame:
    return df.join(F.broadcast(lookup.to_df(df.sparkSession)), "slot", "left")


def _listed_sql(lookup: Lookup) -> str:
    return sql_values(lookup.rows, "k", [n for n, _ in lookup.fields])


def earthquakes(spark, sf_dir) -> DataFrame:
    k, owner, d = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    rows = _listed(table(spark, sf_dir, "orders").withColumn("slot", k), _QUAKES)
    lat = F.concat(_text(owner % 185 - 92), F.lit(".5"))
    lon = F.concat(_text(k % 361 - 180), F.lit(".25"))
    return rows.select(
        _text(k).alias("ID Earthquake"),
        _text(F.coalesce("listed_year", F.when(k % 11 == 0, -50).when(k % 13 == 0, None).otherwise(
            F.year(d)))).alias("Year"),
        _text(F.when(k % 7 != 0, F.month(d))).alias("Month"),
        _text(F.when(k % 5 != 0, F.dayofmonth(d))).alias("Day"),
        F.concat(_text(owner % 9), F.lit("."), _text(k % 10)).alias("EQ Primary"),
        F.when(k % 97 != 0, F.concat(F.lit("Nation_"), _text(owner % 25))).alias("Country"),
        _text(F.when(k % 3 != 0, k % 500)).alias("Earthquake : Deaths"),
        _text(k % 5).alias("Earthquake : Deaths Description"),
        _text(owner % 4).alias("Earthquake : Damage Description"),
        F.when(k % 17 == 0, "x, y").when(k % 19 == 0, lat).when(k % 23 == 0, None).otherwise(
            F.concat(lat, F.lit(", "), lon)).alias("Coordinates"),
        F.lit("unused").alias("Flag Tsunami"))


EARTHQUAKES_SQL = f"""(SELECT o_orderkey AS id,
    COALESCE(listed_year, CASE WHEN o_orderkey % 11 = 0 THEN -50 WHEN o_orderkey % 13 = 0 THEN NULL
             ELSE year(o_orderdate) END) AS year,
    CASE WHEN o_orderkey % 7 <> 0 THEN month(o_orderdate) END AS month,
    CASE WHEN o_orderkey % 5 <> 0 THEN day(o_orderdate) END AS day,
    CAST((o_custkey % 9) || '.' || (o_orderkey % 10) AS DOUBLE) AS eq_primary,
    CASE WHEN o_orderkey % 97 <> 0 THEN 'Nation_' || (o_custkey % 25) END AS country,
    CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 500 END AS deaths,
    o_orderkey % 5 AS deaths_description, o_custkey % 4 AS damage_description,
    CASE WHEN o_orderkey % 17 = 0 THEN 'x, y'
         WHEN o_orderkey % 19 = 0 THEN (o_custkey % 185 - 92) || '.5'
         WHEN o_orderkey % 23 = 0 THEN NULL
         ELSE (o_custkey % 185 - 92) || '.5, ' || (o_orderkey % 361 - 180) || '.25' END AS coordinates
  FROM orders LEFT JOIN {_listed_sql(_QUAKES)} ON o_orderkey = slot)"""


def tsunamis(spark, sf_dir) -> DataFrame:
    k, user, ts = F.col("event_id"), F.col("user_id"), F.col("ts")
    rows = _listed(table(spark, sf_dir, "events").withColumn("slot", k % 70), _PLACES)
    country = F.coalesce("listed_country", F.concat(F.lit("Nation_"), _text(user % 25)))
    location = F.coalesce("listed_location", F.lit("OPEN SEA"))
    return rows.select(
        _text(k).alias("Sr.no"), _text(F.year(ts) - (k % 300)).alias("Year"),
        _text(F.when(k % 4 != 0, F.month(ts))).alias("Mo"),
        _text(F.when(k % 6 != 0, F.dayofmonth(ts))).alias("Dy"),
        _text(F.hour(ts)).alias("Hr"), _text(F.minute(ts)).alias("Mn"),
        F.regexp_replace(country, " ", "Nan").alias("Country"),
        F.concat(F.regexp_replace(location, " ", "Nan"), F.lit("Nan")).alias("LocationNanName"),
        _text(F.when(k % 2 != 0, user % 90 + 0.5)).alias("Latitude"),
        _text(F.when(k % 3 != 0, user % 180 + 0.25)).alias("Longitude"),
        _text(F.when(k % 8 != 0, k % 6)).alias("DeathNanDescription"),
        _text(user % 5).alias("InjuriesNanDescription"),
        _text(F.when(k % 9 != 0, k % 1000)).alias("TotalNanDeaths"),
        _text(user).alias("TotalNanInjuries"),
        _text(F.when(k % 41 != 0, k % 6 - 1)).alias("TsunamiNanEventNanValidity"),
        _text(k % 13).alias("TsunamiNanCauseNanCode"),
        _text(k % 77).alias("TotalNanHousesNanDestroyed"),
        _text(k % 88).alias("TotalNanHousesNanDamaged"))


TSUNAMIS_SQL = f"""(SELECT event_id AS id, year(ts) - (event_id % 300) AS year,
    CASE WHEN event_id % 4 <> 0 THEN month(ts) END AS month,
    CASE WHEN event_id % 6 <> 0 THEN day(ts) END AS day, hour(ts) AS hour, minute(ts) AS minute,
    COALESCE(listed_country, 'Nation_' || (user_id % 25)) AS country,
    COALESCE(listed_location, 'OPEN SEA') AS location,
    CASE WHEN event_id % 2 <> 0 THEN user_id % 90 + 0.5::DOUBLE END AS latitude,
    CASE WHEN event_id % 3 <> 0 THEN user_id % 180 + 0.25::DOUBLE END AS longitude,
    CASE WHEN event_id % 8 <> 0 THEN event_id % 6 END AS death_description,
    user_id % 5 AS injuries_description,
    CASE WHEN event_id % 9 <> 0 THEN event_id % 1000 END AS total_deaths,
    user_id AS total_injuries,
    CASE WHEN event_id % 41 <> 0 THEN event_id % 6 - 1 END AS event_validity,
    event_id % 13 AS cause_code, event_id % 77 AS houses_destroyed,
    event_id % 88 AS houses_damaged
  FROM events LEFT JOIN {_listed_sql(_PLACES)} ON event_id % 70 = slot)"""


def landslides(spark, sf_dir) -> DataFrame:
    order, part, supp = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    line = F.col("l_linenumber")
    ts = F.col("l_shipdate") + F.make_dt_interval(
        F.lit(0), (part % 24).cast("int"), (supp % 60).cast("int"))
    count = F.when(part % 31 == 0, "many").when(part % 5 == 0, None)
    return table(spark, sf_dir, "lineitem").select(
        _text(order * 10 + line).alias("event_id"),
        F.when(part % 53 == 0, "unknown date").otherwise(
            F.date_format(ts, "MM/dd/yyyy hh:mm:ss a")).alias("event_date"),
        F.when(part % 4 != 0, F.concat(F.lit("cat "), _text(part % 3))).alias("landslide_category"),
        F.when((supp % 25 > 4) | (part % 9 == 0), F.concat(F.lit("trigger "), "l_returnflag")).alias(
            "landslide_trigger"),
        F.when(supp % 6 != 0, F.concat(F.lit("size "), "l_linestatus")).alias("landslide_size"),
        F.when(line % 3 != 0, F.concat(F.lit("at "), _text(line))).alias("landslide_setting"),
        count.otherwise(_text(part % 40)).alias("fatality_count"),
        F.when(supp % 5 == 0, F.concat(_text(supp), F.lit(".0"))).otherwise(
            _text(part % 12)).alias("injury_count"),
        F.when(part % 6 != 0, F.concat(F.lit("Nation_"), _text(supp % 25))).alias("country_name"),
        F.when(part % 43 == 0, "west").otherwise(F.concat(
            _text((part * 7) % 361 - 180), F.lit(".5"))).alias("longitude"),
        F.concat(_text((supp * 11 + part) % 180 - 90), F.lit(".75")).alias("latitude"))


LANDSLIDES_SQL = """(SELECT l_orderkey * 10 + l_linenumber AS event_id,
    CASE WHEN l_partkey % 53 = 0 THEN 'unknown date' ELSE strftime(
      l_shipdate + to_hours(l_partkey % 24) + to_minutes(l_suppkey % 60),
      '%m/%d/%Y %I:%M:%S %p') END AS event_date,
    CASE WHEN l_partkey % 4 <> 0 THEN 'cat ' || (l_partkey % 3) END AS landslide_category,
    CASE WHEN l_suppkey % 25 > 4 OR l_partkey % 9 = 0 THEN 'trigger ' || l_returnflag END
      AS landslide_trigger,
    CASE WHEN l_suppkey % 6 <> 0 THEN 'size ' || l_linestatus END AS landslide_size,
    CASE WHEN l_linenumber % 3 <> 0 THEN 'at ' || l_linenumber END AS landslide_setting,
    CASE WHEN l_partkey % 31 = 0 THEN 'many' WHEN l_partkey % 5 = 0 THEN NULL
         ELSE CAST(l_partkey % 40 AS VARCHAR) END AS fatality_count,
    CASE WHEN l_suppkey % 5 = 0 THEN l_suppkey ELSE l_partkey % 12 END AS injury_count,
    CASE WHEN l_partkey % 6 <> 0 THEN 'Nation_' || (l_suppkey % 25) END AS country_name,
    CASE WHEN l_partkey % 43 = 0 THEN 'west'
         ELSE ((l_partkey * 7) % 361 - 180) || '.5' END AS longitude,
    CAST(((l_suppkey * 11 + l_partkey) % 180 - 90) || '.75' AS DOUBLE) AS latitude
  FROM lineitem)"""


def volcanoes(spark, sf_dir) -> DataFrame:
    part, supp, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    slot = F.col("slot")
    rows = _listed(
        table(spark, sf_dir, "lineitem").withColumn("slot", part % 200), _VOLCANOES)
    return rows.select(
        _text(F.when(slot >= 195, -5).when(slot >= 190, None).otherwise(
            F.coalesce("listed_year", (supp % 50 + 1950).cast("int")))).alias("Year"),
        _text(F.when(line % 2 != 0, line)).alias("Month"),
        _text(F.when(line % 3 != 0, supp % 28 + 1)).alias("Day"),
        F.when(slot == 180, "Unnamed").when(slot == 181, None).otherwise(
            F.coalesce("listed_name", F.concat(F.lit("Mount "), _text(slot)))).alias("Volcano Name"),
        F.coalesce("listed_country", F.concat(F.lit("Nation_"), _text(slot % 25))).alias("Country"),
        _text(slot * 10 - 300).alias("Elevation"),
        F.concat(F.lit("type "), _text(slot % 4)).alias("Volcano Type"),
        F.concat(F.lit("status "), _text(slot % 3)).alias("Status"),
        _text(F.when(slot % 8 != 0, slot % 10)).alias("Volcanic Explosivity Index"),
        _text(slot % 5).alias("Volcano : Deaths Description"),
        _text(F.when(slot % 7 != 0, slot)).alias("Total Effects : Deaths"),
        F.when(slot % 37 == 0, "nowhere").otherwise(F.concat(
            _text(slot % 181 - 90), F.lit(".5,"), _text(slot % 361 - 180), F.lit(".25"))).alias(
            "Coordinates"))


VOLCANOES_SQL = f"""(SELECT
    CASE WHEN s >= 195 THEN -5 WHEN s >= 190 THEN NULL
         ELSE COALESCE(listed_year, l_suppkey % 50 + 1950) END AS year,
    CASE WHEN l_linenumber % 2 <> 0 THEN l_linenumber END AS month,
    CASE WHEN l_linenumber % 3 <> 0 THEN l_suppkey % 28 + 1 END AS day,
    CASE WHEN s = 180 THEN 'Unnamed' WHEN s = 181 THEN NULL
         ELSE COALESCE(listed_name, 'Mount ' || s) END AS volcano_name,
    COALESCE(listed_country, 'Nation_' || (s % 25)) AS country, s * 10 - 300 AS elevation,
    'type ' || (s % 4) AS volcano_type, 'status ' || (s % 3) AS status,
    CASE WHEN s % 8 <> 0 THEN s % 10 END AS explosivity, s % 5 AS deaths_description,
    CASE WHEN s % 7 <> 0 THEN s END AS total_deaths,
    CASE WHEN s % 37 = 0 THEN 'nowhere'
         ELSE (s % 181 - 90) || '.5,' || (s % 361 - 180) || '.25' END AS coordinates
  FROM (SELECT *, l_partkey % 200 AS s FROM lineitem) l LEFT JOIN {_listed_sql(_VOLCANOES)}
    ON s = slot)"""
