"""Overrides, fills, box labels, group modes, payload shaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberfold.operators.joins import Lookup
from emberfold.operators.repair import (
    Box, bbox_label, bbox_range_join, fill_from_lookup, impute_group_mode, override_by_key)
from emberfold.plans.cleaning import COUNTRY_BOXES
from emberfold.queries.base import query, sql_text, sql_values, table
from emberfold.streaming.weather import normalize_payload, parse_messages

# Lookups made by rule; the later of two entries with the same key counts.
_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
OVERRIDES = Lookup(
    "o_custkey bigint, o_orderpriority string, o_orderstatus string",
    ("o_custkey", "o_orderpriority"),
    [(k, _PRIORITIES[k % 5], "R") for k in range(0, 400, 7)]
    + [(k, _PRIORITIES[k % 5], "S") for k in range(0, 400, 21)])
DATE_FILLS = Lookup(
    "o_custkey bigint, month int, day int", ("o_custkey",),
    [(k, k % 12 + 1, k % 28 + 1) for k in range(0, 900, 4)]
    + [(k, 12, 31) for k in range(0, 900, 60)])
PART_FILLS = Lookup(
    "p_brand string, p_type string, p_size int, p_retailprice double", ("p_brand", "p_type"),
    [(f"Brand#{b}", t, b, b + i / 4) for b in range(1, 23)
     for i, t in enumerate(["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL"])])


def lookup_sql(lookup: Lookup, alias: str) -> str:
    return sql_values(lookup.unique_rows(), alias, [n for n, _ in lookup.fields])


@query("d1_override", f"""
    SELECT o_orderkey, o.o_custkey, o.o_orderpriority,
           CASE WHEN k.o_custkey IS NOT NULL THEN k.o_orderstatus ELSE o.o_orderstatus END
             AS o_orderstatus
    FROM orders o LEFT JOIN {lookup_sql(OVERRIDES, 'k')}
      ON o.o_custkey = k.o_custkey AND o.o_orderpriority = k.o_orderpriority""")
def d1_override(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    return override_by_key(orders, OVERRIDES, ["o_custkey", "o_orderpriority"], ["o_orderstatus"])


_HOLES_SQL = """(SELECT o_orderkey, o_custkey,
    CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(month(o_orderdate) AS INTEGER) END AS month,
    CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(day(o_orderdate) AS INTEGER) END AS day
  FROM orders)"""


def _holes(spark, sf_dir):
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        k, "o_custkey", F.when(k % 3 != 0, F.month(d)).alias("month"),
        F.when(k % 4 != 0, F.dayofmonth(d)).alias("day"))


@query("d2_lookup_fill", f"""
    SELECT o_orderkey, o.o_custkey, CAST(COALESCE(o.month, k.month) AS INTEGER) AS month,
           CAST(COALESCE(o.day, k.day) AS INTEGER) AS day
    FROM {_HOLES_SQL} o LEFT JOIN {lookup_sql(DATE_FILLS, 'k')} ON o.o_custkey = k.o_custkey""")
def d2_lookup_fill(spark, sf_dir):
    return fill_from_lookup(_holes(spark, sf_dir), DATE_FILLS, ["o_custkey"], ["month", "day"])


@query("d2_table_fill", """
    SELECT o_orderkey, o_custkey, COALESCE(
        CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END,
        CASE WHEN c_custkey % 4 = 0 THEN 'revised ' || c_mktsegment ELSE c_mktsegment END) AS segment
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def d2_table_fill(spark, sf_dir):
    k = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select(
        k, "o_custkey", F.when(k % 3 != 0, F.col("o_orderpriority")).alias("segment"))
    customer = table(spark, sf_dir, "customer")
    first = customer.select(F.col("c_custkey").alias("o_custkey"), F.lit(1).alias("revision"),
                            F.col("c_mktsegment").alias("segment"))
    # every fourth customer is listed twice; the later revision counts
    second = customer.where("c_custkey % 4 = 0").select(
        F.col("c_custkey").alias("o_custkey"), F.lit(2).alias("revision"),
        F.concat(F.lit("revised "), "c_mktsegment").alias("segment"))
    return fill_from_lookup(orders, second.unionByName(first), ["o_custkey"], ["segment"],
                            last_by=["revision"])


@query("d3_composite_fill", f"""
    SELECT p.p_partkey, p.p_brand, p.p_type,
           CAST(COALESCE(CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p.p_size END, k.p_size)
                AS INTEGER) AS p_size,
           CAST(COALESCE(CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p.p_retailprice END,
                         k.p_retailprice) AS DOUBLE) AS p_retailprice
    FROM part p LEFT JOIN {lookup_sql(PART_FILLS, 'k')}
      ON p.p_brand = k.p_brand AND p.p_type = k.p_type""")
def d3_composite_fill(spark, sf_dir):
    k = F.col("p_partkey")
    parts = table(spark, sf_dir, "part").select(
        k, "p_brand", "p_type", F.when(k % 3 != 0, F.col("p_size")).alias("p_size"),
        F.when(k % 4 != 0, F.col("p_retailprice")).alias("p_retailprice"))
    return fill_from_lookup(parts, PART_FILLS, ["p_brand", "p_type"], ["p_size", "p_retailprice"])


_POINTS_SQL = """(SELECT o_orderkey, ((o_custkey * 7919) % 36001) / 100.0 - 180.0 AS lon,
    ((o_orderkey * 104729) % 18001) / 100.0 - 90.0 AS lat,
    CASE WHEN o_orderkey % 4 = 0 THEN 'Kept' ELSE NULL END AS place FROM orders)"""


def _points(spark, sf_dir):
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        k, (((F.col("o_custkey") * 7919) % 36001) / 100.0 - 180.0).alias("lon"),
        (((k * 104729) % 18001) / 100.0 - 90.0).alias("lat"),
        F.when(k % 4 == 0, "Kept").alias("place"))


def boxes_sql(boxes, lon: str, lat: str) -> str:
    branches = " ".join(
        f"WHEN {lon} BETWEEN {b.lon_from} AND {b.lon_to} AND {lat} BETWEEN {b.lat_from} "
        f"AND {b.lat_to} THEN {sql_text(b.label)}" for b in boxes)
    return f"CASE {branches} END"


# Many overlapping boxes, made by rule.
MANY_BOXES = [
    Box(lon, lon + 13, lat, lat + 9, f"Zone {lon}/{lat}")
    for lon in range(-180, 168, 7) for lat in range(-90, 82, 6)]


@query("d5_bbox_label", f"""
    SELECT o_orderkey, lon, lat,
           COALESCE(place, {boxes_sql(COUNTRY_BOXES, 'lon', 'lat')}) AS place
    FROM {_POINTS_SQL} p""")
def d5_bbox_label(spark, sf_dir):
    return bbox_label(_points(spark, sf_dir), "lon", "lat", COUNTRY_BOXES, "place")


@query("d5_bbox_rangejoin", f"""
    SELECT p.o_orderkey, p.lon, p.lat, COALESCE(any_value(p.place), min_by(b.label, b.rank)) AS place
    FROM {_POINTS_SQL} p LEFT JOIN
         {sql_values([(i, *b) for i, b in enumerate(MANY_BOXES)], 'b',
                     ['rank', 'lon_from', 'lon_to', 'lat_from', 'lat_to', 'label'])}
      ON p.lon BETWEEN b.lon_from AND b.lon_to AND p.lat BETWEEN b.lat_from AND b.lat_to
    GROUP BY p.o_orderkey, p.lon, p.lat""")
def d5_bbox_rangejoin(spark, sf_dir):
    return bbox_range_join(_points(spark, sf_dir), "lon", "lat", MANY_BOXES, "place")


# Boxes from a table: one per customer, from narrow ones to bands around the world.
_BOX_ROWS_SQL = """(SELECT c_custkey AS rank, x AS lon_from, x + w AS lon_to, y AS lat_from,
    y + w / 8.0 AS lat_to, 'Zone ' || c_custkey AS label
  FROM (SELECT c_custkey, ((c_custkey * 7919) % 360) - 180.0::DOUBLE AS x,
          ((c_custkey * 104729) % 180) - 90.0::DOUBLE AS y,
          CASE WHEN c_custkey % 97 = 0 THEN 360.0 WHEN c_custkey % 7 = 0 THEN 24.0 ELSE 3.0 END::DOUBLE
            AS w FROM customer) c)"""


@query("d5_box_table", f"""
    SELECT p.o_orderkey, COALESCE(any_value(p.place), min_by(b.label, b.rank)) AS place
    FROM {_POINTS_SQL} p LEFT JOIN {_BOX_ROWS_SQL} b
      ON p.lon BETWEEN b.lon_from AND b.lon_to AND p.lat BETWEEN b.lat_from AND b.lat_to
    GROUP BY p.o_orderkey""")
def d5_box_table(spark, sf_dir):
    k = F.col("c_custkey")
    x, y = ((k * 7919) % 360 - 180.0), ((k * 104729) % 180 - 90.0)
    w = F.when(k % 97 == 0, 360.0).when(k % 7 == 0, 24.0).otherwise(3.0)
    boxes = table(spark, sf_dir, "customer").select(
        x.alias("lon_from"), (x + w).alias("lon_to"), y.alias("lat_from"), (y + w / 8.0).alias("lat_to"),
        F.concat(F.lit("Zone "), k.cast("string")).alias("label"), k.alias("rank"))
    return bbox_range_join(_points(spark, sf_dir), "lon", "lat", boxes, "place").select(
        "o_orderkey", "place")


# Boxes of a hundredth of a degree, all within five degrees: one per part, every tenth with a copy of another label.
# Every 25th reaches from one corner, every 50th across all others; these come last.
_DENSE_SQL = """(SELECT p_partkey + (SELECT COUNT(*) FROM part) * (c + CASE WHEN p_partkey % 25 = 0 THEN 2 ELSE 0 END)
      AS rank,
    CASE WHEN p_partkey % 25 = 0 THEN 10.0 ELSE x END::DOUBLE AS lon_from,
    CASE WHEN p_partkey % 50 = 0 THEN 15.0 ELSE x + 0.01::DOUBLE END AS lon_to,
    CASE WHEN p_partkey % 25 = 0 THEN 40.0 ELSE y END::DOUBLE AS lat_from, y + 0.01::DOUBLE AS lat_to,
    CASE WHEN c = 1 THEN 'Copy ' ELSE 'Plot ' END || p_partkey AS label
  FROM (SELECT p_partkey, c, 10.0::DOUBLE + (p_partkey * 7919 % 5000) / 1000.0::DOUBLE AS x,
          40.0::DOUBLE + (p_partkey * 104729 % 5000) / 1000.0::DOUBLE AS y
        FROM part, (VALUES (0), (1)) AS copies(c) WHERE c = 0 OR p_partkey % 10 = 0) p)"""


@query("d5_dense_boxes", f"""
    SELECT o.o_orderkey, min_by(b.label, b.rank) AS plot
    FROM (SELECT o_orderkey, 10.0::DOUBLE + (o_custkey * 613 % 5000) / 1000.0::DOUBLE AS lon,
            40.0::DOUBLE + (o_orderkey * 7907 % 5000) / 1000.0::DOUBLE AS lat FROM orders) o
      LEFT JOIN {_DENSE_SQL} b
        ON o.lon BETWEEN b.lon_from AND b.lon_to AND o.lat BETWEEN b.lat_from AND b.lat_to
    GROUP BY o.o_orderkey""")
def d5_dense_boxes(spark, sf_dir):
    k, key = F.col("p_partkey"), F.col("o_orderkey")
    parts = table(spark, sf_dir, "part").select(k)
    n = parts.count()
    x, y = (F.lit(base) + (k * factor % 5000) / 1000.0 for base, factor in ((10.0, 7919), (40.0, 104729)))
    plots = parts.select(
        k, (k + F.when(k % 25 == 0, 2 * n).otherwise(0)).alias("rank"), F.when(k % 25 == 0, 10.0).otherwise(x).alias("lon_from"),
        F.when(k % 50 == 0, 15.0).otherwise(x + 0.01).alias("lon_to"),
        F.when(k % 25 == 0, 40.0).otherwise(y).alias("lat_from"), (y + 0.01).alias("lat_to"),
        F.concat(F.lit("Plot "), k.cast("string")).alias("label"))
    copies = plots.where(k % 10 == 0).withColumns({
        "label": F.concat(F.lit("Copy "), k.cast("string")), "rank": F.col("rank") + n})
    points = table(spark, sf_dir, "orders").select(
        key, (F.lit(10.0) + (F.col("o_custkey") * 613 % 5000) / 1000.0).alias("lon"),
        (F.lit(40.0) + (key * 7907 % 5000) / 1000.0).alias("lat"), F.lit(None).cast("string").alias("plot"))
    return bbox_range_join(points, "lon", "lat", plots.unionByName(copies), "plot").select("o_orderkey", "plot")


_GROUPED_SQL = """(SELECT o_orderkey,
    CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE c_nationkey END AS nation,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderkey % 13 AS INTEGER) END AS size,
    CASE WHEN o_orderkey % 3 = 0 OR (c_nationkey % 5 = 0 AND o_orderkey % 4 <> 1) THEN NULL
         ELSE o_orderpriority END AS priority,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS status
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def _mode_sql(column: str) -> str:
    return f"""(SELECT nation, v FROM (
        SELECT nation, {column} AS v, row_number() OVER (
            PARTITION BY nation ORDER BY COUNT(*) DESC, {column} ASC NULLS LAST) AS r
        FROM g WHERE nation IS NOT NULL GROUP BY nation, {column}) t WHERE r = 1)"""


@query("d6_group_mode", f"""
    WITH g AS {_GROUPED_SQL}
    SELECT g.o_orderkey, g.nation,
           COALESCE(g.priority, CASE WHEN g.nation IS NOT NULL THEN COALESCE(p.v, 'unknown') END)
             AS priority,
           COALESCE(g.status, CASE WHEN g.nation IS NOT NULL THEN COALESCE(s.v, 'unknown') END)
             AS status, COALESCE(g.size, z.v) AS size
    FROM g LEFT JOIN {_mode_sql('priority')} p ON g.nation = p.nation
           LEFT JOIN {_mode_sql('status')} s ON g.nation = s.nation
           LEFT JOIN {_mode_sql('size')} z ON g.nation = z.nation""")
def d6_group_mode(spark, sf_dir):
    k, nation = F.col("o_orderkey"), F.col("c_nationkey")
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    holes = orders.select(
        k, F.when(F.col("o_custkey") % 50 != 0, nation).alias("v"),
        F.when(k % 5 != 0, (k % 13).cast("int")).alias("size"),
        F.when(~((k % 3 == 0) | ((nation % 5 == 0) & (k % 4 != 1))),
               F.col("o_orderpriority")).alias("priority"),
        F.when(k % 7 != 0, F.col("o_orderstatus")).alias("status"))
    return impute_group_mode(holes, "v", ["priority", "status", "size"]).withColumnRenamed(
        "v", "nation")


@query("d12_weather_normalize", """
    SELECT event_id, CAST(json_extract(p, '$.main.temp') AS DOUBLE) AS temperature,
           CAST(json_extract(p, '$.main.humidity') AS DOUBLE) AS rh,
           round(CAST(json_extract(p, '$.wind.speed') AS DOUBLE) * 3.6, 6) AS ws,
           COALESCE(CAST(json_extract(p, '$.rain."1h"') AS DOUBLE), 0.0) AS rain
    FROM (SELECT event_id, '{"main":{"temp":' || CAST(value AS VARCHAR) || ',"humidity":'
              || json_extract_string(props, '$.k') || '},"wind":{"speed":'
              || CAST(user_id AS VARCHAR) || '.5}'
              || CASE WHEN event_id % 3 = 0 THEN ',"rain":{"1h":' || CAST(event_id % 9 AS VARCHAR)
                   || '.25}' ELSE '' END || '}' AS p FROM events) e""")
def d12_weather_normalize(spark, sf_dir):
    payload = F.concat(
        F.lit('{"main":{"temp":'), F.col("value").cast("string"), F.lit(',"humidity":'),
        F.get_json_object("props", "$.k"), F.lit('},"wind":{"speed":'),
        F.col("user_id").cast("string"), F.lit(".5}"),
        F.when(F.col("event_id") % 3 == 0, F.concat(
            F.lit(',"rain":{"1h":'), (F.col("event_id") % 9).cast("string"), F.lit(".25}"))
        ).otherwise(""), F.lit("}"))
    events = table(spark, sf_dir, "events").select("event_id", payload.alias("p"))
    return normalize_payload(events, "p").withColumn("ws", F.round("ws", 6)).drop("p")


@query("e9_json_fns", """
    SELECT event_id, CAST(CASE WHEN event_id % 5 IN (0, 1) THEN NULL ELSE value END AS FLOAT)
             AS temperature,
           CAST(CASE WHEN event_id % 5 = 0 THEN NULL ELSE user_id END AS FLOAT) AS rh,
           CAST(NULL AS FLOAT) AS ws, CAST(NULL AS FLOAT) AS rain,
           CASE WHEN event_id % 5 = 0 THEN '{}'
                ELSE '{"RH":' || CAST(user_id AS VARCHAR) || '}' END AS rh_json
    FROM events""")
def e9_json_fns(spark, sf_dir):
    k, user = F.col("event_id"), F.col("user_id").cast("string")
    message = (
        F.when(k % 5 == 0, "junk")
        .when(k % 5 == 1, F.concat(F.lit('{"Temperature":"x","RH":'), user, F.lit("}")))
        .otherwise(F.concat(F.lit('{"Temperature":'), F.col("value").cast("string"),
                            F.lit(',"RH":'), user, F.lit("}"))))
    parsed = parse_messages(table(spark, sf_dir, "events").select(k, message.alias("value")))
    return parsed.select(
        k, "temperature", "rh", "ws", "rain",
        F.to_json(F.struct(F.col("rh").cast("int").alias("RH"))).alias("rh_json"))
