"""Scans, projections, filters, scalar functions, sorts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberfold.functions import scalars as s
from emberfold.operators.repair import keep_first
from emberfold.plans import fixed_values as fixed
from emberfold.queries.base import amount, query, sql_decode, sql_money, table
from emberfold.sources.files import bronze_manifest, landed_lines, project, read_csv
from emberfold.sources.tables import create_table, publish, publish_all, publish_set, read_set, read_table
from emberfold.storage import scratch_path

# The driver tables hold no NULLs and no junk. The CASE expressions on row keys
# below put some in, in the same way here and in the SQL; they drop no row.


@query("a1_csv_roundtrip", f"""
    SELECT p_brand, COUNT(*) AS parts, CAST(SUM(p_size) AS BIGINT) AS total_size,
           {sql_money('p_retailprice')} AS total_price
    FROM part GROUP BY p_brand""")
def a1_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "part-csv")
    part = table(spark, sf_dir, "part")
    part.write.options(header=True, sep=";").csv(path)
    back = read_csv(spark, path, sep=";", schema=part.schema)
    return back.groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("parts"), F.sum("p_size").alias("total_size"),
        (F.sum(amount("p_retailprice")) / 100.0).alias("total_price"))


@query("a4_table_scan", """
    SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
    UNION ALL SELECT -1, 'typed', 0, 0.0""")
def a4_table_scan(spark, sf_dir):
    root = scratch_path(spark, "tables")
    stored = publish(table(spark, sf_dir, "supplier"), "emberfold_scan", "supplier", root)
    name = "emberfold_scan.typed_" + root[-32:]
    create_table(spark, name, "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
                 f"{root}/typed")
    spark.sql(f"INSERT INTO {name} VALUES (-1, 'typed', 0, 0.0D)")
    return stored.unionByName(read_table(spark, name))


_PUBLISHED = {"nation": "n_nationkey", "supplier": "s_suppkey", "part": "p_partkey"}


@query("a9_publish_all", " UNION ALL ".join(
    f"SELECT '{name}' AS name, COUNT(*) AS stored, CAST(SUM({key}) AS BIGINT) AS keys FROM {name}"
    for name, key in _PUBLISHED.items()))
def a9_publish_all(spark, sf_dir):
    """Published twice, so that the second run replaces tables; one is partitioned."""
    root, tables = scratch_path(spark, "published"), {
        name: table(spark, sf_dir, name) for name in _PUBLISHED}
    for _ in range(2):
        stored = publish_all(tables, "emberfold_published", root, {"part": ["p_size"]})
    counts = [stored[name].agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("stored"),
                               F.sum(key).alias("keys")) for name, key in _PUBLISHED.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("a9_publish_set", f"""
    SELECT r.read AS read, t.name, CASE WHEN r.read = 'old set' THEN n ELSE n + extra END AS stored,
           CASE WHEN r.read = 'old set' OR t.name <> 'part' THEN c ELSE c + 1 END AS columns
    FROM ({" UNION ALL ".join(
        f"SELECT '{name}' AS name, COUNT(*) AS n, "
        f"(SELECT COUNT(*) FROM (DESCRIBE {name})) AS c, COUNT(*) FILTER ({key} % 2 = 0) AS extra FROM {name}"
        for name, key in _PUBLISHED.items())}) t,
      (VALUES ('old set'), ('new set'), ('views')) AS r(read)""")
def a9_publish_set(spark, sf_dir):
    """Two versions of a set; the first is read after the second is there. One table is partitioned and gains a column."""
    root, schema = scratch_path(spark, "sets"), "emberfold_set"
    tables = {name: table(spark, sf_dir, name) for name in _PUBLISHED}
    layout = {"part": ["p_size"]}
    publish_set(tables, schema, root, layout)
    old = read_set(spark, schema, root)
    more = {name: df.unionByName(df.where(F.col(_PUBLISHED[name]) % 2 == 0)) for name, df in tables.items()}
    more["part"] = more["part"].withColumn("season", F.lit("new"))
    publish_set(more, schema, root, layout)
    reads = {"old set": old, "new set": read_set(spark, schema, root),
             "views": {name: read_table(spark, f"{schema}.{name}") for name in _PUBLISHED}}
    counts = [df.agg(F.lit(read).alias("read"), F.lit(name).alias("name"), F.count(F.lit(1)).alias("stored"),
                     F.lit(len(df.columns)).cast("bigint").alias("columns"))
              for read, found in reads.items() for name, df in found.items()]
    return reduce(DataFrame.unionByName, counts)


@query("a15_bronze_manifest", """
    SELECT 'customers' AS dataset, COUNT(*) AS lines FROM customer
    UNION ALL SELECT 'orders', COUNT(*) FROM orders
    UNION ALL SELECT 'parts', COUNT(*) FROM part""")
def a15_bronze_manifest(spark, sf_dir):
    root = scratch_path(spark, "bronze")
    root = f"{root}/2024 raw/bronze"  # a folder name that comes twice, blanks and brackets
    for dataset, name in (("customers", "a b (2)/bronze/100%+"), ("orders", "orders"), ("parts", "part")):
        table(spark, sf_dir, dataset.rstrip("s") if dataset != "orders" else dataset).write.csv(
            f"{root}/{dataset}/{name}")
    files = bronze_manifest(spark, root)
    counted = files.join(landed_lines(spark, root), ["dataset", "relative_path"])
    return counted.groupBy("dataset").agg(F.sum("lines").alias("lines"))


_TEXTS_SQL = """(SELECT s_suppkey, s_name || CASE s_suppkey % 4 WHEN 0 THEN ' "quoted" ' WHEN 1
    THEN ', comma' WHEN 2 THEN chr(10) || 'second line' ELSE ' plain' END AS note FROM supplier)"""


@query("a2_csv_quoted", f"SELECT s_suppkey, note, s_suppkey AS again FROM {_TEXTS_SQL} t")
def a2_csv_quoted(spark, sf_dir):
    k, path = F.col("s_suppkey"), scratch_path(spark, "quoted-csv")
    end = (F.when(k % 4 == 0, ' "quoted" ').when(k % 4 == 1, ", comma")
           .when(k % 4 == 2, "\nsecond line").otherwise(" plain"))
    rows = table(spark, sf_dir, "supplier").select(
        k, F.concat("s_name", end).alias("note"), k.alias("again"))
    rows.write.options(header=True, escape='"', ignoreTrailingWhiteSpace=False).csv(path)
    return read_csv(spark, path, schema=rows.schema, multi_line=True)


@query("a2_csv_corrupt", """
    SELECT s_suppkey % 5 = 0 AS corrupt, COUNT(*) AS lines,
           CAST(SUM(CASE WHEN s_suppkey % 5 <> 0 THEN s_nationkey END) AS BIGINT) AS nations
    FROM supplier GROUP BY 1""")
def a2_csv_corrupt(spark, sf_dir):
    k, path = F.col("s_suppkey"), scratch_path(spark, "corrupt-csv")
    cell = F.when(k % 5 == 0, "none").otherwise(F.col("s_nationkey").cast("string"))
    table(spark, sf_dir, "supplier").select(k, cell.alias("s_nationkey")).write.options(
        header=True).csv(path)
    back = read_csv(spark, path, schema="s_suppkey bigint, s_nationkey int", keep_corrupt=True)
    return back.groupBy(F.col("_corrupt_record").isNotNull().alias("corrupt")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("s_nationkey").alias("nations"))


@query("p1_project_rename", """
    SELECT o_orderkey AS id, o_custkey AS owner, o_totalprice AS total, o_orderpriority AS priority
    FROM orders""")
def p1_project_rename(spark, sf_dir):
    return project(table(spark, sf_dir, "orders"),
                   ["`o_orderkey`", "o_custkey", "o_totalprice", "o_orderpriority"],
                   ["id", "owner", "total", "priority"])


def _dated(spark, sf_dir):
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        k,
        F.when(k % 11 == 0, -50).when(k % 13 == 0, None).otherwise(F.year(d)).alias("year"),
        F.when(k % 7 == 0, None).otherwise(F.month(d)).alias("month"),
        F.when(k % 5 == 0, None).otherwise(F.dayofmonth(d)).alias("day"),
        F.when(k % 6 == 0, -1).when(k % 9 == 0, None).otherwise(
            (F.col("o_custkey") % 5).cast("int")).alias("validity"),
        F.when(k % 3 == 0, None).otherwise((F.col("o_custkey") % 100).cast("int")).alias("deaths"))


_DATED_SQL = """(SELECT o_orderkey,
    CASE WHEN o_orderkey % 11 = 0 THEN -50 WHEN o_orderkey % 13 = 0 THEN NULL
         ELSE CAST(year(o_orderdate) AS INTEGER) END AS year,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(month(o_orderdate) AS INTEGER) END AS month,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(day(o_orderdate) AS INTEGER) END AS day,
    CASE WHEN o_orderkey % 6 = 0 THEN -1 WHEN o_orderkey % 9 = 0 THEN NULL
         ELSE CAST(o_custkey % 5 AS INTEGER) END AS validity,
    CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_custkey % 100 AS INTEGER) END AS deaths
  FROM orders)"""


@query("b1_filters", f"SELECT * FROM {_DATED_SQL} d WHERE year > 0 AND validity <> -1")
def b1_filters(spark, sf_dir):
    return _dated(spark, sf_dir).where(F.col("year") > 0).where(F.col("validity") != -1)


@query("b4_null_logic", f"""
    SELECT o_orderkey, month, day, deaths, COALESCE(month, day, -1) AS first_known
    FROM {_DATED_SQL} d
    WHERE (month IS NOT NULL OR day IS NOT NULL)
      AND NOT ((month IS NULL OR day IS NULL) AND deaths IS NULL)""")
def b4_null_logic(spark, sf_dir):
    month, day, deaths = F.col("month"), F.col("day"), F.col("deaths")
    return (
        _dated(spark, sf_dir).where(s.any_present(month, day))
        .where(s.dated_or_counted([month, day], deaths))
        .select("o_orderkey", month, day, deaths,
                F.coalesce(month, day, F.lit(-1)).alias("first_known")))


@query("b5_castable", """
    SELECT event_id, TRY_CAST(raw_int AS INTEGER) AS k, TRY_CAST(raw_num AS DOUBLE) AS num
    FROM (SELECT event_id,
            CASE WHEN event_id % 5 = 0 THEN 'abc' WHEN event_id % 7 = 0 THEN NULL
                 ELSE json_extract_string(props, '$.k') END AS raw_int,
            CASE WHEN event_id % 11 = 0 THEN 'n/a' WHEN event_id % 13 = 0 THEN NULL
                 ELSE CAST(value AS VARCHAR) END AS raw_num
          FROM events) e
    WHERE (TRY_CAST(raw_int AS INTEGER) IS NOT NULL OR raw_int IS NULL)
      AND TRY_CAST(raw_num AS DOUBLE) IS NOT NULL""")
def b5_castable(spark, sf_dir):
    k = F.col("event_id")
    raw = table(spark, sf_dir, "events").select(
        k,
        F.when(k % 5 == 0, "abc").when(k % 7 == 0, None).otherwise(
            F.get_json_object("props", "$.k")).alias("raw_int"),
        F.when(k % 11 == 0, "n/a").when(k % 13 == 0, None).otherwise(
            F.col("value").cast("string")).alias("raw_num"))
    return raw.where(
        s.castable_or_null(F.col("raw_int"), "int") & s.castable(F.col("raw_num"), "double")
    ).select(k, F.col("raw_int").try_cast("int").alias("k"),
             F.col("raw_num").try_cast("double").alias("num"))


@query("d7_decode", f"""
    SELECT p_partkey, {sql_decode('p_size', fixed.TSUNAMI_CAUSE)} AS cause,
           {sql_decode('p_size', fixed.EXPLOSIVITY)} AS explosivity
    FROM part""")
def d7_decode(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", s.decode("p_size", fixed.TSUNAMI_CAUSE).alias("cause"),
        s.decode("p_size", fixed.EXPLOSIVITY).alias("explosivity"))


@query("d8_binary_encode", """
    SELECT event_id, CASE WHEN lower(trim(t)) = 'error' THEN 1 ELSE 0 END AS is_error
    FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN '  ' || upper(event_type) || ' '
                 WHEN 1 THEN event_type ELSE NULL END AS t FROM events) e""")
def d8_binary_encode(spark, sf_dir):
    k, t = F.col("event_id"), F.col("event_type")
    stray = F.when(k % 3 == 0, F.concat(F.lit("  "), F.upper(t), F.lit(" "))).when(k % 3 == 1, t)
    return table(spark, sf_dir, "events").select(
        k, s.binary_flag(stray, "error").alias("is_error"))


@query("d10_split_coords", """
    SELECT o_orderkey,
           TRY_CAST(trim(list_extract(regexp_split_to_array(pair, ',\\s*'), 1)) AS DOUBLE) AS latitude,
           TRY_CAST(trim(list_extract(regexp_split_to_array(pair, ',\\s*'), 2)) AS DOUBLE) AS longitude
    FROM (SELECT o_orderkey,
            CASE WHEN o_orderkey % 17 = 0 THEN 'x, y' WHEN o_orderkey % 19 = 0 THEN lat
                 WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN lat || ', ' || lon
                 ELSE lat || ',' || lon END AS pair
          FROM (SELECT o_orderkey, CAST(o_custkey % 180 - 90 AS VARCHAR) || '.25' AS lat,
                       CAST(o_orderkey % 360 - 180 AS VARCHAR) || '.5' AS lon FROM orders) o) p""")
def d10_split_coords(spark, sf_dir):
    k = F.col("o_orderkey")
    lat = F.concat((F.col("o_custkey") % 180 - 90).cast("string"), F.lit(".25"))
    lon = F.concat((k % 360 - 180).cast("string"), F.lit(".5"))
    pair = (
        F.when(k % 17 == 0, "x, y").when(k % 19 == 0, lat).when(k % 23 == 0, None)
        .when(k % 2 == 0, F.concat(lat, F.lit(", "), lon)).otherwise(F.concat(lat, F.lit(","), lon)))
    return table(spark, sf_dir, "orders").select(k, pair.alias("pair")).select(
        k, s.pair_part(F.col("pair"), 0).alias("latitude"),
        s.pair_part(F.col("pair"), 1).alias("longitude"))


@query("e2_string_fns", """
    SELECT p_partkey, trim(replace(p_name || 'Nan ', 'Nan', ' ')) AS cleaned,
           upper(p_type) AS shout, list_extract(string_split(p_name, ' '), 2) AS second_word,
           CASE WHEN length(CAST(p_size AS VARCHAR)) >= 2 THEN CAST(p_size AS VARCHAR)
                ELSE lpad(CAST(p_size AS VARCHAR), 2, '0') END AS padded,
           substr(p_brand, 1, 4) AS cut,
           CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_brand || '-' || p_type END AS joined
    FROM part""")
def e2_string_fns(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", s.clean_token(F.concat("p_name", F.lit("Nan "))).alias("cleaned"),
        F.upper("p_type").alias("shout"), F.get(F.split("p_name", " "), 1).alias("second_word"),
        F.lpad(F.col("p_size").cast("string"), 2, "0").alias("padded"),
        F.lpad("p_brand", 4, "0").alias("cut"),
        F.concat(F.when(F.col("p_size") % 4 != 0, F.col("p_brand")), F.lit("-"),
                 F.col("p_type")).alias("joined"))


@query("e3_date_parts", """
    SELECT event_id, ts_text, CAST(year(t) AS INTEGER) AS year, CAST(month(t) AS INTEGER) AS month,
           CAST(day(t) AS INTEGER) AS day, CAST(hour(t) AS INTEGER) AS hour,
           CAST(minute(t) AS INTEGER) AS minute, CAST(quarter(t) AS INTEGER) AS quarter,
           CAST(dayofweek(t) + 1 AS INTEGER) AS weekday_sun1,
           CAST(isodow(t) AS INTEGER) AS weekday, CAST(dayofyear(t) AS INTEGER) AS day_of_year,
           CAST(CAST(t AS DATE) AS VARCHAR) AS full_date
    FROM (SELECT event_id, ts_text, TRY_STRPTIME(ts_text, '%m/%d/%Y %I:%M:%S %p') AS t
          FROM (SELECT event_id, CASE WHEN event_id % 31 = 0 THEN 'no date'
                       ELSE strftime(ts, '%m/%d/%Y %I:%M:%S %p') END AS ts_text FROM events) a) b""")
def e3_date_parts(spark, sf_dir):
    k, fmt = F.col("event_id"), "MM/dd/yyyy hh:mm:ss a"
    text = F.when(k % 31 == 0, "no date").otherwise(F.date_format("ts", fmt))
    t = F.col("t")
    return (
        table(spark, sf_dir, "events").select(k, text.alias("ts_text"))
        .withColumn("t", F.try_to_timestamp("ts_text", F.lit(fmt)))
        .select(k, "ts_text", *[c.alias(n) for n, c in s.timestamp_parts(t).items()],
                F.quarter(t).alias("quarter"), s.sunday_first_weekday(t).alias("weekday_sun1"),
                s.iso_weekday(t).alias("weekday"), F.dayofyear(t).alias("day_of_year"),
                F.to_date(t).cast("string").alias("full_date")))


@query("e4_math_fns", """
    SELECT event_id, abs(value - 50.0) AS distance, CAST(mod(event_id, 7) AS BIGINT) AS rest,
           round(exp(-value / 100.0), 6) AS decay, round(pow(value / 100.0, 5.31), 6) AS powered,
           CASE WHEN v IS NULL THEN NULL ELSE greatest(1.1, least(65.9, v)) END AS clamped
    FROM (SELECT *, CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS v FROM events) e""")
def e4_math_fns(spark, sf_dir):
    value = F.col("value")
    clean = F.when(F.col("event_id") % 10 != 0, value)
    return table(spark, sf_dir, "events").select(
        "event_id", F.abs(value - 50.0).alias("distance"),
        (F.col("event_id") % 7).alias("rest"), F.round(F.exp(-value / 100.0), 6).alias("decay"),
        F.round(F.pow(value / 100.0, F.lit(5.31)), 6).alias("powered"),
        F.when(clean.isNotNull(), F.greatest(F.lit(1.1), F.least(F.lit(65.9), clean))).alias(
            "clamped"))


_KEPT = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]


@query("k3_dedup", f"""
    SELECT l_orderkey, l_linenumber, {', '.join(_KEPT)}
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                       ORDER BY {', '.join(_KEPT)}) AS r FROM lineitem) t
    WHERE r = 1""")
def k3_dedup(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *_KEPT)
    return keep_first(lines, ["l_orderkey", "l_linenumber"], _KEPT)


@query("k4_distinct", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def k4_distinct(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query("l1_sort_limit", """
    SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def l1_sort_limit(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderpriority").orderBy(
        F.desc("o_totalprice"), "o_orderkey").limit(10)
