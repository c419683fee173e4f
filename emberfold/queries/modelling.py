"""Keys, dimensions, facts, checks on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberfold.functions import scalars as s
from emberfold.operators.dimensional import (
    assign_keys, attribute_conflicts, build_dimension, build_fact, conformed_dimension, dim_date, dimension_members,
    merge_members, with_member_key)
from emberfold.operators.incremental import append_batch, batch_results
from emberfold.operators.joins import lookup_join
from emberfold.operators.quality import (
    Check, ForeignKey, QualityGateError, foreign_key_flags, gate, orphans, run_checks)
from emberfold.queries.base import query, table
from emberfold.storage import scratch_path


@query("g1_dim_date", """
    WITH b AS (SELECT MIN(CAST(o_orderdate AS DATE)) AS lo, MAX(CAST(o_orderdate AS DATE)) AS hi
               FROM orders),
         d AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP),
                                                  INTERVAL 1 DAY)) AS DATE) AS full_date FROM b),
         o AS (SELECT CAST(o_orderdate AS DATE) AS od, COUNT(*) AS n FROM orders GROUP BY 1)
    SELECT CAST(day(full_date) * 1000000 + month(full_date) * 10000 + year(full_date) AS INTEGER)
             AS date_key, CAST(full_date AS VARCHAR) AS full_date, CAST(year(full_date) AS INTEGER) AS year,
           CAST(month(full_date) AS INTEGER) AS month, CAST(day(full_date) AS INTEGER) AS day,
           CAST(quarter(full_date) AS INTEGER) AS quarter,
           CAST(isodow(full_date) AS INTEGER) AS weekday,
           CAST(dayofweek(full_date) + 1 AS INTEGER) AS weekday_sun1,
           CAST(dayofyear(full_date) AS INTEGER) AS day_of_year, COALESCE(n, 0) AS orders
    FROM d LEFT JOIN o ON d.full_date = o.od""")
def g1_dim_date(spark, sf_dir):
    day = F.to_date("o_orderdate")
    orders = table(spark, sf_dir, "orders")
    first, last = orders.agg(F.min(day), F.max(day)).first()
    per_day = orders.groupBy(
        s.date_key(F.dayofmonth(day), F.month(day), F.year(day)).alias("date_key")).agg(
        F.count(F.lit(1)).alias("orders"))
    return dim_date(spark, first, last).join(per_day, "date_key", "left").withColumns({
        "full_date": F.col("full_date").cast("string"),
        "orders": F.coalesce("orders", F.lit(0).cast("bigint"))})


@query("g2_hash_key", """
    SELECT COUNT(DISTINCT c_name) AS names, COUNT(DISTINCT c_name) AS keys,
           (SELECT COUNT(*) FROM orders) AS orders_matched, CAST(0 AS BIGINT) AS null_keys
    FROM customer""")
def g2_hash_key(spark, sf_dir):
    name = F.col("c_name")
    members = build_dimension(table(spark, sf_dir, "customer"), name, "name", "key")
    owner = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    per_key = table(spark, sf_dir, "orders").groupBy(s.surrogate_key(owner).alias("key")).agg(
        F.count(F.lit(1)).alias("n"))
    matched = members.join(per_key, "key", "left")
    return matched.agg(
        F.countDistinct("name").alias("names"), F.countDistinct("key").alias("keys"),
        F.sum("n").alias("orders_matched"),
        F.sum((F.col("key") == s.UNKNOWN_KEY).cast("bigint")).alias("null_keys"))


@query("g2_key_collisions", """
    WITH members AS (SELECT c_custkey, c_name, c_custkey // 3 * 3 + row_number() OVER (
        PARTITION BY c_custkey // 3 ORDER BY c_name) - 1 AS key FROM customer)
    SELECT c_name AS name, CAST(key AS BIGINT) AS key, COUNT(o_orderkey) AS orders
    FROM members LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_name, key""")
def g2_key_collisions(spark, sf_dir):
    """Keys on which three members each collide at first; the orders follow those that move."""
    def key_of(name, attempt):
        number = F.substring(name, 10, 9).cast("bigint")
        return F.floor(number / 3) * 3 + attempt

    members = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"))
    keys = assign_keys(members, "name", "key", key_of)
    orders = table(spark, sf_dir, "orders").select(F.concat(
        F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("owner"))
    per_key = with_member_key(orders, "owner", "key", keys, key_of).groupBy("key").agg(F.count(F.lit(1)).alias("orders"))
    return keys.join(per_key, "key", "left").select(
        "name", "key", F.coalesce("orders", F.lit(0).cast("bigint")).alias("orders"))


@query("g5_dimension_merge", """
    WITH m AS (SELECT c_name AS name, MIN(c_mktsegment) AS segment, COUNT(*) AS n FROM customer GROUP BY c_name)
    SELECT name, CASE WHEN CAST(substr(name, 10) AS BIGINT) % 5 = 0 THEN 'moved ' || segment ELSE segment END AS segment,
           CAST(CAST(substr(name, 10) AS BIGINT) // 2 * 2 + CASE WHEN CAST(substr(name, 10) AS BIGINT) % 2 = 1 AND EXISTS (
             SELECT 1 FROM m o WHERE CAST(substr(o.name, 10) AS BIGINT) = CAST(substr(m.name, 10) AS BIGINT) - 1) THEN 1
             ELSE 0 END AS BIGINT) AS key,
           CASE WHEN CAST(substr(name, 10) AS BIGINT) % 5 = 0 THEN segment END AS before
    FROM m""")
def g5_dimension_merge(spark, sf_dir):
    """Even members first; then all of them, where every fifth has a new segment. Keys collide in pairs."""
    path = scratch_path(spark, "members")
    number = F.substring("name", 10, 9).cast("bigint")
    key_of = lambda name, attempt: F.floor(F.substring(name, 10, 9).cast("bigint") / 2) * 2 + attempt
    members = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    moved = members.withColumn("segment", F.when(number % 5 == 0, F.concat(F.lit("moved "), "segment")).otherwise(
        F.col("segment")))
    # the odd ones of the second batch that change have come with the first as well
    first = members.where((number % 2 == 0) | (number % 5 == 0))
    for batch_id, rows in ((0, first), (1, moved), (1, moved)):
        merge_members(spark, path, batch_id, rows, "name", "key", ["segment"], key_of)
    kinds = members.select("name", F.struct("segment").alias("a")).schema
    stored = dimension_members(spark, path, "name", "key", kinds["a"].dataType, kinds["name"].dataType, 1)
    before = spark.read.parquet(f"{path}/changes").where("batch_id = 1").select(
        "key", F.col("before.segment").alias("before"))
    return stored.join(before, "key", "left").select("name", F.col("_present.segment").alias("segment"), "key", "before")


@query("g3_code_dim", """
    SELECT COALESCE(t, 'unknown') AS type, COUNT(*) AS parts
    FROM (SELECT CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_type END AS t FROM part) p GROUP BY 1""")
def g3_code_dim(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        F.when(F.col("p_size") % 10 != 0, F.col("p_type")).alias("t"))
    types = build_dimension(part, F.col("t"), "type", "type_key")
    per_key = part.groupBy(s.surrogate_key(F.col("t")).alias("type_key")).agg(
        F.count(F.lit(1)).alias("parts"))
    return types.join(per_key, "type_key").select("type", "parts")


@query("g4_entity_dim", """
    SELECT name, size, type, brand, variants FROM (
      SELECT p_name AS name, abs(5 - p_size) AS size, p_type AS type, p_brand AS brand,
             row_number() OVER (PARTITION BY p_name ORDER BY abs(5 - p_size), p_type, p_brand) AS r,
             COUNT(DISTINCT (abs(5 - p_size), p_type, p_brand)) OVER (PARTITION BY p_name)
               AS variants
      FROM part WHERE p_name <> 'red widget') t WHERE r = 1""")
def g4_entity_dim(spark, sf_dir):
    named = table(spark, sf_dir, "part").where(F.col("p_name") != "red widget")
    attributes = {"size": F.abs(F.lit(5) - F.col("p_size")), "type": F.col("p_type"),
                  "brand": F.col("p_brand")}
    members = build_dimension(named, F.col("p_name"), "name", "key", attributes)
    conflicts = attribute_conflicts(named, F.col("p_name"), "name", attributes)
    return members.join(conflicts, "name", "left").select(
        "name", "size", "type", "brand",
        F.coalesce("variants", F.lit(1).cast("bigint")).alias("variants"))


@query("u1_conformed_dim", """
    SELECT DISTINCT location FROM (
      SELECT upper(n_name) AS location FROM customer JOIN nation ON c_nationkey = n_nationkey
      UNION ALL SELECT upper(n_name) FROM supplier JOIN nation ON s_nationkey = n_nationkey
      UNION ALL SELECT upper(r_name) FROM region
      UNION ALL SELECT upper(c_mktsegment) FROM customer) u""")
def u1_conformed_dim(spark, sf_dir):
    nation, customer = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    supplier = table(spark, sf_dir, "supplier")
    return conformed_dimension([
        (customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")), F.upper("n_name")),
        (supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")), F.upper("n_name")),
        (table(spark, sf_dir, "region"), F.upper("r_name")),
        (customer, F.upper("c_mktsegment")),
    ], "location", "location_key").select("location")


_DIGEST_SQL = "md5(" + " || '|' || ".join(
    f"CAST(length({c}) AS VARCHAR) || ':' || {c}" for c in (
        "CAST(o_orderkey AS VARCHAR)", "o_orderstatus", "o_orderpriority")) + ")"


@query("g5_fact_build", f"""
    SELECT {_DIGEST_SQL} AS id_order,
           CAST(day(o_orderdate) * 1000000 + month(o_orderdate) * 10000 + year(o_orderdate)
                AS INTEGER) AS date_key, o_orderstatus AS status, o_orderpriority AS priority,
           o_totalprice AS total
    FROM orders""")
def g5_fact_build(spark, sf_dir):
    orders, d = table(spark, sf_dir, "orders"), F.col("o_orderdate")
    fact = build_fact(
        orders, ("id_order", s.row_digest(F.col("o_orderkey"), F.col("o_orderstatus"),
                                          F.col("o_orderpriority"))),
        F.dayofmonth(d), F.month(d), F.year(d),
        {"status_key": F.col("o_orderstatus"), "priority_key": F.col("o_orderpriority")},
        {"total": F.col("o_totalprice")})
    status = build_dimension(orders, F.col("o_orderstatus"), "status", "status_key")
    priority = build_dimension(orders, F.col("o_orderpriority"), "priority", "priority_key")
    # dimensions made from the fact: counted, so that the fact need not move on a few keys
    joined = lookup_join(lookup_join(fact, status, ["status_key"], stored=False), priority,
                         ["priority_key"], stored=False)
    return joined.select(
        "id_order", "date_key", "status", "priority", "total")


@query("g7_date_key", """
    SELECT o_orderkey, CAST(d * 1000000 + m * 10000 + y AS INTEGER) AS date_key,
           CAST(y * 10000 + m * 100 + d AS INTEGER) AS sortable_key
    FROM (SELECT o_orderkey, day(o_orderdate) AS d, year(o_orderdate) AS y,
                 CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE month(o_orderdate) END AS m
          FROM orders) o""")
def g7_date_key(spark, sf_dir):
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    parts = (F.dayofmonth(d), F.when(k % 7 != 0, F.month(d)), F.year(d))
    return table(spark, sf_dir, "orders").select(
        k, s.date_key(*parts).alias("date_key"), s.sortable_date_key(*parts).alias("sortable_key"))


def _ratio_sql(check, label, expr, source, holds="= 1.0"):
    return (f"SELECT '{check}' AS \"check\", '{label}' AS \"constraint\", m AS metric, "
            f"CASE WHEN m {holds} THEN 'Success' ELSE 'Failure' END AS constraint_status "
            f"FROM (SELECT {expr} AS m FROM {source}) t")


def share_sql(predicate):
    return f"AVG(CASE WHEN {predicate} THEN 1.0 ELSE 0.0 END)"


def unique_sql(column, source):
    return (f"(SELECT CAST(SUM(CASE WHEN n = 1 THEN 1 ELSE 0 END) AS DOUBLE) / SUM(n) AS u FROM "
            f"(SELECT COUNT(*) AS n FROM {source} WHERE {column} IS NOT NULL GROUP BY {column}) c) q")


# Every ninth line points to a supplier that does not exist.
_LINES = """(SELECT *, CASE WHEN l_partkey % 8 = 0 THEN NULL ELSE l_quantity END AS qty,
    CASE WHEN l_orderkey % 9 = 0 THEN -l_suppkey - 1 ELSE l_suppkey END AS supp,
    CASE WHEN l_orderkey % 9 = 0 THEN 'nobody' ELSE s_name END AS supp_name
  FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey) l"""
_CHECKS_SQL = " UNION ALL ".join([
    _ratio_sql("lineitem", "complete(l_orderkey)", share_sql("l_orderkey IS NOT NULL"), _LINES),
    _ratio_sql("lineitem", "complete(qty)", share_sql("qty IS NOT NULL"), _LINES),
    _ratio_sql("lineitem", "completeness(qty)", share_sql("qty IS NOT NULL"), _LINES, "> 0.5"),
    _ratio_sql("lineitem", "few pieces", share_sql("qty < 40"), _LINES),
    _ratio_sql("lineitem", "tax range", share_sql("l_tax BETWEEN 0 AND 0.08"), _LINES),
    _ratio_sql("lineitem", "order exists", share_sql(
        "l_orderkey IN (SELECT o_orderkey FROM orders)"), _LINES),
    _ratio_sql("lineitem", "supplier exists", share_sql(
        "supp IN (SELECT s_suppkey FROM supplier)"), _LINES),
    _ratio_sql("lineitem", "supplier name exists", share_sql(
        "supp_name IN (SELECT s_name FROM supplier)"), _LINES),
    _ratio_sql("orders", "complete(o_custkey)", share_sql("o_custkey IS NOT NULL"), "orders"),
    _ratio_sql("orders", "unique(o_orderkey)", "u", unique_sql("o_orderkey", "orders")),
    _ratio_sql("orders", "unique(o_totalprice)", "u", unique_sql("o_totalprice", "orders")),
    _ratio_sql("part", "unique(p_name)", "u", unique_sql("p_name", "part")),
    _ratio_sql("part", "complete(p_type)", share_sql("p_type IS NOT NULL"), "part"),
])


def _checked(spark, sf_dir):
    """Tables with their constraints."""
    orders, part = table(spark, sf_dir, "orders"), table(spark, sf_dir, "part")
    supplier = table(spark, sf_dir, "supplier")
    lost = F.col("l_orderkey") % 9 == 0
    lines = table(spark, sf_dir, "lineitem").join(
        supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name"), "l_suppkey", "left").withColumns({
            "qty": F.when(F.col("l_partkey") % 8 != 0, F.col("l_quantity")),
            "supp": F.when(lost, -F.col("l_suppkey") - 1).otherwise(F.col("l_suppkey")),
            "supp_name": F.when(lost, "nobody").otherwise(F.col("s_name"))})
    return [
        (lines, Check("lineitem").is_complete("l_orderkey", "qty")
         .has_completeness("qty", lambda m: m > 0.5).satisfies("qty < 40", "few pieces")
         .satisfies("l_tax BETWEEN 0 AND 0.08", "tax range")
         .has_parent("order exists", ForeignKey("l_orderkey", orders, "o_orderkey"))
         .has_parent("supplier exists", ForeignKey("supp", supplier, "s_suppkey"))
         .has_parent("supplier name exists", ForeignKey("supp_name", supplier, "s_name"))),
        (orders, Check("orders").is_complete("o_custkey").is_unique("o_orderkey", "o_totalprice")),
        (part, Check("part").is_unique("p_name").is_complete("p_type")),
    ]


def _checks(spark, sf_dir):
    return run_checks(_checked(spark, sf_dir))


@query("q1_constraints", _CHECKS_SQL)
def q1_constraints(spark, sf_dir):
    return _checks(spark, sf_dir)


@query("q1_incremental", _CHECKS_SQL)
def q1_incremental(spark, sf_dir):
    """Three batches measured one by one, the second of them twice; none reads the rows of another."""
    path, checked = scratch_path(spark, "measures"), _checked(spark, sf_dir)
    for batch_id in (0, 1, 1, 2):
        append_batch(spark, path, batch_id, [
            (df.where(F.pmod(F.xxhash64(df.columns[0]), F.lit(3)) == batch_id), check) for df, check in checked], buckets=16)
    return batch_results(spark, path, [check for _, check in checked], through=2)


@query("q4_gate", f"""
    SELECT "check", COUNT(*) AS constraints,
           CAST(SUM(CASE WHEN constraint_status <> 'Success' THEN 1 ELSE 0 END) AS BIGINT) AS failed,
           BOOL_AND(constraint_status = 'Success') AS passed
    FROM ({_CHECKS_SQL}) r GROUP BY "check" """)
def q4_gate(spark, sf_dir):
    bad = F.col("constraint_status") != "Success"
    return _checks(spark, sf_dir).groupBy("check").agg(
        F.count(F.lit(1)).alias("constraints"), F.sum(bad.cast("bigint")).alias("failed"),
        F.bool_and(~bad).alias("passed"))


@query("q4_gate_run", """
    SELECT 'keys' AS name, TRUE AS passed, 0 AS failed
    UNION ALL SELECT 'amounts', COUNT(*) = 0, CAST(COUNT(*) AS INTEGER)
      FROM (SELECT MAX(o_totalprice) AS m FROM orders) o WHERE m >= 1000""")
def q4_gate_run(spark, sf_dir):
    """The gate on a sound and on a failing set; what it said, as rows."""
    orders = table(spark, sf_dir, "orders")
    sets = {"keys": Check("orders").is_complete("o_orderkey").is_unique("o_orderkey"),
            "amounts": Check("orders").satisfies("o_totalprice < 1000", "small")}
    outcomes = []
    for name, check in sets.items():
        try:
            gate(run_checks([(orders, check)]))
            outcomes.append((name, True, 0))
        except QualityGateError as error:
            outcomes.append((name, False, int(str(error).split()[0])))
    return spark.createDataFrame(outcomes, "name string, passed boolean, failed int")


# A third of the lines share one supplier, every ninth points to one that does not exist, and line 7
# has none; brands are text keys.
_KEYS_SQL = """(SELECT l_orderkey, l_linenumber,
    CASE WHEN l_linenumber = 7 THEN NULL WHEN l_orderkey % 3 = 0 THEN 1
         WHEN l_orderkey % 9 = 1 THEN -l_suppkey - 1 ELSE l_suppkey END AS supp,
    CASE WHEN l_orderkey % 4 = 0 THEN 'none' ELSE 'Customer#' || l_partkey END AS cust,
    CASE WHEN l_partkey % 6 = 0 THEN -l_partkey ELSE l_partkey END AS part FROM lineitem)"""


@query("q2_fk_validate", f"""
    SELECT l.*, CASE WHEN supp IN (SELECT s_suppkey FROM supplier) THEN 1 ELSE 0 END AS supplier_valid,
           CASE WHEN cust IN (SELECT 'Customer#' || c_custkey FROM customer) THEN 1 ELSE 0 END
             AS customer_valid,
           CASE WHEN part IN (SELECT p_partkey FROM part) THEN 1 ELSE 0 END AS part_valid
    FROM {_KEYS_SQL} l""")
def q2_fk_validate(spark, sf_dir):
    order, part = F.col("l_orderkey"), F.col("l_partkey")
    supp = F.when(F.col("l_linenumber") == 7, None).when(order % 3 == 0, 1).when(
        order % 9 == 1, -F.col("l_suppkey") - 1).otherwise(F.col("l_suppkey"))
    lines = table(spark, sf_dir, "lineitem").select(
        order, "l_linenumber", supp.alias("supp"),
        F.when(order % 4 == 0, "none").otherwise(
            F.concat(F.lit("Customer#"), part.cast("string"))).alias("cust"),
        F.when(part % 6 == 0, -part).otherwise(part).alias("part"))
    customer = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("Customer#"), F.col("c_custkey").cast("string")).alias("c_name"))
    return foreign_key_flags(lines, {
        "supplier_valid": ForeignKey("supp", table(spark, sf_dir, "supplier"), "s_suppkey"),
        "customer_valid": ForeignKey("cust", customer, "c_name"),
        "part_valid": ForeignKey("part", table(spark, sf_dir, "part"), "p_partkey")})


@query("q3_orphans", """
    SELECT doc_id, lang, source, n_chars FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def q3_orphans(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return orphans(docs, ForeignKey("doc_id", table(spark, sf_dir, "labels"), "doc_id"))
