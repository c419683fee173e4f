"""Impact by region and year, by type, and across facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberfold.operators.rollups import append_sums, count_and_sums, drill_across, impact_by, stored_sums
from emberfold.queries.base import amount, from_cents, query, sql_money, table
from emberfold.storage import scratch_path


def _customer_places(spark, sf_dir):
    return table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        "c_custkey", F.col("r_name").alias("region"), F.col("n_name").alias("nation"))


_REGIONS_SQL = f"""
    SELECT r_name AS region, CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(*) AS events,
           {sql_money('o_totalprice')} AS total
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey
    GROUP BY ROLLUP (r_name, CAST(year(o_orderdate) AS INTEGER))"""


@query("r1_region_rollup", _REGIONS_SQL)
def r1_region_rollup(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    return from_cents(impact_by(
        orders, "o_custkey", _customer_places(spark, sf_dir), "c_custkey", ["region"], ["year"],
        {"total": amount("o_totalprice")}, rollup=True), "total")


@query("r1_rollup_merge", _REGIONS_SQL)
def r1_rollup_merge(spark, sf_dir):
    """From sums by month that three batches added to, the second of them twice."""
    path = scratch_path(spark, "sums")
    orders = table(spark, sf_dir, "orders").withColumns({
        "month": F.date_format("o_orderdate", "yyyy-MM"), "batch": F.pmod("o_orderkey", F.lit(3))})
    places, measures = _customer_places(spark, sf_dir), {"total": amount("o_totalprice")}
    for batch_id in (0, 1, 1, 2):
        sums = impact_by(orders.where(F.col("batch") == batch_id), "o_custkey", places, "c_custkey", ["region"],
                         ["month"], measures)
        append_sums(path, "month", batch_id, sums, ["events", "total"])
    stored = stored_sums(spark, path, "month", sums.schema)
    return from_cents(stored.withColumn("year", F.substring("month", 1, 4).cast("int")).rollup("region", "year").agg(
        F.sum("events").alias("events"), F.sum("total").alias("total")), "total")


@query("r2_cause_rollup", f"""
    SELECT p_type AS cause, l_returnflag, COUNT(*) AS events,
           {sql_money('l_quantity')} AS quantity, {sql_money('l_extendedprice')} AS price
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type, l_returnflag""")
def r2_cause_rollup(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("cause"))
    return from_cents(impact_by(
        table(spark, sf_dir, "lineitem"), "l_partkey", parts, "p_partkey", ["cause"],
        ["l_returnflag"],
        {"quantity": amount("l_quantity"), "price": amount("l_extendedprice")}),
        "quantity", "price")


# Shipments rename the odd nations and customers every third: no row is cut, and the join
# has gaps on all sides.
@query("r3_drill_across", """
    WITH o AS (SELECT n_name AS nation, COUNT(*) AS orders FROM orders
               JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
               GROUP BY 1),
         l AS (SELECT CASE WHEN n_nationkey % 2 = 1 THEN 'S-' || n_name ELSE n_name END AS nation,
                      COUNT(*) AS shipments FROM lineitem
               JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
               GROUP BY 1),
         c AS (SELECT CASE WHEN n_nationkey % 3 = 0 THEN 'C-' || n_name ELSE n_name END AS nation,
                      COUNT(*) AS customers FROM customer
               JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)
    SELECT nation, COALESCE(orders, 0) AS orders, COALESCE(shipments, 0) AS shipments,
           COALESCE(customers, 0) AS customers
    FROM o FULL JOIN l USING (nation) FULL JOIN c USING (nation)""")
def r3_drill_across(spark, sf_dir):
    k, name = F.col("n_nationkey"), F.col("n_name")
    named = lambda column: table(spark, sf_dir, "nation").select(
        "n_nationkey", column.alias("nation"))
    shipped = F.when(k % 2 == 1, F.concat(F.lit("S-"), name)).otherwise(name)
    bought = F.when(k % 3 == 0, F.concat(F.lit("C-"), name)).otherwise(name)
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    orders = impact_by(
        table(spark, sf_dir, "orders"), "o_custkey", customer.join(
            named(name), F.col("c_nationkey") == k), "c_custkey", ["nation"], [], {}, "orders")
    shipments = impact_by(
        table(spark, sf_dir, "lineitem"), "l_suppkey", supplier.join(
            named(shipped), F.col("s_nationkey") == k), "s_suppkey", ["nation"], [], {}, "shipments")
    customers = count_and_sums(
        customer.join(named(bought), F.col("c_nationkey") == k), ["nation"], {}, "customers")
    return drill_across(
        [(orders, "orders"), (shipments, "shipments"), (customers, "customers")], "nation")
