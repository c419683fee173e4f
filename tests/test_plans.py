"""Plans: what must and must not be in them."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", ["d1_override", "d2_lookup_fill", "d3_composite_fill",
                                  "d5_bbox_rangejoin", "silver_earthquake", "silver_tsunami"])
def test_lookups_move_no_rows(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir)).split("== Physical Plan ==")[-1]
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_scan_reads_needed_columns_only(spark, sf_dir):
    text = plan(entry.queries()["r2_cause_rollup"](spark, sf_dir))
    assert ("ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_extendedprice:double,"
            "l_returnflag:string>") in text


def test_rollup_follows_the_size_of_the_dimension(spark, sf_dir):
    from emberfold.operators.rollups import impact_by
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    ask = lambda most: impact_by(orders, "o_custkey", customer, "c_custkey",
                                 ["c_mktsegment"], [], {"total": F.col("o_orderkey")}, max_broadcast_rows=most)
    small, large = ask(1_000_000), ask(0)
    assert plan(small).split("== Physical Plan ==")[-1].count("Exchange hashpartitioning") == 1
    # one aggregate below the join, one above
    assert plan(large).split("== Physical Plan ==")[-1].count("HashAggregate") >= 4
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))


def test_foreign_keys_scan_the_fact_once(spark):
    from emberfold.operators.quality import ForeignKey, foreign_key_flags
    fact = spark.range(3000).selectExpr(
        "id", "if(id % 3 = 0, 7, id % 50) AS a", "concat('k', id % 40) AS b", "id % 30 AS c",
        "cast(null as bigint) AS d")
    folder = spark.conf.get("spark.checkpoint.dir") + "/fact-scans"
    fact.write.mode("overwrite").parquet(folder)
    stored = spark.read.parquet(folder)
    number = spark.range(25).withColumnRenamed("id", "k")
    text = number.selectExpr("concat('k', k) AS k")
    flags = {f"f{n}": ForeignKey(c, text if c == "b" else number, "k")
             for n, c in enumerate(["a", "b", "c", "d", "a", "c"])}
    small, large = (foreign_key_flags(stored, flags, most) for most in (1_000_000, 0))
    physical = plan(large).split("== Physical Plan ==")[-1]
    assert physical.count("fact-scans") == 1
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    got = {r["id"]: r for r in large.collect()}
    assert len(got) == 3000 and all(
        (r["f0"], r["f1"], r["f2"], r["f3"]) == (r["a"] < 25, int(r["b"][1:]) < 25, r["c"] < 25, 0)
        for r in got.values())


def test_filters_reach_the_scan(spark, sf_dir):
    from emberfold.operators.rollups import count_and_sums
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where(F.col("l_quantity") > 30)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,30.0)]" in plan(
        count_and_sums(lines, ["l_returnflag"], {}, "n"))


@pytest.mark.parametrize("name", ["tsunami", "landslide"])
def test_generated_methods_are_short_enough_to_compile(spark, monkeypatch, capsys, name):
    """The JVM leaves methods of more than 8,000 bytes uncompiled."""
    import re

    from emberfold.plans import cleaning

    columns = {"tsunami": list(cleaning.TSUNAMI_COLUMNS), "landslide": cleaning.LANDSLIDE_COLUMNS}[name]
    raw = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))
    sizes = []

    def measured(df, *_):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            df.explain("codegen")
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        sizes.extend(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out))
        return df

    monkeypatch.setattr(cleaning, "materialize", measured)
    measured({"tsunami": cleaning.clean_tsunamis, "landslide": cleaning.clean_landslides}[name](raw))
    assert sizes and max(sizes) <= 8_000
