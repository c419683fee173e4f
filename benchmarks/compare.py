"""Time four operators against the step-by-step way of writing the same thing.

    python benchmarks/compare.py /root/testdata/sf0.1
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from emberfold.operators.dimensional import dim_date  # noqa: E402
from emberfold.operators.quality import Check, run_checks  # noqa: E402
from emberfold.operators.repair import fill_from_lookup, impute_group_mode  # noqa: E402
from emberfold.plans.cleaning import ERUPTION_DATES  # noqa: E402
from emberfold.queries import feeds  # noqa: E402
from emberfold.session import build_session  # noqa: E402
from emberfold.storage import materialize  # noqa: E402


def seconds(build, runs: int = 3) -> float:
    best = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        best.append(time.perf_counter() - start)
    return sorted(best[1:])[runs // 2]


def main(sf_dir: str) -> None:
    spark = build_session("local[8]", 8, **{"spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")

    eruptions = materialize(feeds.volcanoes(spark, sf_dir).select(
        F.col("Volcano Name").alias("volcano_name"), F.col("Year").cast("int").alias("year"),
        F.col("Country").alias("country"), F.col("Month").cast("int").alias("month"),
        F.col("Day").cast("int").alias("day")), "eruptions")

    def rewrite_by_rewrite():
        df = eruptions
        for name, year, country, month, day in ERUPTION_DATES.unique_rows():
            same = ((F.col("volcano_name") == name) & (F.col("year") == year)
                    & (F.col("country") == country))
            for c, value in (("month", month), ("day", day)):
                df = df.withColumn(c, F.when(same & F.col(c).isNull(), value).otherwise(F.col(c)))
        return df

    holes = materialize(spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        (F.col("o_custkey") % 25).alias("g"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("v")), "holes")

    def group_by_group():
        df = holes
        for (g,) in holes.where("v IS NULL").select("g").distinct().collect():
            top = holes.where(F.col("g") == g).groupBy("v").count().orderBy(F.desc("count")).first()
            df = df.withColumn("v", F.when((F.col("g") == g) & F.col("v").isNull(),
                                           top["v"] or "unknown").otherwise(F.col("v")))
        return df

    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    columns = lines.columns

    def constraint_by_constraint():
        for c in columns:
            run_checks([(lines, Check(c).is_complete(c))]).collect()
        return spark.range(1)

    def one_task_dates():
        days = spark.sql("SELECT explode(sequence(to_date('0037-01-01'), to_date('2023-12-31'), "
                         "interval 1 day)) AS full_date")
        return days.select("full_date", *[f("full_date").alias(n) for n, f in (
            ("year", F.year), ("month", F.month), ("day", F.dayofmonth),
            ("quarter", F.quarter), ("weekday", F.weekday), ("doy", F.dayofyear))])

    pairs = {
        "fill by three-part key, 161 entries": (
            rewrite_by_rewrite, lambda: fill_from_lookup(
                eruptions, ERUPTION_DATES, ["volcano_name", "year", "country"], ["month", "day"])),
        "most frequent value per group, 25 groups": (
            group_by_group, lambda: impute_group_mode(holes, "g", ["v"])),
        "11 completeness constraints": (
            constraint_by_constraint,
            lambda: run_checks([(lines, Check("lines").is_complete(*columns))])),
        "date dimension, 725,736 days": (one_task_dates, lambda: dim_date(spark)),
    }
    for name, (before, after) in pairs.items():
        b, a = seconds(before), seconds(after)
        print(f"| {name} | {b:.2f} | {a:.2f} | {b / a:.1f}x |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
