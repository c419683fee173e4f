"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   tables to read (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names, or "all"
BENCH_RUNS     timed runs per query after one warm-up run (default 3)

Every run builds the plan anew and computes every row and column of the result.
"shuffle_mb" is what one run of a query writes to shuffles, from the event log
(jobs that a stream starts on its own thread are not in it).
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from pathlib import Path

from emberfold.queries import QUERIES
from emberfold.session import build_session

HEADLINE = [
    "r1_region_rollup", "r2_cause_rollup", "r3_drill_across", "a1_csv_roundtrip", "b1_filters",
    "d1_override", "d2_lookup_fill", "d2_table_fill", "d3_composite_fill", "d5_bbox_label",
    "d5_bbox_rangejoin", "d6_group_mode", "d7_decode", "d12_weather_normalize", "k3_dedup",
    "g1_dim_date", "g5_fact_build", "q1_constraints", "q2_fk_validate", "q3_orphans",
    "f1_fire_codes", "s4_dual_sink", "s8_stream_window", "s9_fwi_carry", "m1_regression",
    "m3_regression_metrics", "silver_earthquake", "silver_tsunami", "silver_landslide",
    "silver_volcano", "gold_checks", "gold_drill_across",
]


def timed(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def shuffle_megabytes(log_dir: str, runs: int) -> dict[str, float]:
    """Bytes written to shuffles per job group, for one of its runs."""
    owner, written = {}, {}
    for log in Path(log_dir).iterdir():
        for line in log.open():
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                group = event.get("Properties", {}).get("spark.jobGroup.id")
                owner.update({stage: group for stage in event["Stage IDs"]})
            elif event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                group = owner.get(event["Stage ID"])
                size = event["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"]
                written[group] = written.get(group, 0) + size
    return {g: round(size / runs / 1e6, 3) for g, size in written.items() if g}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    log_dir = tempfile.mkdtemp(prefix="emberfold-bench-")
    spark = build_session(f"local[{cpus}]", cpus, **{
        "spark.driver.memory": "12g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="emberfold-"),
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": f"file://{log_dir}", "spark.eventLog.rolling.enabled": "false",
        "spark.eventLog.compress": "false"})
    spark.sparkContext.setLogLevel("ERROR")

    cold, warm = {}, {}
    for name in names:
        spark.sparkContext.setJobGroup(name + ":cold", name)
        cold[name] = round(timed(QUERIES[name], spark, sf_dir), 3)
        spark.sparkContext.setJobGroup(name, name)
        warm[name] = round(statistics.median(
            timed(QUERIES[name], spark, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    shuffled = shuffle_megabytes(log_dir, runs)
    print(json.dumps({
        "metric": "sum of median warm seconds over the headline queries",
        "value": round(sum(warm.values()), 3), "unit": "sec", "queries": warm,
        "cold": cold, "shuffle_mb": {n: shuffled.get(n, 0.0) for n in names},
        "runs": runs, "cpus": cpus, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
