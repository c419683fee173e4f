"""Session settings shared by tests, the benchmark and command-line use."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """Session with a fixed time zone, ANSI mode and adaptive execution.

    On a cluster leave ``shuffle_partitions`` unset: adaptive execution then
    coalesces from ``initialPartitionNum`` down to the advisory partition size.
    """
    builder = (
        SparkSession.builder.master(master).appName("emberfold")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # call-site capture makes every column expression several times dearer to build
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
