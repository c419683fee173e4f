"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberfold.storage import materialize


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node that has a link; the root is the smallest node reachable.

    Each round hands every node the smallest label among its neighbours and then
    its label's own label, until no label changes; labels only get smaller, so the
    exact sum of all labels tells. Every round is a stored table. NULL ends and
    links to oneself are ignored; no links give no rows.
    """
    ends = links.select(F.col(a).cast("bigint").alias("x"), F.col(b).cast("bigint").alias("y"))
    ends = ends.where(F.col("x") != F.col("y")).distinct()
    both = materialize(ends.unionByName(ends.select(F.col("y").alias("x"), F.col("x").alias("y"))),
                       "links")
    labels = materialize(both.groupBy(F.col("x").alias("node")).agg(
        F.least(F.col("x"), F.min("y")).alias("root")), "labels")
    total = F.sum(F.col("root").cast("decimal(38,0)"))
    before = labels.agg(total).first()[0]
    while before is not None:
        heard = both.join(labels, both["y"] == labels["node"]).select(
            F.col("x").alias("node"), "root")
        lower = labels.unionByName(heard).groupBy("node").agg(F.min("root").alias("root"))
        lower = materialize(lower, "labels")
        jump = lower.select(F.col("node").alias("root"), F.col("root").alias("next"))
        labels = materialize(lower.join(jump, "root").select("node", F.col("next").alias("root")),
                             "labels")
        now = labels.agg(total).first()[0]
        if now == before:
            break
        before = now
    return labels
