"""Connected components of links, by smallest label with jumps; every round is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logtrail.session import write_stage


def write_small(df: DataFrame, name: str) -> DataFrame:
    """Write a table of narrow rows; the adaptive planner sizes its files by the data."""
    return write_stage(df, name)


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest reachable node) of each node of the links (a, b).

    A round gives each node the smallest label around it, then the label of
    that label, so long chains shrink fast. Only counts reach the driver.
    """
    both = write_small(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels = write_small(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
        .select("node", F.least("node", "near").alias("component")), "labels",
    )
    while True:
        around = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("near"))
        nearer = labels.join(around, F.col("node") == F.col("a"), "left").select(
            "node", F.col("component").alias("before"), F.least("component", F.coalesce("near", "component")).alias("label")
        )
        heads = labels.select(F.col("node").alias("head"), F.col("component").alias("beyond"))
        moved = nearer.join(heads, F.col("label") == F.col("head"), "left").select(
            "node", "before", F.least("label", F.coalesce("beyond", "label")).alias("component")
        )
        labels = write_small(moved, "labels")
        if labels.where("component <> before").limit(1).count() == 0:
            return labels.select("node", "component")
