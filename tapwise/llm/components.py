"""Connected components of a table of links, by rounds of joins."""

from pyspark.sql import DataFrame, functions as F

from tapwise.sources.folders import written_once


def connected_components(links: DataFrame) -> DataFrame:
    """Table (node, label) of every node in `links` (a, b); the label is the smallest node that links reach.

    Each round gives a node the smallest label among its neighbours and itself, then the label of that label.
    Minima are combined before the shuffle, so a node with very many links costs one row per task; AQE splits the
    partition of such a node in the join. Every round is written to the shared folder, which cuts the lineage.
    """
    both = written_once(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = written_once(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_low"))
        .select("node", F.least("node", "_low").alias("label")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("_near"))
        )
        lower = labels.join(near, "node").select("node", "label", F.least("label", "_near").alias("_new"))
        lower = written_once(lower, "labels")
        jump = lower.select(F.col("node").alias("_new"), F.col("_new").alias("_far"))
        after = written_once(
            lower.join(jump, "_new", "left")
            .select("node", "label", F.least("_new", F.coalesce("_far", "_new")).alias("_label")), "labels")
        changed = after.filter(F.col("_label") != F.col("label")).limit(1).count()
        labels = after.select("node", F.col("_label").alias("label"))
        if not changed:
            return labels
