"""Connected components of a large graph by label passing, with hooking of whole labels.

Rows of a key that many rows share (labels, parents) are dealt to shares by their count: edges are only those between texts that are near each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrative_spark.llm.common import join_hot, materialize


def roots(parents: DataFrame) -> DataFrame:
    """node, root for rows of node, parent, where a parent is less than its node and a node has one at most; roots have no row.

    Every round takes the parent's parent, so that rounds go with the logarithm of the depth.
    """
    now = materialize(parents.select("node", "parent"), "roots")
    total = now.count()
    while True:
        above = now.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        step = join_hot(now.select("node", "parent"), above, "parent", F.col("node"), total)
        now = materialize(step.select("node", F.coalesce("above", "parent").alias("parent"), F.col("above").isNotNull().alias("moved")), "roots")
        if not now.where("moved").limit(1).count():
            return now.select("node", F.col("parent").alias("root"))


def components(edges: DataFrame) -> DataFrame:
    """node, label (the least node of its component) for every node of edges (a, b).

    Each round takes the least label among a node's neighbours, then the least that any node of the same old label found; so
    whole trees move at once. Every round is written to the shared folder.
    """
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label"))
    labels = materialize(labels, "labels")
    total = labels.count()
    while total:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = materialize(labels.join(near, "node").select("node", "label", F.least("label", "near").alias("new")), "step")
        hook = step.groupBy("label").agg(F.min("new").alias("hook"))
        least = F.least("new", "hook")
        labels = materialize(join_hot(step, hook, "label", F.col("node"), total).select("node", least.alias("label"), (least < F.col("label")).alias("moved")), "labels")
        if not labels.where("moved").limit(1).count():
            return labels.drop("moved")
        labels = labels.drop("moved")
    return labels
