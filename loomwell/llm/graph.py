"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwell.llm.common import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for every node of an edge (``u``, ``v``).

    Each round takes the smallest label among the neighbours and then the label
    of that label, so the distance a label travels doubles; it ends when no label
    changes. Labels and edges stay tables; a round is cut by a checkpoint.
    """
    links = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    links = checkpointed(links.filter("u <> v"))
    labels = checkpointed(
        links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("v")).select("node", F.least("node", "v").alias("component"))
    )
    while True:
        offered = (
            links.join(labels.withColumnsRenamed({"node": "v"}), "v")
            .groupBy(F.col("u").alias("node"))
            .agg(F.min("component").alias("offered"))
        )
        lower = labels.join(offered, "node").select("node", "component", F.least("component", "offered").alias("lower"))
        roots = labels.select(F.col("node").alias("lower"), F.col("component").alias("root"))
        stepped = checkpointed(
            lower.join(roots, "lower").select("node", F.col("component").alias("was"), F.least("lower", "root").alias("component"))
        )
        labels = stepped.select("node", "component")
        if stepped.filter("was <> component").isEmpty():
            return labels
