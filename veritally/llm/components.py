"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.session import release, store_table


def connected_components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """Rows (node, component) for all nodes of ``links``; a component is its least node.

    Every node points to the least node seen among its neighbours' pointers, then pointers
    are halved by following them once, so chains close in logarithmically many
    rounds. Each round is stored: a lost executor costs that round at most, and the driver drops
    what the rounds before have left. Null nodes are left
    out, loops and repeated links do no harm, and no links give no rows.
    """
    both = links.select(F.col(left).alias("node"), F.col(right).alias("other"))
    both = both.where("node IS NOT NULL AND other IS NOT NULL")
    edges = store_table(
        both.unionByName(both.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct(),
        "links",
    )
    labels = store_table(
        edges.groupBy("node").agg(F.least("node", F.min("other")).alias("component")), "labels"
    )
    while True:
        pointers = labels.withColumnsRenamed({"node": "other", "component": "theirs"})
        near = edges.join(pointers, "other").groupBy("node").agg(F.min("theirs").alias("theirs"))
        best = labels.join(near, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "theirs").alias("other")
        )
        halved = best.join(pointers, "other").select(
            "node", F.least("other", "theirs").alias("component"), "old"
        )
        moved = store_table(halved, "labels")
        release(links.sparkSession)
        if moved.where("component <> old").isEmpty():
            return moved.select("node", "component")
        labels = moved.select("node", "component")
