"""Connected components of a link table by hooking, pointer jumping and contraction.

Every round hooks each node to its smallest neighbour if that is smaller, shortens the chains of hooks to their ends, and
replaces links by links between ends; the table of links shrinks until none is left. All steps are joins and
aggregates that combine before they shuffle, so a node with very many links is no group of its own. Rounds
are written to the shared folder; nothing but counts comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)``; root is the smallest node. Nulls and loops are no links."""
    edges = stored(links.where("a is not null and b is not null and a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    found = None
    while not edges.isEmpty():
        hooks = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up"))
        tops = edges.select(F.col("a").alias("node")).distinct().join(hooks, "node", "left_anti")
        hooks = stored(hooks.unionByName(tops.withColumn("up", F.col("node"))), "hooks")
        while True:  # pointer jumping: chains halve
            ends = hooks.select(F.col("node").alias("up"), F.col("up").alias("further"))
            jumped = stored(hooks.join(ends, "up").select("node", F.col("further").alias("up"), (F.col("further") != F.col("up")).alias("moved")), "hooks")
            hooks = jumped.select("node", "up")
            if jumped.where("moved").isEmpty():
                break
        up = hooks.select(F.col("node").alias("root"), "up")
        if found is None:
            found = hooks.withColumnRenamed("up", "root")
        else:
            found = stored(found.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root")), "roots")
        edges = edges.join(hooks.withColumnsRenamed({"node": "a", "up": "ra"}), "a").join(
            hooks.withColumnsRenamed({"node": "b", "up": "rb"}), "b").where("ra <> rb")
        edges = stored(edges.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")) if found is None else found
