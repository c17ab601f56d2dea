"""Connected components by contraction, for graphs of any size and shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import cut, release


def stars(members: DataFrame, group: list[str], node: str = "id") -> DataFrame:
    """u, v: an edge from every node of a group to its least node. ``members``: group columns and node. No pairs within a group."""
    hub = members.groupBy(*group).agg(F.min(node).alias("v"))
    return members.join(hub, group).where(F.col(node) != F.col("v")).select(F.col(node).alias("u"), "v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, label: the least node of its component, for every node that has an edge. ``edges``: u, v.

    Edges are contracted until none is left, however many rounds that takes. In a round each node hooks onto the one of
    least hash within two steps, and on to where that one hooks; hashes only fall, so no circle arises, a star ends in
    one round and chains shrink by a constant share. Minima combine on the map side and joins are plain, so a node with
    very many edges gathers nowhere. Writes the hooks and the edges of each round.
    """
    edges = cut(edges.where(F.col("u") != F.col("v")).select("u", "v").distinct(), "edges")
    label = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct().withColumn("label", F.col("node"))
    label = cut(label, "labels")
    rounds = 0
    while edges.limit(1).count():
        salt = F.lit(rounds)
        rounds += 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        mark = lambda c: F.struct(F.xxhash64(c, salt).alias("h"), F.col(c).alias("to"))
        near = both.groupBy("u").agg(F.min(mark("v")).alias("m")).select("u", F.least(mark("u"), "m").alias("m"))
        hook = cut(both.join(near, "u").groupBy("v").agg(F.min("m").getField("to").alias("to")).withColumnRenamed("v", "u"), "hooks")
        to = hook.join(hook.select(F.col("u").alias("to"), F.col("to").alias("next")), "to").select("u", F.col("next").alias("to"))
        left = edges.join(to.withColumnRenamed("to", "a"), "u").join(to.select(F.col("u").alias("v"), F.col("to").alias("b")), "v").where(F.col("a") != F.col("b"))
        new = cut(left.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "edges")
        moved = cut(label.join(to.select(F.col("u").alias("label"), "to"), "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels")
        for old in (edges, hook, label):
            release(old)
        edges, label = new, moved
    release(edges)
    least = label.groupBy("label").agg(F.min("node").alias("least"))
    return label.join(least, "label").select("node", F.col("least").alias("label"))
