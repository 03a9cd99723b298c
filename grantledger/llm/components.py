"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantledger.session import settle


def components(links: DataFrame) -> DataFrame:
    """`node`, `component` (the least node reachable) for all ends of the links (`a`, `b`), which are longs.

    In each round every component hooks itself to the least one that a link of
    any of its nodes leads to, and chains of hooks are halved until they are
    flat; the number of rounds follows the logarithm of the longest path.
    """
    edges = settle(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = settle(edges.select(F.col("a").alias("node")).distinct().withColumn("component", F.col("node")), "labels")
    while True:
        of_a = labels.select(F.col("node").alias("a"), F.col("component").alias("from"))
        of_b = labels.select(F.col("node").alias("b"), F.col("component").alias("to"))
        across = edges.join(of_a, "a").join(of_b, "b").where(F.col("from") > F.col("to"))
        hooks = settle(across.groupBy("from").agg(F.min("to").alias("to")), "hooks")
        if hooks.isEmpty():
            return labels
        while True:  # hooks lead to smaller numbers, so they form no circle
            further = hooks.select(F.col("from").alias("to"), F.col("to").alias("beyond"))
            longer = hooks.join(further, "to", "left")
            if longer.where("beyond is not null").isEmpty():
                break
            hooks = settle(longer.select("from", F.coalesce("beyond", "to").alias("to")), "hooks")
        moved = labels.join(hooks, labels["component"] == hooks["from"], "left")
        labels = settle(moved.select("node", F.coalesce("to", "component").alias("component")), "labels")
