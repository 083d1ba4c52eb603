"""Connected components of a link table, by alternating stars.

Each round links every node's larger neighbours, then its smaller ones, to the least node of
the neighbourhood. Neighbourhoods are only ever summed up (a minimum with partial sums) and
joined back, never gathered; the number of rounds grows with the logarithm of the longest chain.
Tables of a round are written to shared storage, so that lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantpanel.functions.storage import materialise


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node that has a link; component is its least node.

    ``links`` has two columns of node ids (long, not null); direction, repeats and links of a
    node to itself don't matter.
    """
    a, b = links.columns
    edges = materialise(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    )
    nodes = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    signature = None
    while True:
        edges = materialise(_small_star(_large_star(edges)))
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.count_if(F.col("u") < F.col("v"))
        ).first()
        if now == signature:
            break
        signature = now
    return nodes.join(edges.withColumnRenamed("u", "node"), "node", "left").select(
        "node", F.coalesce("v", "node").alias("component")
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node gets a link to the least of its neighbourhood."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, gets a link to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
