"""Connected components of links between integers, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmeter.llm.common import discard, kept_on_disk


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them; edges come as u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (u, v), the component being its smallest node.

    Each round writes the edges to the shared folder, so lineage stays short and
    lost executors cost a read; the tables of earlier rounds are deleted. Groups
    are reduced to minima before the shuffle, no neighbourhood is collected.
    """
    spark = links.sparkSession
    ordered = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, path = kept_on_disk(ordered, "edges")
    seen = None
    for _ in range(most_rounds):
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen, old = state, path
        edges, path = kept_on_disk(_small_star(_large_star(edges)).distinct(), "edges")
        discard(spark, old)
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
