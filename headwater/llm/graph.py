"""Connected components of very large graphs, in rounds of stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwater.session import cut_at, delete_path, work_path


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select("b", "a"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the least node around it."""
    around = _both_ways(edges)
    least = around.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return around.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them. Edges lead from the larger node."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node with an edge; the component is its least node.

    ``edges`` has two columns of numbers. Each round is stored in the shared folder, and the one before is deleted.
    The least neighbour is aggregated before the shuffle, and the join to a node's
    edges is a plain one, whose large partitions Spark splits, so a node may have
    very many edges. The number of rounds grows with the logarithm of the nodes.
    """
    a, b = edges.columns
    named = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a > b").distinct()
    mark = [F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")]
    spark = edges.sparkSession
    path = work_path(spark, "stars")
    stars, before = cut_at(named, path), None
    while True:
        now = stars.agg(*mark).first()
        if now == before:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                stars.select("b", "b").distinct()
            )
        last, path = path, work_path(spark, "stars")
        stars, before = cut_at(_small_star(_large_star(stars)), path), now
        delete_path(spark, last)
