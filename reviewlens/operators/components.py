"""Connected components of an edge table by large-star / small-star contraction.

Edges point from the larger to the smaller node. A large star hands every larger
neighbour of a node on to the smallest node around it; a small star hands the
smaller neighbours on to the smallest of them. Edges inside a component that say
nothing new fall together in these steps and are dropped, until every component
is a star around its smallest node.

A node's smallest neighbour is an aggregate, which is combined before it is
shuffled. Only taking it back to the edges could send a hub's edges to one task:
nodes with more than a quarter of a task's share of edges are few, at most eight
for every shuffle partition, and are looked up from a broadcast table instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.session import store

FEW_EDGES = 100_000  # so many may meet in one task


def hubs(stats: DataFrame, edges: int) -> list[tuple]:
    """(node, low) of the nodes with more than a quarter of a task's share of ``edges``."""
    if edges <= FEW_EDGES:
        return []
    parts = int(stats.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    often = max(1, edges // (4 * parts))
    return [tuple(r) for r in stats.filter(F.col("n") > often).select("node", "low").collect()]


def with_low(edges: DataFrame, side: str, stats: DataFrame, hot: list[tuple]) -> DataFrame:
    """Edges with ``low`` of the node in column ``side``."""
    named = stats.select(F.col("node").alias(side), "low")
    if not hot:
        return edges.join(named, side)
    few = edges.sparkSession.createDataFrame(hot, named.schema)
    beside = edges.join(F.broadcast(few.withColumnRenamed("low", "_hot")), side, "left")
    common = beside.filter("_hot IS NULL").drop("_hot").join(named, side)
    return beside.filter("_hot IS NOT NULL").withColumnRenamed("_hot", "low").unionByName(common)


def _kept(stats: DataFrame, edges: int) -> DataFrame:
    """Stored if it is read more than once, that is, if hubs are looked for."""
    return stats if edges <= FEW_EDGES else store(stats, "stars")


def _large_star(edges: DataFrame, size: int) -> DataFrame:
    both = edges.select(F.col("hi").alias("node"), F.col("lo").alias("other")).unionByName(
        edges.select(F.col("lo").alias("node"), F.col("hi").alias("other"))
    )
    stats = both.groupBy("node").agg(F.min("other").alias("low"), F.count(F.lit(1)).alias("n"))
    stats = _kept(stats, size).withColumn("low", F.least("low", "node"))
    return with_low(edges, "lo", stats, hubs(stats, size)).select("hi", F.col("low").alias("lo")).distinct()


def _small_star(edges: DataFrame, size: int) -> DataFrame:
    stats = edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("low"), F.count(F.lit(1)).alias("n"))
    stats = _kept(stats, size)
    handed = with_low(edges, "hi", stats.filter("n > 1"), hubs(stats, size)).filter("lo <> low")
    return handed.select(F.col("lo").alias("hi"), F.col("low").alias("lo")).unionByName(
        stats.select(F.col("node").alias("hi"), F.col("low").alias("lo"))
    ).distinct()


def _print_of(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def stars(edges: DataFrame) -> DataFrame:
    """(hi, lo), stored: every node that has an edge and is not the smallest of
    its component, with the smallest one."""
    edges = store(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo")).distinct(), "edges"
    )
    seen = _print_of(edges)
    while seen[0]:
        large = store(_large_star(edges, seen[0]), "edges")
        edges = store(_small_star(large, seen[0]), "edges")
        before, seen = seen, _print_of(edges)
        if before == seen:
            break
    return edges


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node id of the component.

    ``nodes``: node. ``edges``: u, v, in any direction, repeated or not.
    """
    roots = stars(edges).select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return nodes.select("node").distinct().join(roots, "node", "left").select(
        "node", F.coalesce("root", "node").alias("root")
    )
