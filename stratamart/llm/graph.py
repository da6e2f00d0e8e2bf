"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.staging import release, stage


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return tuple(row)


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has a link; component is the smallest node reachable.

    Alternates two steps until nothing changes: hang every larger neighbour of a node below the
    node's smallest neighbour, then hang the smaller ones there too. The number of rounds grows
    with the logarithm of the longest path. A node with many links is combined before the shuffle
    and its rows can be split in the join. Null nodes and links of a node to itself are ignored.
    """
    pairs = links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    edges = stage(pairs.distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select("v", "u").toDF("u", "v"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        # Rows of both directions whose far end is larger: the edges read from their smaller end.
        large = edges.join(least, F.col("v") == F.col("k")).select("u", F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        joined = large.join(down, F.col("u") == F.col("k"))
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(down.select(F.col("k").alias("u"), F.col("m").alias("v")))
        old, edges = edges, stage(small.distinct(), "links")
        release(old)
        new = _state(edges)
        if new == state:
            break
        state = new
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
