"""Connected components of a graph held as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackside.llm.common import checkpointed


EDGES_PER_PARTITION, LEAST_PARTITIONS = 250_000, 6


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node reachable.

    Large-star and small-star steps in turn: first every larger neighbour of a node is
    hung on the smallest one, then every smaller one.  Edges never grow in number and a
    few rounds flatten each component to a star.  A hub is pre-aggregated before it is
    shuffled, and its neighbours' side of the join can be split.  Each round is
    checkpointed, so the plan does not grow and a lost executor repeats one round."""
    now = checkpointed(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = _fingerprint(now)
    while True:
        # edges never grow in number: as many partitions as they need
        parts = max(LEAST_PARTITIONS, -(-mark[0] // EDGES_PER_PARTITION))
        now = now.coalesce(parts)
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(least.where("u <> m").select("u", F.col("m").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        now = checkpointed(small.coalesce(parts))
        last, mark = mark, _fingerprint(now)
        if last == mark:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())
