"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import staged

ROUNDS = 60  # far above the logarithmic number that occurs; passing it is an error, not a cut


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Labels the nodes of undirected edges ``a``, ``b`` (bigint): node, root (the smallest node reachable).

    Every step hangs nodes under smaller ones and is written to the shared folder, so lineage stays short.
    A star's minimum is combined map-side and joined back to its edges by key; no node's neighbours are
    gathered. Stops when a round changes nothing.
    """
    b_first = F.col("a") > F.col("b")
    current = staged(
        edges.filter("a <> b")
        .select(F.when(b_first, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(b_first, F.col("b")).otherwise(F.col("a")).alias("b"))
        .distinct(),
        "edges",
    )  # a > b
    before = _state(current)
    for _ in range(ROUNDS):
        if before[0] == 0:
            break
        # Large star: every larger neighbour of a node goes to the smallest of its neighbourhood.
        both = current.select("a", "b").union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (
            both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        large = staged(large.filter("a <> b").distinct(), "large")
        # Small star: a node and its smaller neighbours go to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        current = staged(small, "small")
        after = _state(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(current.select("b", "b").distinct().toDF("node", "root"))
