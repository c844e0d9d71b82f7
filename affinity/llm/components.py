"""Connected components of a graph given as an edge table, without collecting any of it.

Alternating large-star and small-star steps: each is one grouped minimum and one join, so a hub
is pre-aggregated before its shuffle and its join rows can be split by AQE. The number of rounds
grows with the logarithm of the longest path. Edges are staged in the shared folder every round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.shared import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest of its neighbourhood."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.join(low, "u")
        .where(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u <> v")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _state(edges: DataFrame):
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)``; the root is the smallest reachable node.

    Self-loops and repeated edges are allowed (a node with only a self-loop gets no row), null ends
    are ignored. An empty edge table gives an empty result.
    """
    edges = staged(
        edges.where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    before = _state(edges)
    for _ in range(max_rounds):
        if not before[0]:
            break
        edges = staged(_small_star(_large_star(edges)), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
