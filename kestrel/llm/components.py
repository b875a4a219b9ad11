"""Connected components of an edge table by alternating large-star and small-star rounds.

Each round is two aggregations and two joins of the edge table with one row per vertex; its result
is written to the shared checkpoint folder, so the plan does not grow and a lost executor costs one
round at most.  Labels meet in the smallest vertex of each component after O(log n) rounds.  Nothing
is collected but one count and one hash per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.session import materialize


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    # u is the larger end of each edge: link its smaller neighbours, and itself, to the smallest of them
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    linked = e.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): every vertex of ``edges`` (bigint columns a, b) with its component's smallest vertex.

    Self-loops, repeated edges and null ends are ignored; an empty table gives an empty result."""
    e = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .distinct(), "edges")
    state = _state(e)
    for _ in range(max_rounds):
        e = materialize(_small_star(_large_star(e)), "edges")
        state, before = _state(e), state
        if state == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
