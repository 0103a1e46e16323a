"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _to_least(pairs: DataFrame, keep) -> DataFrame:
    """Joins every node's neighbours ``b`` to the least node among ``a`` and its neighbours."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return pairs.join(least, "a").where(keep).select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_003), F.sum("b")).first())


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of ``edges`` (long columns a, b); root is the least node of its component.

    Each round halves the distance to the roots; the loop ends when the edges no
    longer change and raises if that takes more than ``rounds`` rounds.
    """
    now = materialise(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(now)
    for _ in range(rounds):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _to_least(both, F.col("b") > F.col("a"))
        ordered = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        now = materialise(_to_least(ordered, F.lit(True)), "edges")
        before, state = state, _state(now)
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
    raise RuntimeError(f"components did not settle in {rounds} rounds")
