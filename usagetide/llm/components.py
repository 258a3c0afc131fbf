"""Connected components by alternating star contractions; every step is a join, nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from . import frames


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction: neighbours of a node are linked to its smallest neighbour (or itself)."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    both = frames.materialize(both.distinct())
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    met = frames.hot_join(both, least, ["a"], ["b"], "inner")
    if large:
        out = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return frames.materialize(out.where("a > b").distinct())


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) for every node of ``edges`` (a, b).

    Loops and repeated edges are ignored. Contractions end when every node points at the root of its star.
    """
    now = frames.materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    before = mark(now)
    for _ in range(rounds):
        if not before[0]:
            break
        now = _stars(_stars(now, True), False)
        after = mark(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
