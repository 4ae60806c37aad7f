"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathwarden.session import cut_lineage, discard


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang each node's larger neighbours on the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a < b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang each node and its smaller neighbours on the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    others = edges.join(least, "b").select(F.col("m").alias("a"), F.col("a").alias("b")).where("a < b")
    return others.unionByName(least.select(F.col("m").alias("a"), "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for the nodes of edges (a, b): the component is its smallest node.

    Each round is two groupings and two joins over at most as many edges as before, and the longest path of a component
    shrinks by a constant factor, so rounds grow with the logarithm of the nodes. Nulls and loops are no edges.
    """
    pairs = edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    state, before = cut_lineage(pairs), None
    while True:
        now = state.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if now == before or now["n"] == 0:
            break
        before, old = now, state
        state = cut_lineage(_small_star(_large_star(old)))
        discard(old)
    roots = state.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()
    return state.select(F.col("b").alias("id"), F.col("a").alias("component")).unionByName(roots)
