"""Greedy groups over a similarity graph, as sweeps of place ranges.

Sweep the rows in order; a row that no earlier group took opens a group and takes its
similar rows. The rows that open groups (seeds) are the first maximal independent
set in that order. A block's rows are cut into ranges of the order, and each round sweeps one range of every
block, streaming its edges in order; only marks on later rows leave a range. The number of ranges is fixed
beforehand by the edges of the largest block, whatever the shape of the graph.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pathwarden.operators.rows import top_k
from pathwarden.session import cut_lineage, fix_layout

PairFinder = Callable[..., DataFrame]

#: The edges of a range, about: what one task sweeps in a round.
SWEEP_EDGES = 2_000_000


def _side(df: DataFrame, column: str, to: str = "id") -> DataFrame:
    return df.select("block", F.col(column).alias(to)).distinct()


def _join(left: DataFrame, right: DataFrame, column: str, how: str) -> DataFrame:
    return left.join(right.withColumnRenamed("id", column), ["block", column], how)


def _without(edges: DataFrame, nodes: DataFrame | None, *sides: str) -> DataFrame:
    """The edges none of whose sides is among the nodes (code, id)."""
    for side in sides if nodes is not None else ():
        edges = edges.join(nodes.select("code", F.col("id").alias(side)), ["code", side], "left_anti")
    return edges


def place_ranges(edges: DataFrame, place: str, others: dict[str, str], sweep_edges: int) -> tuple[DataFrame, int]:
    """Number the ranges of a block's places so that each has about `sweep_edges` edges; the table is stored by range.

    `edges` has `code`, the block. Adds `range`, that of `place`, and a number for each of `others` (name to column).
    """
    largest = edges.groupBy("code").count().agg(F.max("count")).first()[0] or 0
    number = max(1, math.ceil(largest / sweep_edges))
    if number == 1:
        return edges.withColumns({name: F.lit(0) for name in ("range", *others)}), 1
    shares = F.array(*[F.lit(k / number) for k in range(1, number)])
    cuts = edges.groupBy("code").agg(F.percentile_approx(place, shares, max(10_000, 100 * number)).alias("cuts"))
    numbered = lambda column: F.size(F.filter("cuts", lambda cut: cut < F.col(column)))
    tagged = edges.join(cuts, "code").withColumns({"range": numbered(place)} | {name: numbered(c) for name, c in others.items()})
    return cut_lineage(tagged.drop("cuts"), by="range"), number


def _sweep_covered(edges: DataFrame, place: str = "a") -> DataFrame:
    """The (code, id) that the seeds among the first sides cover, for edges (code, a, b) in the order of `place`, then a."""

    def sweep(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, covered = None, set()
        for part in parts:
            found = []
            for code, a, b in zip(part["code"].tolist(), part["a"].tolist(), part["b"].tolist(), strict=True):
                if code != of:
                    of, covered = code, set()
                if a not in covered and b not in covered:
                    covered.add(b)
                    found.append((code, b))
            yield pd.DataFrame(found, columns=["code", "id"])

    ordered = edges.repartition("code").sortWithinPartitions("code", place, "a", "b").select("code", "a", "b")
    return ordered.mapInPandas(sweep, "code string, id bigint")


def covered_nodes(edges: DataFrame, sweep_edges: int = SWEEP_EDGES) -> DataFrame:
    """The (block, id) that some seed covers, for edges (block, a, b) with a < b. Every other node is a seed.

    A range is swept once all ranges before it are: what they cover in it is known by then.
    """
    # A block may be a struct, which pandas cannot hash: its text stands for it.
    coded = cut_lineage(edges.select(F.to_json(F.struct("block")).alias("code"), "block", "a", "b").distinct())
    blocks = coded.select("code", "block").distinct()
    tagged, number = place_ranges(coded.drop("block"), "a", {"to": "b"}, sweep_edges)
    swept, reached = [], []
    for turn in range(number):
        own = tagged.where(F.col("range") == turn)
        before = _union(reached).where(F.col("to") == turn).select("code", "id").distinct() if reached else None
        inside = _sweep_covered(_without(own.where(F.col("to") == turn), before, "a", "b"))
        if number == 1:
            return inside.join(blocks, "code").select("block", "id")
        inside = cut_lineage(inside)
        swept.append(inside)
        leaving = own.where(F.col("to") > turn).select("code", "a", F.col("b").alias("id"), "to")
        leaving = _without(leaving, inside if before is None else inside.unionByName(before), "a")
        reached.append(cut_lineage(leaving.select("code", "id", "to").distinct()))
    found = _union([*swept, *[r.select("code", "id") for r in reached]]).distinct()
    return found.join(blocks, "code").select("block", "id")


def ordered_groups(edges: DataFrame, order: DataFrame, sweep_edges: int = SWEEP_EDGES) -> DataFrame:
    """Groups (block, seed, id) of a sweep in an order other than that of the ids.

    `order` has (block, id, place). Rows are visited by place; a row that no group holds opens one with the rows of a
    larger id that are similar to it and in no group yet. The ranges are those of the places of the rows that may open one.
    """
    coded = edges.select(F.to_json(F.struct("block")).alias("code"), "block", "a", "b").distinct()
    places = order.select(F.to_json(F.struct("block")).alias("code"), F.col("id").alias("a"), "place")
    coded = cut_lineage(coded.join(places, ["code", "a"]))
    blocks = coded.select("code", "block").distinct()
    tagged, number = place_ranges(coded.drop("block"), "place", {}, sweep_edges)

    def sweep(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, taken, free, opened = (None, None), set(), [], []

        def closed():
            """The group of the row whose edges have all been read."""
            code, seed = of
            if free and seed not in taken:
                taken.update((seed, *free))
                opened.extend((code, seed, x) for x in (seed, *free))
            free.clear()

        for part in parts:
            for code, a, b in zip(part["code"].tolist(), part["a"].tolist(), part["b"].tolist(), strict=True):
                if (code, a) != of:
                    closed()
                    if code != of[0]:
                        taken = set()
                    of = code, a
                if b not in taken:
                    free.append(b)
            if opened:
                yield pd.DataFrame(opened, columns=["code", "seed", "id"])
                opened.clear()
        closed()
        yield pd.DataFrame(opened, columns=["code", "seed", "id"])

    groups: list[DataFrame] = []
    for turn in range(number):
        taken = _union(groups).select("code", "id") if groups else None
        own = _without(tagged.where(F.col("range") == turn).select("code", "place", "a", "b"), taken, "a", "b")
        ordered = own.repartition("code").sortWithinPartitions("code", "place", "a", "b").select("code", "a", "b")
        found = ordered.mapInPandas(sweep, "code string, seed bigint, id bigint")
        groups.append(found if number == 1 else cut_lineage(found))
    return _union(groups).join(blocks, "code").select("block", "seed", "id")


def seed_members(
    nodes: DataFrame,
    find_pairs: PairFinder,
    all_neighbours: bool = False,
    head: int = 1_000,
    peel_above: int = 20_000,
    min_yield: float = 0.1,
) -> DataFrame:
    """Groups (block, seed, id) of two or more nodes, the seed being a member of its group.

    `find_pairs(left)` and `find_pairs(left, right)` give (block, a, b) with a < b. A node
    belongs to its smallest seed, or with `all_neighbours` to every seed it is similar to.

    A large cluster of similar rows has a quadratic number of pairs. So while many nodes
    remain, the first `head` of each block are decided among themselves (all that can
    precede them is among them), and what their seeds cover is taken out with one
    comparison per seed. Only when a round takes out little are all pairs listed.
    """
    remaining = fix_layout(nodes)
    left = remaining.count()
    parts: list[DataFrame] = []
    seeds: list[DataFrame] = []
    while left > peel_above:
        heads = fix_layout(top_k(remaining, ["block"], [F.col("id")], head))
        opening = fix_layout(heads.join(covered_nodes(find_pairs(heads)), ["block", "id"], "left_anti"))
        others = fix_layout(remaining.join(opening.select("block", "id"), ["block", "id"], "left_anti"))
        taken = fix_layout(find_pairs(opening, others).select("block", "a", "b"))
        # A pair's smaller node is the seed: every seed of this head precedes what it takes,
        # except a head node covered by a smaller seed and similar to a larger one.
        by_a = taken.join(opening.select("block", F.col("id").alias("a")), ["block", "a"], "left_semi")
        parts.append(by_a.select("block", F.col("a").alias("seed"), F.col("b").alias("id")))
        seeds.append(opening)
        rest = others.join(_side(by_a, "b"), ["block", "id"], "left_anti")
        remaining = fix_layout(rest)
        before, left = left, remaining.count()
        if before - left < min_yield * before:
            break
    edges = fix_layout(find_pairs(remaining).select("block", "a", "b"))
    covered = fix_layout(covered_nodes(edges))
    from_seed = _join(edges, covered, "a", "left_anti")
    parts.append(from_seed.select("block", F.col("a").alias("seed"), F.col("b").alias("id")))

    if all_neighbours and seeds:
        # Late seeds may be similar to nodes that early ones took.
        last = remaining.join(covered, ["block", "id"], "left_anti")
        every_seed = fix_layout(_union([*seeds, last]))
        ids = every_seed.select("block", "id")
        others = fix_layout(nodes.join(ids, ["block", "id"], "left_anti"))
        pairs = fix_layout(find_pairs(every_seed, others).select("block", "a", "b"))
        parts = _both_ways(pairs, ids)
    elif all_neighbours:
        ends = _side(edges, "a").unionByName(_side(edges, "b")).distinct()
        parts = _both_ways(edges, ends.join(covered, ["block", "id"], "left_anti"))

    members = _union(parts).distinct()
    if not all_neighbours:
        members = members.groupBy("block", "id").agg(F.min("seed").alias("seed")).select("block", "seed", "id")
    own = members.select("block", "seed", F.col("seed").alias("id")).distinct()
    return members.unionByName(own)


def ordered_members(
    nodes: DataFrame, find_pairs: PairFinder, head: int = 1_000, peel_above: int = 20_000, min_yield: float = 0.1
) -> DataFrame:
    """The groups (block, seed, id) of `ordered_groups` over the pairs of nodes (block, id, place, ...), without listing them all.

    While many nodes remain, the first `head` ids of each block are visited. Only earlier ones of a smaller id can have
    taken one of them, so their pairs tell which are free when their turn comes; those are compared with all nodes and
    their groups leave. One that opens no group stays, as a later row of a smaller id may take it.
    """
    remaining = fix_layout(nodes.withColumn("visited", F.lit(False)))
    left = remaining.count()
    parts: list[DataFrame] = []
    place_of = lambda df, side: df.select("block", F.col("id").alias(side), F.col("place").alias(f"{side}_place")).distinct()
    while left > peel_above:
        turn = F.dense_rank().over(Window.partitionBy("block").orderBy("place", "id"))
        heads = fix_layout(remaining.where(~F.col("visited")).withColumn("_turn", turn).where(F.col("_turn") <= head).drop("_turn"))
        edges = fix_layout(find_pairs(heads).select("block", "a", "b").distinct())
        placed = edges.join(place_of(heads, "a"), ["block", "a"]).join(place_of(heads, "b"), ["block", "b"])
        ahead = placed.where(F.struct("a_place", "a") < F.struct("b_place", "b"))
        coded = ahead.select(F.to_json(F.struct("block")).alias("code"), "a_place", "a", "b")
        covered = _sweep_covered(coded, "a_place").join(heads.select(F.to_json(F.struct("block")).alias("code"), "block").distinct(), "code")
        opening = fix_layout(heads.join(covered.select("block", "id"), ["block", "id"], "left_anti"))
        ids = opening.select("block", "id").distinct()
        others = fix_layout(remaining.join(ids, ["block", "id"], "left_anti"))
        inside = _join(_join(edges, ids, "a", "left_semi"), ids, "b", "left_semi")
        across = _join(find_pairs(opening, others).select("block", "a", "b"), ids, "a", "left_semi")
        taken = fix_layout(ordered_groups(inside.unionByName(across), opening.select("block", "id", "place").distinct()))
        parts.append(taken)
        seen = heads.select("block", "id", F.lit(True).alias("_seen")).distinct()
        rest = remaining.join(_side(taken, "id"), ["block", "id"], "left_anti").join(seen, ["block", "id"], "left")
        remaining = fix_layout(rest.withColumn("visited", F.col("visited") | F.col("_seen").isNotNull()).select(*remaining.columns))
        before, left = left, remaining.count()
        if before - left < min_yield * before:
            break
    places = remaining.select("block", "id", "place").distinct()
    return _union([*parts, ordered_groups(find_pairs(remaining), places)])


def _both_ways(pairs: DataFrame, seeds: DataFrame) -> list[DataFrame]:
    """Members of each seed, whichever side of the pair it is on. No two seeds are a pair."""
    return [
        _join(pairs, seeds, "a", "left_semi").select("block", F.col("a").alias("seed"), F.col("b").alias("id")),
        _join(pairs, seeds, "b", "left_semi").select("block", F.col("b").alias("seed"), F.col("a").alias("id")),
    ]


def _union(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result
