"""Joins of similar texts with full recall, from keys that similar texts must share.

Cut the shorter of two texts into pieces, one more than the edits that may part it from a match. An edit touches one
piece, so some piece occurs in the longer text too, at nearly the same place (after Li, Deng, Wang and Feng, 2011).
Every text emits hashed pieces with its id, an equi-join gives the candidates, and a bound on the score is checked in
the same stage, so raw candidates are never stored. Pairs found are made distinct as bare ids; what else belongs to a
row is fetched for those alone. The joins are plain ones, so a key that many texts share is split by Spark's adaptive
skew handling.

Where a sample shows that the keys bring most texts of a block together, the texts are compared in parts instead (see
text_blocks.py); the choice is made as the query runs and does not touch the result. Nothing runs while the plan is built,
unless the caller asks for the choice `now`: a plan with both ways grows with every step that reads from it.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathwarden.functions.batches import BATCH_SCORERS
from pathwarden.functions.similarity import plain_text, score_of, sorted_tokens
from pathwarden.operators.text_blocks import near_pairs, scored_pairs, task_count

TINY = 1e-9
#: The texts that tell whether keys are worthwhile, and the candidates they may give for each pair of a block.
SAMPLE_TEXTS = 1_000
CROWDED = 0.1
#: The weight of token scores in the weighted score.
TOKEN_WEIGHT = 0.95


def allowance(cutoff: float) -> float:
    """Share of the length that may differ. Scores are rounded, hence the half."""
    return 1 - (cutoff - 0.5) / 100


def _edits(length: Column, scorer: str, cutoff: float) -> Column:
    """The most edits between a text of `length` and any text at least as long that may match."""
    c = allowance(cutoff)
    if scorer == "levenshtein":
        return F.floor(length * (c / (1 - c)) + TINY).cast("int")
    longest = F.floor(length * ((1 + c) / (1 - c)) + TINY)
    return F.floor((length + longest) * c + TINY).cast("int")


def _shortest(length: Column, scorer: str, cutoff: float) -> Column:
    """The shortest text that may match one of `length`."""
    c = allowance(cutoff)
    share = 1 - c if scorer == "levenshtein" else (1 - c) / (1 + c)
    return F.ceil(length * share - TINY).cast("int")


def _bounds(length: Column, count: Column, i: Column) -> tuple[Column, Column]:
    """Start and width of piece `i` of `count` of a text of `length`."""
    start = F.floor(i * length / count).cast("int")
    return start, F.floor((i + 1) * length / count).cast("int") - start


def _index_keys(nodes: DataFrame, scorer: str, cutoff: float) -> DataFrame:
    """One key per piece of the text."""
    count = _edits(F.length("text"), scorer, cutoff) + 1

    def key(i):
        start, width = _bounds(F.length("text"), count, i)
        return F.xxhash64("block", F.length("text"), i, F.substring(F.col("text"), start + 1, width))

    return nodes.withColumn("sig", F.explode(F.transform(F.sequence(F.lit(0), count - 1), key)))


def _probe_keys(nodes: DataFrame, scorer: str, cutoff: float) -> DataFrame:
    """The keys that a shorter or equally long match may have: pieces at the places its edits allow."""
    size = F.length("text")
    lengths = nodes.withColumn("_size", size).withColumn("_len", F.explode(F.sequence(_shortest(size, scorer, cutoff), size)))
    cut = lengths.withColumn("_edits", _edits(F.col("_len"), scorer, cutoff))
    cut = cut.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_edits"))))
    start, width = _bounds(F.col("_len"), F.col("_edits") + 1, F.col("_i"))
    cut = cut.withColumn("_start", start).withColumn("_width", width)
    # A shift by s costs at least |s| edits before the piece and |s - longer| after it, and some piece with at
    # most as many edits before it as its number is untouched.
    longer = F.col("_size") - F.col("_len")
    back = F.floor((F.col("_edits") - longer) / 2).cast("int")
    forth = F.floor((F.col("_edits") + longer) / 2).cast("int")
    before, after = F.col("_i"), F.col("_edits") - F.col("_i")
    low = F.col("_start") + F.greatest(-back, -before, longer - after)
    high = F.col("_start") + F.least(forth, before, longer + after)
    low, high = F.greatest(F.lit(0), low), F.least(F.col("_size") - F.col("_width"), high)
    placed = cut.withColumn("_low", low).withColumn("_high", high)
    placed = placed.where((longer <= F.col("_edits")) & (F.col("_low") <= F.col("_high")))
    placed = placed.withColumn("_at", F.explode(F.sequence("_low", "_high")))
    piece = F.substring(F.col("text"), F.col("_at") + 1, F.col("_width"))
    return placed.select(*nodes.columns, F.xxhash64("block", "_len", "_i", piece).alias("sig"))


def _close(a: Column, b: Column, scorer: str, cutoff: float) -> Column:
    """A necessary condition for the score, checked in the JVM ahead of it."""
    longest = F.greatest(F.length(a), F.length(b)) if scorer == "levenshtein" else F.length(a) + F.length(b)
    edits = F.floor(longest * allowance(cutoff) + TINY).cast("int")
    return F.call_function("levenshtein", a, b, edits) >= 0


def _needed(scorer: str, cutoff: float):
    """The least common subsequence of two texts that may match, from their lengths."""
    c = allowance(cutoff)

    def needed(a, b):
        if scorer == "levenshtein":
            longest = np.maximum(a, b)
            return longest - np.floor(longest * c + TINY)
        return np.ceil((a + b - np.floor((a + b) * c + TINY)) / 2)

    return needed


def _reach(scorer: str, cutoff: float) -> float:
    """How many times as long as the other one the longer of two texts that match may be."""
    c = allowance(cutoff)
    return 1 / (1 - c) if scorer == "levenshtein" else (1 + c) / (1 - c)


def _crowded(sides: list[DataFrame], scorer: str, cutoff: float, now: bool = False) -> Column | bool:
    """Whether keys bring many texts of a block together that need not match, by a bounded sample of them."""
    some = [side.orderBy(F.xxhash64("id", "text"), "id").limit(SAMPLE_TEXTS) for side in sides]
    counts = lambda rows, key, name: rows.groupBy(key).agg(F.count("*").alias(name))
    index, probe = _index_keys(some[0], scorer, cutoff), _probe_keys(some[-1], scorer, cutoff)
    met = counts(index, "sig", "n").join(counts(probe, "sig", "m"), "sig").select((F.col("n") * F.col("m")).alias("met"), F.lit(0).alias("all"))
    pairs = counts(some[0], "block", "n").join(counts(some[-1], "block", "m"), "block")
    pairs = pairs.select(F.lit(0).alias("met"), (F.col("n") * F.col("m") / (2 if len(sides) == 1 else 1)).alias("all"))
    total = met.unionByName(pairs).agg(F.sum("met") > CROWDED * F.sum("all"))
    return bool(total.first()[0]) if now else F.coalesce(total.scalar(), F.lit(False))


def _tokens(text: Column) -> Column:
    return F.array_distinct(F.split(text, r"\s+"))


def _missable(text: Column, cutoff: float) -> Column:
    """How many tokens a text may lack in the other one at a token score of `cutoff`.

    A token without its equal has an unmatched character in it or beside it, and one beside it may serve two tokens.
    """
    c = allowance(cutoff)
    return (2 * F.floor(F.length(text) * (1 + (1 + c) / (1 - c)) * c + TINY)).cast("int")


def _token_keys(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("token", F.explode(_tokens(F.col("text"))))


def _rare_token_keys(nodes: DataFrame, index: DataFrame, cutoff: float) -> DataFrame:
    """The tokens that the fewest texts of `index` have, one more than a text may lack."""
    counts = index.groupBy("block", "token").agg(F.count(F.lit(1)).alias("_n"))
    counted = _token_keys(nodes).join(counts, ["block", "token"], "left")
    ranked = counted.groupBy(*nodes.columns).agg(F.array_sort(F.collect_list(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "token"))).alias("_all"))
    picked = F.slice("_all", F.lit(1), _missable(F.col("text"), cutoff) + 1)
    return ranked.withColumn("_entry", F.explode(picked)).select(*nodes.columns, F.col("_entry.token").alias("token"))


def _token_near(a: Column, b: Column, cutoff: float) -> Column:
    """A necessary condition for a token score: like lengths, and one text has nearly all tokens of the other."""
    left, right = _tokens(a), _tokens(b)
    some = (F.size(F.array_except(left, right)) <= _missable(a, cutoff)) | (F.size(F.array_except(right, left)) <= _missable(b, cutoff))
    return (F.greatest(F.length(a), F.length(b)) < 1.5 * F.least(F.length(a), F.length(b))) & some


def _families(scorer: str, cutoff: int) -> list[tuple[Column, str, int]]:
    """The ways in which two names can reach the cutoff: text to compare, kind, cutoff on its own score."""
    if scorer != "weighted":
        return [(F.col("name"), scorer, cutoff)]
    if cutoff <= 90:
        raise ValueError("the weighted score is joined above 90 only, where partial matches cannot reach")
    plain = plain_text(F.col("name"))
    token_cutoff = ceil((cutoff - 0.5) / TOKEN_WEIGHT - TINY)
    by_token = [(sorted_tokens(plain), "ratio", token_cutoff), (plain, "token", token_cutoff)]
    return [(plain, "ratio", cutoff), *(by_token if token_cutoff <= 100 else [])]


def _candidates(left: DataFrame, right: DataFrame | None, family: tuple, scorer: str, by_keys: bool = False, now: bool = False) -> list[DataFrame]:
    """The (block, a, b) whose names pass the JVM checks, `by_keys` if crowded ones are compared elsewhere."""
    text, kind, cutoff = family

    def thinned(side):
        rows = side.withColumn("text", text).select("block", "id", "text")
        # The weighted score of a text without any letter or digit is 0.
        return rows.where(F.col("text") != "") if scorer == "weighted" else rows

    sides = [thinned(left)] if right is None else [thinned(left), thinned(right)]
    parts = []
    if not by_keys and kind != "token" and dict(left.dtypes)["id"] in ("int", "bigint"):
        crowded, in_parts = _crowded(sides, kind, cutoff, now), sides
        if not now:
            in_parts, sides = [side.where(crowded) for side in sides], [side.where(~crowded) for side in sides]
        if not now or crowded:
            parts = [near_pairs(in_parts[0], None if right is None else in_parts[1], _needed(kind, cutoff), _reach(kind, cutoff))]
        if now and crowded:
            return parts
    found = []
    for indexed, probed in [(0, 0)] if right is None else [(0, 1), (1, 0)]:
        if kind == "token":
            index = _token_keys(sides[indexed])
            probe = _rare_token_keys(sides[probed], index, cutoff)
            near = _token_near(F.col("i.text"), F.col("p.text"), cutoff) & (F.col("i.id") != F.col("p.id"))
            keys = (F.col("i.block") == F.col("p.block")) & (F.col("i.token") == F.col("p.token"))
        else:
            index, probe = _index_keys(sides[indexed], kind, cutoff), _probe_keys(sides[probed], kind, cutoff)
            near = _close(F.col("i.text"), F.col("p.text"), kind, cutoff)
            if right is None:
                near = ((F.length("p.text") > F.length("i.text")) | (F.col("p.id") > F.col("i.id"))) & near
            keys = (F.col("i.block") == F.col("p.block")) & (F.col("i.sig") == F.col("p.sig"))
        pairs = index.alias("i").join(probe.alias("p"), keys & near)
        ids = F.col("i.id"), F.col("p.id")
        found.append(pairs.select(F.col("i.block").alias("block"), F.least(*ids).alias("a"), F.greatest(*ids).alias("b")))
    return found + parts


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _pairs_by_name(
    left: DataFrame,
    right: DataFrame | None,
    scorer: str,
    name_cutoff: int,
    path_cutoff: int,
    name_block: str,
    fields: list[str],
    by_keys: bool = False,
) -> DataFrame:
    """The (block, a, b) of rows whose names and paths pass the JVM checks, with the fields of both.

    Names meet once for each distinct name, in `name_block`, without any path; the rows of two names that met are then
    compared by their paths, once. Rows carry their fields into the pairs, so that pairs are not joined again.
    """
    nodes = left if right is None else left.unionByName(right)
    # An id has the fields of one row, unless it repeats.
    carried = nodes.groupBy("block", "id").agg(F.collect_list(F.struct(*fields)).alias("fields"))
    rows = [
        side.select("block", F.expr(name_block).alias("_in"), "id", "name", "path").join(carried, ["block", "id"])
        for side in ([left] if right is None else [left, right])
    ]
    names = _union(rows).groupBy("_in", "name").agg(F.min("id").alias("_name"))
    nodes = names.select(F.col("_in").alias("block"), F.col("_name").alias("id"), "name")
    near = _union([p for family in _families(scorer, name_cutoff) for p in _candidates(nodes, None, family, scorer, by_keys)]).distinct()
    near = near.select(F.col("block").alias("_in"), F.col("a").alias("_x"), F.col("b").alias("_y"))
    own = names.select("_in", F.col("_name").alias("_x"), F.col("_name").alias("_y"))
    own = names.select("_in", F.col("_name").alias("_x"), F.col("_name").alias("_y"))
    met = _union([near, own] if right is None else [near, near.select("_in", F.col("_y").alias("_x"), F.col("_x").alias("_y")), own])

    def named(side, prefix, name):
        columns = [F.col(c).alias(f"{prefix}_{c}") for c in ("block", "id", "path", "fields")]
        return side.join(names, ["_in", "name"]).select("_in", F.col("_name").alias(name), *columns)

    one, two = named(rows[0], "i", "_x"), named(rows[-1], "p", "_y")
    pairs = met.join(one, ["_in", "_x"]).join(two, ["_in", "_y"])
    pairs = pairs.where((F.col("i_block") == F.col("p_block")) & _close(F.col("i_path"), F.col("p_path"), scorer, path_cutoff))
    ahead = F.col("i_id") < F.col("p_id")
    if right is None:
        # The rows of one name meet in both orders.
        pairs = pairs.where(F.when(F.col("_x") == F.col("_y"), ahead).otherwise(F.col("i_id") != F.col("p_id")))
    ids = F.col("i_id"), F.col("p_id")
    one, two = (F.when(ahead, F.col(f"{x}_fields")).otherwise(F.col(f"{y}_fields")) for x, y in ("ip", "pi"))
    pairs = pairs.select(F.col("i_block").alias("block"), F.least(*ids).alias("a"), F.greatest(*ids).alias("b"), one.alias("_one"), two.alias("_two"))
    pairs = pairs.withColumn("_a", F.explode("_one")).withColumn("_b", F.explode("_two"))
    return pairs.select("block", "a", "b", *[F.col(f"_{side}.{f}").alias(f"{side}_{f}") for side in "ab" for f in fields])


def _scored_rows(
    left: DataFrame, right: DataFrame | None, scorer: str, name_cutoff: int, path_cutoff: int, name_block: str, now: bool
) -> DataFrame:
    """The (block, a, b, name_score, path_score) that reach both cutoffs; crowded names are scored in the tasks where they meet."""
    sides = [left] if right is None else [left, right]
    copies = _union(sides).groupBy("block", "id").agg(F.count("*").alias("copies"))
    sides = [side.withColumn("name_block", F.expr(name_block)).join(copies, ["block", "id"]) for side in sides]
    names = _union(sides).groupBy("name_block", "name").agg(F.min("id").alias("id"))
    crowded = _crowded([names.select(F.col("name_block").alias("block"), "id", F.col("name").alias("text"))], scorer, name_cutoff, now)
    reach, needed, cutoffs = _reach(scorer, name_cutoff), _needed(scorer, name_cutoff), (name_cutoff, path_cutoff)

    def in_parts(sides):
        return scored_pairs(sides[0], None if right is None else sides[1], scorer, cutoffs, needed, reach)

    def by_keys(sides):
        sides = [side.drop("copies") for side in sides]
        near = _pairs_by_name(sides[0], None if right is None else sides[1], scorer, *cutoffs, name_block, ["name", "path"], True)
        return _scored(near, scorer, *cutoffs).select("block", "a", "b", "name_score", "path_score")

    if now:
        return in_parts(sides) if crowded else by_keys(sides)
    return in_parts([side.where(crowded) for side in sides]).unionByName(by_keys([side.where(~crowded) for side in sides]))


def _scored(pairs: DataFrame, scorer: str, name_cutoff: int, path_cutoff: int) -> DataFrame:
    pairs = pairs.withColumn("name_score", score_of(F.col("a_name"), F.col("b_name"), scorer, name_cutoff)).where(F.col("name_score") >= name_cutoff)
    return pairs.withColumn("path_score", score_of(F.col("a_path"), F.col("b_path"), scorer, path_cutoff)).where(F.col("path_score") >= path_cutoff)


def similar_pairs(
    left: DataFrame,
    right: DataFrame | None = None,
    *,
    scorer: str,
    name_cutoff: int,
    path_cutoff: int | None = None,
    extra: tuple[str, ...] = (),
    name_block: str = "block",
    bare: bool = False,
    now: bool = False,
) -> DataFrame:
    """Pairs of one block whose names (and paths) reach the cutoffs, each once.

    Nodes have (block, id, name[, path], extra...), ids unique in a block. Without `right` the pairs are those within
    `left`; with it, those across, the two sides sharing no id. The result has (block, a, b, a_name, b_name,
    name_score, ...) with a < b. Scores compare a's text with b's; where that is not symmetric, `name_score_back`
    compares b's with a's, and a pair is kept if either reaches the cutoff. Where a name's rows are in several blocks,
    `name_block` is what these share, an expression of `block`: names are compared there, once.
    With paths, `bare` asks for (block, a, b, name_score, path_score) only. `now` lets a small job on a sample of the
    nodes, which should be stored, choose how names meet.
    """
    if path_cutoff is not None:
        if bare and scorer in BATCH_SCORERS and dict(left.dtypes)["id"] in ("int", "bigint"):
            return _scored_rows(left, right, scorer, name_cutoff, path_cutoff, name_block, now)
        pairs = _pairs_by_name(left, right, scorer, name_cutoff, path_cutoff, name_block, ["name", "path", *extra])
        back = F.col("name_score") if scorer == "levenshtein" else score_of(F.col("b_name"), F.col("a_name"), scorer)
        scored = _scored(pairs, scorer, name_cutoff, path_cutoff)
        return scored.select("block", "a", "b", "name_score", "path_score") if bare else scored.withColumn("name_score_back", back)
    nodes = left if right is None else left.unionByName(right)
    own = lambda side, fields: nodes.select("block", F.col("id").alias(side), *[F.col(f).alias(f"{side}_{f}") for f in fields])
    pairs = _union([p for family in _families(scorer, name_cutoff) for p in _candidates(left, right, family, scorer, now=now)]).distinct()
    # Scores are much work on few bytes, whose sizes must not tell how many tasks there are.
    pairs = pairs.join(own("a", ("name", *extra)), ["block", "a"]).repartition(task_count(left.sparkSession), "block", "b")
    pairs = pairs.join(own("b", ("name", *extra)), ["block", "b"])
    a, b = F.col("a_name"), F.col("b_name")
    pairs = pairs.withColumn("name_score", score_of(a, b, scorer, name_cutoff))
    pairs = pairs.withColumn("name_score_back", F.col("name_score") if scorer == "levenshtein" else score_of(b, a, scorer, name_cutoff))
    return pairs.where(F.greatest("name_score", "name_score_back") >= name_cutoff)
