"""Texts of a block compared in parts, by the length of their longest common subsequence.

Where most texts of a block share long pieces (web addresses of a few hosts), keys bring nearly all pairs together, and
several times. There each part of a block meets each other part in a task of its own. The common subsequences of some
texts with all of the other part advance character by character as bits of whole numbers (after Hyyrö, 2004), so a
pair costs a few operations a character, and a task holds two parts, whatever the size of the block. Before that, the
characters that both texts have, counted in a few operations a pair, tell which pairs cannot have enough in common.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pathwarden.functions.batches import BATCH_SCORERS

#: A part has about so many texts, and so many characters, at most.
PART_ROWS = 2_048
PART_CHARS = 1_000_000
#: Texts whose characters are counted together, those of them that advance together, and numbers that they may hold.
COUNTED = 64
TOGETHER = 16
HELD = 500_000
#: Pairs that advance one by one, and the share of all from which it is cheaper to let all pairs advance.
ALONE = 16_384
DENSE = 0.3
#: Kinds of characters that are told apart in counts, and the bits of all counts of a text: their sum must fit a byte.
KINDS = 64
COUNT_BITS = 255
#: Row pairs of like names that are scored together, about.
SCORED = 200_000
#: Tasks for each core: a few bytes of texts are much work, so their sizes must not tell how many tasks there are.
TASKS_A_CORE = 4

#: From the lengths of two texts to the least common length that lets them match.
Needed = Callable[[np.ndarray, np.ndarray], np.ndarray]


class Texts:
    """Texts in the order of their lengths, their characters as columns of numbers."""

    def __init__(self, part: pd.DataFrame):
        texts, sizes = part["text"].tolist(), np.array([len(t) for t in part["text"]])
        order = np.argsort(sizes, kind="stable")
        self.ids, self.sizes = part["id"].to_numpy()[order], sizes[order]
        width = max(1, int(sizes.max()))
        self.points = np.array([texts[k] for k in order], dtype=f"U{width}").view(np.uint32).reshape(len(texts), width)

    def numbered(self, symbols: np.ndarray) -> np.ndarray:
        """The number of each character among the symbols, one text a column; any other, and none, is their count."""
        at = np.minimum(np.searchsorted(symbols, self.points), len(symbols) - 1)
        known = (symbols[at] == self.points) & (np.arange(self.points.shape[1])[None, :] < self.sizes[:, None])
        return np.ascontiguousarray(np.where(known, at, len(symbols)).T.astype(np.intp))


class Counts:
    """The characters of two sides as bits, one for the first of a kind, one for the second and so on.

    The bits that two texts share bound their common subsequence. Kinds are symbols, several in one where there are many;
    of a kind so frequent that the bits do not suffice, what is beyond them is counted as a sum.
    """

    def __init__(self, one: np.ndarray, two: np.ndarray, symbols: int):
        kinds = min(symbols, KINDS)

        def count(columns):
            place, text = np.nonzero(columns < symbols)
            found = np.bincount(text * kinds + columns[place, text] % kinds, minlength=columns.shape[1] * kinds)
            return found.reshape(columns.shape[1], kinds)

        counts = count(one), count(two)
        most = np.minimum(*(c.max(axis=0) for c in counts))
        held = next(m for t in range(COUNT_BITS, -1, -1) if (m := np.minimum(most, t)).sum() <= COUNT_BITS)
        kind = np.repeat(np.arange(kinds), held)
        level = np.arange(len(kind)) - np.repeat(np.cumsum(held) - held, held)
        words = max(1, -(-len(kind) // 64))

        def bits(found):
            padded = np.zeros((len(found), words * 64), bool)
            padded[:, : len(kind)] = found[:, kind] > level
            return np.ascontiguousarray(np.packbits(padded, axis=1).view(np.uint64).T)

        self.one, self.two = (bits(c) for c in counts)
        self.more = [np.maximum(c - held, 0)[:, held < most].sum(axis=1) for c in counts]

    def bound(self, low: int, high: int, first: int, last: int) -> np.ndarray:
        """The most that each of the texts from `low` to `high` can have in common with those from `first` to `last`."""
        total = np.zeros((high - low, last - first), np.uint8)
        for left, right in zip(self.one, self.two):
            total += np.bitwise_count(left[low:high, None] & right[None, first:last])
        if self.more[0].any() and self.more[1].any():
            return total + np.minimum(self.more[0][low:high, None], self.more[1][None, first:last])
        return total


def _advance(state: np.ndarray, hits, hit: np.ndarray, total: np.ndarray) -> None:
    """One more character: `hits(word, out)` gives the places in the first texts that have it."""
    carry = None
    for word, now in enumerate(state):
        hits(word, hit)
        np.bitwise_and(now, hit, out=hit)
        np.add(now, hit, out=total)
        if len(state) > 1:
            over = total < hit
            if carry is not None:
                total += carry
                over |= total < carry
            carry = over.astype(np.uint64)
        np.bitwise_xor(now, hit, out=hit)
        np.bitwise_or(total, hit, out=now)


def common_lengths(masks: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """The longest common subsequence of each text behind the masks (word, text, symbol) with each of the columns."""
    state = np.full((len(masks), masks.shape[1], columns.shape[1]), ~np.uint64(0))
    hit, total = np.empty_like(state[0]), np.empty_like(state[0])
    for column in columns:
        _advance(state, lambda word, out: np.take(masks[word], column, axis=1, out=out, mode="clip"), hit, total)
    return np.bitwise_count(~state).sum(axis=0, dtype=np.int64)


def common_lengths_of(masks: np.ndarray, columns: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The same of the texts `i` behind the masks with the columns `j`, pair by pair."""
    flat, start = masks.reshape(len(masks), -1), i * masks.shape[2]
    state = np.full((len(masks), len(i)), ~np.uint64(0))
    hit, total = np.empty_like(state[0]), np.empty_like(state[0])
    for column in columns:
        at = start + column.take(j)
        _advance(state, lambda word, out: np.take(flat[word], at, out=out, mode="clip"), hit, total)
    return np.bitwise_count(~state).sum(axis=0, dtype=np.int64)


def near_texts(one: Texts, two: Texts, needed: Needed, reach: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The places in both of the pairs whose common length is enough; `reach` is the longest share of two lengths."""
    symbols = np.unique(one.points)
    coded, columns = one.numbered(symbols), two.numbered(symbols)
    counts = Counts(coded, columns, len(symbols))
    lengths, length = np.unique(two.sizes, return_inverse=True)
    counted = max(1, min(COUNTED, HELD // len(two.ids)))
    for low in range(0, len(one.ids), counted):
        sizes = one.sizes[low : low + counted]
        first = np.searchsorted(two.sizes, np.floor(sizes[0] / reach), "left")
        last = np.searchsorted(two.sizes, np.ceil(sizes[-1] * reach), "right")
        if first == last:
            continue
        least = np.broadcast_to(needed(sizes[:, None], lengths[None, :]), (len(sizes), len(lengths)))
        least = np.ceil(least).astype(np.int32)
        i, j = np.nonzero(counts.bound(low, low + len(sizes), first, last) >= least.take(length[first:last], axis=1))
        if not len(i):
            continue
        masks = np.zeros((max(1, -(-int(sizes[-1]) // 64)), len(sizes), len(symbols) + 1), np.uint64)
        for place in range(sizes[-1]):
            masks[place // 64, np.arange(len(sizes)), coded[place, low : low + counted]] |= np.uint64(1 << place % 64)
        masks[:, :, -1] = 0
        j = j + first
        if len(i) > DENSE * len(sizes) * (last - first):
            width = two.sizes[last - 1]
            parts = [common_lengths(masks[:, k : k + TOGETHER], columns[:width, first:last]) for k in range(0, len(sizes), TOGETHER)]
            common = np.concatenate(parts)[i, j - first]
        else:
            slices = [(i[k : k + ALONE], j[k : k + ALONE]) for k in range(0, len(i), ALONE)]
            common = np.concatenate([common_lengths_of(masks, columns[: two.sizes[y.max()]], x, y) for x, y in slices])
        near = common >= least[i, length[j]]
        if near.any():
            yield i[near] + low, j[near]


def _parts(rows: DataFrame, rows_a_part: int) -> DataFrame:
    sizes = rows.groupBy("code").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))
    parts = F.ceil(F.greatest(F.col("n") / rows_a_part, F.col("chars") / PART_CHARS, F.lit(1))).cast("int")
    placed = rows.join(sizes.select("code", parts.alias("parts")), "code")
    return placed.withColumn("part", F.pmod(F.xxhash64("id", "text"), F.col("parts")).cast("int"))


def task_count(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), TASKS_A_CORE * spark.sparkContext.defaultParallelism)


def _met(left: DataFrame, right: DataFrame | None, rows_a_part: int, fields: list[str]) -> tuple:
    """Both sides (code, x, y, fields) of the products of parts, grouped, each product in one of many tasks."""
    one = _parts(left, rows_a_part)
    if right is None:
        first = one.withColumn("y", F.explode(F.sequence("part", F.col("parts") - 1))).withColumnRenamed("part", "x")
        second = one.withColumn("x", F.explode(F.sequence(F.lit(0), "part"))).withColumnRenamed("part", "y")
    else:
        two = _parts(right, rows_a_part)
        met = lambda side: side.select("code", F.col("parts").alias("_n")).distinct()
        others = F.explode(F.sequence(F.lit(0), F.col("_n") - 1))
        first = one.join(met(two), "code").withColumn("y", others).withColumnRenamed("part", "x")
        second = two.join(met(one), "code").withColumn("x", others).withColumnRenamed("part", "y")
    keys, tasks = ["code", "x", "y"], task_count(left.sparkSession)
    named = lambda side: side.select(*[F.col(f).alias(f) for f in [*keys, *fields]]).repartition(tasks, *keys)
    return named(first).groupBy(*keys), named(second).groupBy(*keys)


def near_pairs(left: DataFrame, right: DataFrame | None, needed: Needed, reach: float, rows_a_part: int = PART_ROWS) -> DataFrame:
    """Pairs (block, a, b), a <= b, of rows (block, id, text) of one block: within `left`, or across two sides."""
    within = right is None
    kind, block = left.schema["id"].dataType, left.select("block").schema

    def coded(side):
        rows = side.where(F.col("block").isNotNull() & F.col("text").isNotNull())
        # A block may be a struct: its text stands for it.
        return rows.select(F.to_json(F.struct("block")).alias("code"), F.col("id").cast("bigint").alias("id"), "text")

    def product(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(a) and len(b):
            side = Texts(a)
            other = side if within and key[1] == key[2] else Texts(b)
            for i, j in near_texts(side, other, needed, reach):
                ids, others = side.ids[i], other.ids[j]
                keep = (ids != others) | (side.sizes[i] != other.sizes[j])
                keep &= (i < j) if other is side else True
                if keep.any():
                    found.append((key[0], np.minimum(ids, others)[keep], np.maximum(ids, others)[keep]))
        return pd.DataFrame(found, columns=["code", "a", "b"])

    sides = _met(coded(left), None if within else coded(right), rows_a_part, ["id", "text"])
    lists = sides[0].cogroup(sides[1]).applyInPandas(product, "code string, a array<bigint>, b array<bigint>")
    named = lists.select(F.from_json("code", T.StructType(block.fields))["block"].alias("block"), F.explode(F.arrays_zip("a", "b")).alias("_pair"))
    return named.select("block", F.col("_pair.a").cast(kind).alias("a"), F.col("_pair.b").cast(kind).alias("b"))


class Named:
    """The rows of a part, by their distinct names."""

    def __init__(self, part: pd.DataFrame):
        numbers, self.names = pd.factorize(part["text"])
        self.texts = Texts(pd.DataFrame({"id": np.arange(len(self.names)), "text": self.names}))
        self.rows = np.argsort(numbers, kind="stable")
        self.count = np.bincount(numbers, minlength=len(self.names))
        self.start = np.cumsum(self.count) - self.count
        self.ids, self.copies = part["id"].to_numpy(), part["copies"].to_numpy()
        self.names, self.paths, self.blocks = self.names.to_numpy(object), part["path"].to_numpy(object), part["within"].to_numpy(object)


def _row_pairs(one: Named, i: np.ndarray, two: Named, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The rows of names that met: the place of the pair of names, a row of the first name and one of the second."""
    sizes = one.count[i] * two.count[j]
    cuts = np.searchsorted(np.cumsum(sizes), np.arange(SCORED, sizes.sum() + SCORED, SCORED))
    for at in np.split(np.arange(len(i)), np.unique(cuts)):
        pair = np.repeat(at, sizes[at])
        place = np.arange(len(pair)) - np.repeat(np.cumsum(sizes[at]) - sizes[at], sizes[at])
        width = two.count[j[pair]]
        yield pair, one.rows[one.start[i[pair]] + place // width], two.rows[two.start[j[pair]] + place % width]


def scored_pairs(
    left: DataFrame,
    right: DataFrame | None,
    scorer: str,
    cutoffs: tuple[int, int],
    needed: Needed,
    reach: float,
    rows_a_part: int = PART_ROWS,
) -> DataFrame:
    """Pairs (block, a, b, name_score, path_score), a < b, of rows (block, name_block, id, name, path, copies) of one block.

    Names meet once in each pair of parts, whatever the number of their paths. What passes is scored where it met, so
    only pairs that reach both cutoffs leave a task, as often as the product of the copies of both rows says.
    """
    within, score = right is None, BATCH_SCORERS[scorer]
    kind, block = left.schema["id"].dataType, left.select("block").schema

    def coded(side):
        code = lambda column: F.to_json(F.struct(column))
        rows = side.dropna(subset=["block", "name_block", "id", "name", "path"])
        return rows.select(
            code("name_block").alias("code"), code("block").alias("within"), F.col("id").cast("bigint").alias("id"), F.col("name").alias("text"), "path", "copies"
        )

    def scored(one, two, i, j, same):
        """(block, a, b, name_score, path_score, times) of the rows of the names that met."""
        for pair, r, s in _row_pairs(one, i, two, j):
            keep = (one.blocks[r] == two.blocks[s]) & (one.ids[r] != two.ids[s])
            keep &= (i[pair] != j[pair]) | (r < s) if same else True
            pair, r, s = pair[keep], r[keep], s[keep]
            ahead = one.ids[r] < two.ids[s]
            # A pair of names is scored once in each order that its rows ask for.
            asked, at = np.unique(pair * 2 + ahead, return_inverse=True)
            x, y = one.names[i[asked // 2]], two.names[j[asked // 2]]
            turned = asked % 2 == 0
            names = score(np.where(turned, y, x).tolist(), np.where(turned, x, y).tolist())[at]
            some = np.flatnonzero(names >= cutoffs[0])
            r, s, ahead, names = r[some], s[some], ahead[some], names[some]
            x, y = one.paths[r], two.paths[s]
            paths = score(np.where(ahead, x, y).tolist(), np.where(ahead, y, x).tolist())
            some = np.flatnonzero(paths >= cutoffs[1])
            r, s, names, paths = r[some], s[some], names[some], paths[some]
            ids, others, times = one.ids[r], two.ids[s], one.copies[r] * two.copies[s]
            yield one.blocks[r], *(np.repeat(c, times) for c in (np.minimum(ids, others), np.maximum(ids, others), names, paths)), times

    def product(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(a) and len(b):
            one = Named(a)
            two = one if within and key[1] == key[2] else Named(b)
            held: list = []

            def flush():
                if held:
                    i, j = (np.concatenate(side) for side in zip(*held))
                    for blocks, *columns, times in scored(one, two, i, j, two is one):
                        blocks = np.repeat(blocks, times)
                        found.extend((code, *(c[blocks == code] for c in columns)) for code in pd.unique(blocks))
                    held.clear()

            for i, j in near_texts(one.texts, two.texts, needed, reach):
                keep = (i <= j) if two is one else slice(None)
                held.append((one.texts.ids[i[keep]], two.texts.ids[j[keep]]))
                if sum(len(side[0]) for side in held) > SCORED:
                    flush()
            flush()
        return pd.DataFrame(found, columns=["within", "a", "b", "name_score", "path_score"])

    sides = _met(coded(left), None if within else coded(right), rows_a_part, ["within", "id", "text", "path", "copies"])
    columns = "within string, a array<bigint>, b array<bigint>, name_score array<int>, path_score array<int>"
    lists = sides[0].cogroup(sides[1]).applyInPandas(product, columns)
    pairs = lists.select(
        F.from_json("within", T.StructType(block.fields))["block"].alias("block"), F.explode(F.arrays_zip("a", "b", "name_score", "path_score")).alias("_pair")
    )
    return pairs.select("block", F.col("_pair.a").cast(kind).alias("a"), F.col("_pair.b").cast(kind).alias("b"), "_pair.name_score", "_pair.path_score")
