"""Near-duplicate documents by SimHash fingerprints, linked through BK-trees.

The words of a text (ASCII lower-cased, cut at white space) give runs of three, repeats included; a text of fewer words is
one run. A bit of the fingerprint is set if it is set in over half of the runs' 64-bit hashes. Two fingerprints link if
they differ in at most `RADIUS` bits, and documents linked by a chain are one component.

Distinct fingerprints are dealt to cells, and each cell is the shard of one BK-tree: children hang on their parent by their
Hamming distance to it, and a search follows only the edges within the radius of its own distance. A tree is sent to the
fingerprints that can link to its members and to no others: 64 bits are cut in five blocks, two fingerprints that differ in
three bits agree in two whole blocks, so each of the ten pairs of blocks is a key and equal keys make a cell. (Sending all
trees to all fingerprints finds the same links, with work that grows by the square of the documents.) A cell of more than
`CELL` fingerprints is dealt again by pairs of blocks of the bits that are left, until its free bits allow no more than
`CELL` members, so no task ever holds a larger tree. A cell gives a spanning forest of its links, not all pairs.

Edge cases: null, empty and blank texts have the fingerprint zero, linked like any other. Rows without a key have their
fingerprint and component, but name none: the component is the smallest key in it, null where it has none. Repeated rows
are kept. An empty table gives an empty result. Texts are whole, read in pieces. Only key and text of the input are used,
so other columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathwarden.operators.components import components
from pathwarden.session import cut_lineage

RUN = 3
SEED = 42
RADIUS = 3
#: Blocks that the bits are cut in; two fingerprints within the radius agree in all blocks but `RADIUS`.
BLOCKS = 5
#: The most fingerprints of a cell: a power of two, so that few free bits cannot exceed it.
CELL = 1 << 14
#: Bytes of text that are hashed at once, and visits that a search may have open at once.
PIECE = 1 << 20
VISITS = 1 << 21

SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _word_pieces(data: bytes, piece: int) -> Iterator[list[bytes]]:
    """The words in pieces of the text; each piece begins with the last words of the one before it."""
    words, begin = [], 0
    while begin < len(data):
        gap = SPACE.search(data, begin + piece)
        end = gap.start() if gap else len(data)
        words = words[-(RUN - 1) :] + data[begin:end].split()
        begin = end
        if len(words) >= RUN or begin >= len(data):
            yield words


def fingerprint(text: str | None, piece: int = PIECE) -> int:
    """The fingerprint as a number of 64 bits without sign."""
    data = (text or "").encode().lower()
    runs, counts = 0, np.zeros(64, np.int64)
    of = partial(xxhash.xxh64_intdigest, seed=SEED)
    for words in _word_pieces(data, piece):
        if len(words) < RUN:
            words = [b" ".join(words)] if words and not runs else []
            shingles = iter(words)
        else:
            shingles = map(b" ".join, zip(*[words[n:] for n in range(RUN)], strict=False))
        hashes = np.fromiter(map(of, shingles), np.uint64)
        for low in range(0, len(hashes), 1 << 16):
            some = hashes[low : low + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
            counts += np.unpackbits(some, axis=1).sum(0, dtype=np.int64)
        runs += len(hashes)
    return int.from_bytes(np.packbits(2 * counts > runs).tobytes(), "big")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, print): the fingerprint of each row as a long with sign."""

    @F.arrow_udf("long")
    def printed(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            values = np.fromiter((fingerprint(t.as_py()) for t in part), np.uint64, len(part))
            yield pa.array(values.view(np.int64))

    return docs.select(F.col(f"`{key}`").alias(key), printed(F.col(f"`{text}`")).alias("print"))


# Trees


def bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


class Forest:
    """A BK-tree for each cell, all built a level at a time. `cell` is the number of each member's cell, in order."""

    def __init__(self, cell: np.ndarray, prints: np.ndarray):
        self.prints = prints
        edges, nodes = [], []
        waiting, place = np.arange(len(prints)), cell.astype(np.int64)
        self.root_of, level = None, 0
        while len(waiting):
            # The first that waits at a place takes it; the others go on to its child at their distance.
            places, first, back = np.unique(place, return_index=True, return_inverse=True)
            node = waiting[first]
            if level:
                edges.append(places)
                nodes.append(node)
            else:
                self.root_of = node[back]
            above = node[back]
            going = above != waiting
            waiting, above = waiting[going], above[going]
            place = above * 65 + bits(prints[waiting] ^ prints[above])
            level += 1
        # An edge is parent * 65 + distance, so the children of a parent are sorted by distance.
        self.edge = np.concatenate(edges) if edges else np.zeros(0, np.int64)
        self.child = np.concatenate(nodes) if nodes else np.zeros(0, np.int64)
        order = np.argsort(self.edge)
        self.edge, self.child = self.edge[order], self.child[order]

    def search(self, queries: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (member, query) within the radius, the member before the query."""
        at = self.root_of[queries]
        while len(queries):
            distance = bits(self.prints[queries] ^ self.prints[at])
            near = (distance <= radius) & (at < queries)
            yield at[near], queries[near]
            low = np.searchsorted(self.edge, at * 65 + np.maximum(distance - radius, 1))
            high = np.searchsorted(self.edge, at * 65 + np.minimum(distance + radius, 64), "right")
            many = high - low
            start = np.repeat(low - np.cumsum(many) + many, many)
            at = self.child[start + np.arange(many.sum())]
            queries = np.repeat(queries, many)


def links(cell: np.ndarray, prints: np.ndarray, visits: int = VISITS) -> np.ndarray:
    """A spanning forest of the links within cells, as pairs of places (rows of two). `cell` is sorted."""
    _, size = np.unique(cell, return_counts=True)
    several = np.flatnonzero(np.repeat(size, size) > 1)
    if not len(several):
        return np.zeros((0, 2), np.int64)
    forest = Forest(cell[several], prints[several])
    # A query visits at most its whole cell: so many queries at once that the open visits stay few.
    slices = np.cumsum(np.repeat(size, size)[several]) // visits
    label, found = np.arange(len(several)), []
    for queries in np.split(np.arange(len(several)), np.flatnonzero(np.diff(slices)) + 1):
        for a, b in forest.search(queries):
            apart = label[a] != label[b]
            a, b = a[apart], b[apart]
            _, one = np.unique(label[a] * len(label) + label[b], return_index=True)
            root = {}

            def top(x):
                while root.get(x, x) != x:
                    root[x] = x = root.get(root[x], root[x])
                return x

            for x, y in zip(a[one].tolist(), b[one].tolist(), strict=True):
                p, q = top(int(label[x])), top(int(label[y]))
                if p != q:
                    root[max(p, q)] = min(p, q)
                    found.append((x, y))
            if root:
                to = np.arange(len(label))
                for x in root:
                    to[x] = top(x)
                label = to[label]
    return several[np.array(found, np.int64).reshape(-1, 2)]


# Cells


def block_masks(mask: int = 0) -> list[int]:
    """`mask` with each choice of blocks, of the bits it leaves free, that two fingerprints within the radius may share."""
    free = [n for n in range(64) if not mask >> n & 1]
    cuts = [round(len(free) * n / BLOCKS) for n in range(BLOCKS + 1)]
    blocks = [sum(1 << n for n in free[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [mask | sum(chosen) for chosen in combinations(blocks, BLOCKS - RADIUS)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def cells(prints: DataFrame, cell: int = CELL) -> DataFrame:
    """(mask, value, print): for each two prints within the radius a cell that holds both; no cell has over `cell` prints."""
    masks, parts = block_masks(), []
    dealt = prints.select("print", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    while True:
        keyed = dealt.select("mask", F.col("print").bitwiseAND(F.col("mask")).alias("value"), "print")
        # From the second time on, several ways lead to one mask.
        keyed = keyed.distinct() if parts else keyed
        most = 1 << max(64 - m.bit_count() for m in masks)
        large = keyed.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell).select("mask", "value")
        # Few free bits cannot make a large cell; else one pass of counts tells.
        if most <= cell or (large := cut_lineage(large)).isEmpty():
            parts.append(keyed)
            break
        parts.append(keyed.join(large, ["mask", "value"], "left_anti"))
        finer = {m: block_masks(m) for m in masks}
        rows = [(_signed(m), [_signed(f) for f in fine]) for m, fine in finer.items()]
        table = prints.sparkSession.createDataFrame(rows, "mask long, finer array<long>")
        rest = cut_lineage(keyed.join(large, ["mask", "value"], "left_semi").select("mask", "print"))
        dealt = rest.join(table, "mask").select("print", F.explode("finer").alias("mask"))
        masks = sorted({f for fine in finer.values() for f in fine})
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def print_links(prints: DataFrame, cell: int = CELL) -> DataFrame:
    """Links (a, b) between distinct fingerprints, enough to connect all that are within the radius."""

    def found(batches):
        held, rows = [], 0

        def searched(part):
            cell_of, value = part.column("mask").to_numpy(), part.column("value").to_numpy()
            new = np.flatnonzero(np.diff(cell_of) | np.diff(value)) + 1
            number = np.zeros(len(value), np.int64)
            number[new] = 1
            own = part.column("print").to_numpy()
            pairs = links(np.cumsum(number), own.view(np.uint64))
            return pa.record_batch({"a": pa.array(own[pairs[:, 0]]), "b": pa.array(own[pairs[:, 1]])})

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < 4 * cell:
                continue
            # All cells but the last are complete.
            part = pa.Table.from_batches(held).combine_chunks()
            mask, value = part.column("mask").to_numpy(), part.column("value").to_numpy()
            new = np.flatnonzero(np.diff(mask) | np.diff(value))
            end = int(new[-1]) + 1 if len(new) else 0
            if end:
                yield searched(part.slice(0, end))
            rest = part.slice(end)
            held, rows = rest.to_batches(), rest.num_rows
        if rows:
            yield searched(pa.Table.from_batches(held))

    dealt = cells(prints, cell).repartition("mask", "value").sortWithinPartitions("mask", "value")
    return dealt.mapInArrow(found, "a long, b long")


def near_components(docs: DataFrame, key: str = "doc_id", text: str = "text", cell: int = CELL) -> DataFrame:
    """One row per document: key, print, and component_id, the smallest key among the documents it is linked to by a chain."""
    printed = cut_lineage(fingerprints(docs, key, text))
    prints = cut_lineage(printed.groupBy("print").agg(F.min(key).alias("least")))
    linked = cut_lineage(components(print_links(prints.select("print"), cell)).withColumnRenamed("id", "print"))
    named = linked.join(prints, "print").groupBy("component").agg(F.min("least").alias("component_id"))
    placed = linked.join(named, "component").select("print", "component_id")
    # Stored, so that the last join is one of two tables, whose hot prints Spark can split.
    placed = cut_lineage(prints.join(placed, "print", "left").select("print", F.coalesce("component_id", "least").alias("component_id")))
    return printed.join(placed, "print").select(key, "print", "component_id")
