"""Near duplicates by BagMinHash: weighted minwise signatures of bags of word shingles, bands, and verified overlap.

A text is the bag of its runs of five words; the weight of a run is how often it stands there, and two texts are linked
if the weighted Jaccard similarity of their bags is 0.8 or more. Weights are cut into the dyadic levels [0, 1), [1, 2),
[2, 4), [4, 8), ... Each run and level has a Poisson process of its own, seeded by the two, of a rate that is the
level's length. A point carries a component of the signature and the unit cell of the level that it falls into, and
counts for a text whose weight covers the cell. A component keeps its earliest point, so two texts agree in one with a
probability that is their similarity. Points come in order of time and stop where the latest component is reached.

Texts with equal bags are one before anything is compared. The members of a band's bucket are compared with the
smallest and the largest of them first, which makes some n pairs of a group of n near copies. What is left are members
of one bucket in different classes. They meet in the cells of a grid over the bucket, as rows of a bounded number, and
leave a cell only as links that join two classes, so no pair that could join two is left out and none is listed
otherwise. Before bags are sent anywhere, signatures that agree in less than LIKELY of their components are dropped:
at a similarity of 0.8 that happens once in 20,000 pairs.

Edge cases: a text of fewer than five words is one run; texts without words (null and empty ones too) are equal. Rows
that share an id share a class. Documents without an id are left alone (class null). An empty table gives no rows. Only
the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathwarden.operators.components import components
from pathwarden.session import cut_lineage

SHINGLE = 5
SIMILARITY = 0.8
#: 25 bands of 5 components miss a pair of similarity 0.8 with a probability of 0.00005.
BANDS, ROWS = 25, 5
#: The share of equal components that a pair needs to be verified: 3.9 standard deviations below 0.8.
LIKELY = 0.66
#: Bags compared with one centre in one group of a task, and rows of a side of a cell, about. Any value gives the same classes.
LOT = 200
CELL = 700
#: Shingles sketched at once in a task.
BATCH_SHINGLES = 300_000

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
# Bytes of ASCII that are no letters or digits part words.
PARTS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Bags:
    """Turns texts into bags; remembers the hashes of words."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def shingles(self, text: str | None) -> np.ndarray:
        """The hash of each run of five words, in order of place."""
        words = (text or "").lower().encode().translate(PARTS).split()
        known = self.known
        if len(known) > 500_000:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh64_intdigest(word)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(SHINGLE, len(words))
        if not width:
            return hashes
        with np.errstate(over="ignore"):
            runs = np.zeros(len(words) - width + 1, np.uint64)
            for n in range(width):
                runs = (runs + hashes[n : n + len(runs)]) * GOLDEN
            return mix(runs + np.uint64(width))

    def bag(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The distinct runs, sorted, and how often each is there."""
        return np.unique(self.shingles(text), return_counts=True)

    def elements(self, text: str | None) -> np.ndarray:
        """The bag as a sorted set: the n-th time that a run is there is an element of its own."""
        runs, counts = self.bag(text)
        number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        with np.errstate(over="ignore"):
            return np.sort(mix(np.repeat(runs, counts) + number.astype(np.uint64) * GOLDEN))


def signatures(runs: np.ndarray, weights: np.ndarray, owner: np.ndarray, texts: int, size: int = BANDS * ROWS) -> np.ndarray:
    """BagMinHash of many bags at once: for each text the point (as 64 bits) that is the earliest in each component."""
    earliest = np.full((texts, size), np.inf)
    point = np.zeros((texts, size), np.uint64)
    latest = np.full(texts, np.inf)
    levels = 1 + np.ceil(np.log2(np.maximum(weights, 1))).astype(np.int64)
    level = np.arange(levels.sum()) - np.repeat(np.cumsum(levels) - levels, levels)
    owner, weight = np.repeat(owner, levels), np.repeat(weights, levels).astype(np.uint64)
    length = np.where(level > 0, np.uint64(1) << np.maximum(level - 1, 0).astype(np.uint64), np.uint64(1))
    begin = np.where(level > 0, length, np.uint64(0))
    low, half = np.uint64(0xFFFFFFFF), np.uint64(32)
    with np.errstate(over="ignore"):
        seed = mix(np.repeat(runs, levels) + (level.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95))
        time = np.zeros(len(seed))
        number = 0
        while len(seed):
            # The next point of each process that is not yet past its text's latest component.
            number += 2
            first = mix(seed + np.uint64(number) * GOLDEN)
            second = mix(seed + np.uint64(number + 1) * GOLDEN)
            time = time - np.log(((first >> np.uint64(11)).astype(float) + 1) * 2.0**-53) / (length * float(size))
            component = ((second >> half) * np.uint64(size) >> half).astype(np.int64)
            cell = begin + ((second & low) * length >> half)
            better = np.flatnonzero((cell < weight) & (time < earliest[owner, component]))
            # The earliest of several points for one place is written last.
            better = better[np.argsort(-time[better], kind="stable")]
            earliest[owner[better], component[better]] = time[better]
            point[owner[better], component[better]] = second[better]
            changed = np.unique(owner[better])
            latest[changed] = earliest[changed].max(1)
            alive = time < latest[owner]
            seed, time, owner, weight, length, begin = (x[alive] for x in (seed, time, owner, weight, length, begin))
    return point


def band_columns(band: int) -> range:
    """The components of a band, for its key and for the comparison of two signatures alike."""
    return range(band * ROWS, (band + 1) * ROWS)


def band_keys(point: np.ndarray) -> np.ndarray:
    """One key per band and text, different for each band."""
    columns = np.array([band_columns(band) for band in range(BANDS)])
    with np.errstate(over="ignore"):
        keys = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * np.uint64(0xA24BAED4963EE407)
        for row in range(ROWS):
            keys = mix(keys + point[:, columns[:, row]].astype(np.uint64) * GOLDEN)
    return keys


def sketches(docs: DataFrame) -> DataFrame:
    """(id, bag, bands, signature) for rows (id, text): a digest of the bag, the keys of its bands (none for texts without
    words), and 16 bits of each component."""
    schema = pa.schema([("id", pa.int64()), ("bag", pa.binary()), ("bands", pa.list_(pa.int64())), ("signature", pa.binary())])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bags = Bags()
        for batch in batches:
            ids, found, total = [], [], 0
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(id_)
                found.append(bags.bag(text.as_py()))
                total += len(found[-1][0])
                if total >= BATCH_SHINGLES:
                    yield packed(ids, found)
                    ids, found, total = [], [], 0
            if ids:
                yield packed(ids, found)

    def packed(ids: list, found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        sizes = [len(runs) for runs, _ in found]
        runs, weights = (np.concatenate(x) for x in zip(*found, strict=True))
        point = signatures(runs, weights, np.repeat(np.arange(len(ids)), sizes), len(ids))
        # Bands are of the bits that are kept, so two signatures agree in a band exactly where their keys do.
        kept = (point >> np.uint64(20)).astype(np.uint16)
        keys = band_keys(kept).view(np.int64)
        digests = [xxhash.xxh3_128_digest(r.tobytes() + w.astype(np.int64).tobytes()) for r, w in found]
        columns = [ids, digests, [k if n else [] for k, n in zip(keys, sizes, strict=True)], [row.tobytes() for row in kept]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return docs.select("id", "text").mapInArrow(sketch, "id long, bag binary, bands array<long>, signature binary")


def elements_of(text: Column) -> Column:
    """The bag of each text as a sorted set."""

    @F.arrow_udf("array<long>")
    def elements(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bags = Bags()
        for part in parts:
            yield pa.array([bags.elements(t.as_py()).view(np.int64) for t in part], pa.list_(pa.int64()))

    return elements(text)


def sent_bags(docs: DataFrame, routes: DataFrame) -> DataFrame:
    """The bag of each text with each of its routes, rows (id, route). A text is read and cut up once for all of them."""
    routes = cut_lineage(routes.groupBy("id").agg(F.collect_list("route").alias("routes")))
    # A plain shuffle at any size: routes grow with the documents.
    sent = docs.join(routes.hint("merge"), "id").select("id", elements_of(F.col("text")).alias("bag"), "routes")
    return sent.select("id", "bag", F.explode("routes").alias("route")).select("id", "bag", "route.*")


def likely(pairs: DataFrame, signatures_: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures agree well enough to be verified."""

    @F.arrow_udf("boolean")
    def alike(a: pa.Array, b: pa.Array) -> pa.Array:
        left, right = (np.frombuffer(b"".join(x.to_pylist()), np.uint16).reshape(len(x), -1) for x in (a, b))
        return pa.array((left == right).mean(1) >= LIKELY if len(a) else [], pa.bool_())

    for side in ("a", "b"):
        pairs = pairs.join(signatures_.select(F.col("id").alias(side), F.col("signature").alias(f"of_{side}")), side)
    return pairs.where(alike("of_a", "of_b")).select("a", "b")


def similarity_of(a: np.ndarray, b: np.ndarray) -> float:
    """The weighted Jaccard similarity of two bags as sorted sets."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small):
        return 0.0
    both = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
    return both / (len(a) + len(b) - both)


def _bags_of(table: pa.Table) -> list[np.ndarray]:
    return [np.asarray(bag.values).view(np.uint64) for bag in table.column("bag")]


def verified(docs: DataFrame, pairs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose bags overlap enough, for rows (id, text) and distinct pairs.

    The bag of b is sent to a, in lots: the bag of a goes to each of them.
    """
    loads = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / LOT).cast("long").alias("lots"))
    lot = F.pmod(F.xxhash64("b"), F.col("lots")).cast("long")
    to_centre = pairs.join(loads, "a").select(F.col("b").alias("id"), F.struct("a", lot.alias("lot")).alias("route"))
    lots = F.explode(F.sequence(F.lit(0).cast("long"), F.col("lots") - 1))
    own = loads.withColumn("lot", lots).select(F.col("a").alias("id"), F.struct("a", "lot").alias("route"))

    def compare(lot: pa.Table) -> pa.Table:
        centre = lot.column("a")[0].as_py()
        ids, bags = lot.column("id").to_pylist(), _bags_of(lot)
        own = bags[ids.index(centre)]
        close = [id_ for id_, bag in zip(ids, bags, strict=True) if id_ != centre and similarity_of(own, bag) >= similarity]
        return pa.table({"a": pa.array([centre] * len(close), pa.int64()), "b": pa.array(close, pa.int64())})

    return sent_bags(docs, to_centre.unionByName(own)).groupBy("a", "lot").applyInArrow(compare, "a long, b long").distinct()


def agreeing(signatures_: np.ndarray, others: np.ndarray, band: np.ndarray) -> np.ndarray:
    """Share of equal components of each pair of two sides; 0 where the two share a band before `band`, as they met there."""
    equal = np.zeros((len(signatures_), len(others)), np.uint8)
    before = np.zeros(equal.shape, bool)
    for number in range(BANDS):
        whole = np.ones(equal.shape, bool)
        for column in band_columns(number):
            same = signatures_[:, column][:, None] == others[:, column][None, :]
            equal += same
            whole &= same
        if number < band:
            before |= whole
    return np.where(before, 0, equal / (BANDS * ROWS))


def leftover_links(docs: DataFrame, placed: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links (a, b) between classes for the members of buckets that hold several: rows (bucket, band, id, class, signature).

    A bucket of n members is a grid of cells, each with two of its n / CELL parts. A cell first tells which of its members
    have a likely partner in another class; only their bags are sent, and pairs are verified there, the likeliest first,
    until two classes are one.
    """
    sizes = placed.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / CELL).cast("int").alias("parts"))
    rows = placed.join(sizes, "bucket").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cell = [F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y")]
    rows = rows.select("bucket", *cell, "part", "band", "id", "class", "signature")

    def sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        part = np.array(table.column("part").to_pylist())
        x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
        return np.flatnonzero(part == x), np.flatnonzero(part == y), np.array(table.column("class").to_pylist(), np.int64)

    def worth(table: pa.Table, left: np.ndarray, right: np.ndarray, group: np.ndarray) -> np.ndarray:
        signature = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint16).reshape(len(table), -1)
        share = agreeing(signature[left], signature[right], table.column("band")[0].as_py())
        share[(group[left][:, None] == group[right][None, :]) | (share < LIKELY)] = 0
        return share

    def partnered(table: pa.Table) -> pa.Table:
        left, right, group = sides(table)
        share = worth(table, left, right, group)
        return table.take(np.unique(np.concatenate([left[share.any(1)], right[share.any(0)]])))

    kinds = "bucket long, x int, y int, part int, band int, id long, class long, signature binary"
    wanted = cut_lineage(rows.groupBy("bucket", "x", "y").applyInArrow(partnered, kinds))

    def link(table: pa.Table) -> pa.Table:
        left, right, group = sides(table)
        share = worth(table, left, right, group)
        ids, bags = table.column("id").to_pylist(), _bags_of(table)
        root = {g: g for g in group.tolist()}

        def find(g: int) -> int:
            while root[g] != g:
                root[g] = g = root[root[g]]
            return g

        found = []
        i, j = np.nonzero(share)
        for n in np.argsort(-share[i, j], kind="stable").tolist():
            a, b = int(left[i[n]]), int(right[j[n]])
            first, second = find(int(group[a])), find(int(group[b]))
            if first != second and similarity_of(bags[a], bags[b]) >= similarity:
                root[max(first, second)] = min(first, second)
                found.append((ids[a], ids[b]))
        columns = zip(*found, strict=True) if found else ([], [])
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip("ab", columns, strict=True)})

    routes = wanted.select("id", F.struct("bucket", "x", "y", "part", "band", "class", "signature").alias("route"))
    return sent_bags(docs, routes).groupBy("bucket", "x", "y").applyInArrow(link, "a long, b long")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: key, class_id (the smallest key it is linked to by a chain of links), same_bag (the smallest with an equal bag)."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    sketched = cut_lineage(sketches(rows))
    named = sketched.where("id is not null")
    # Equal bags are one from here on.
    firsts = named.groupBy("bag").agg(F.min("id").alias("id"))
    chosen = cut_lineage(named.join(firsts, ["bag", "id"], "left_semi").dropDuplicates(["id"]))
    members = cut_lineage(chosen.select("id", F.posexplode("bands").alias("band", "bucket")))
    ends = members.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    meet = members.join(ends, "bucket")
    pairs = meet.select(F.col("low").alias("a"), F.col("id").alias("b")).where("a < b")
    pairs = pairs.unionByName(meet.select(F.col("high").alias("a"), F.col("id").alias("b")).where("b < a and b > low")).distinct()
    links = cut_lineage(verified(rows, cut_lineage(likely(pairs, chosen)), similarity))
    grouped = cut_lineage(components(links))

    # What is left: members of one bucket in different classes.
    placed = members.join(grouped, "id", "left").withColumn("class", F.coalesce("component", "id")).drop("component")
    split = placed.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high").select("bucket")
    placed = placed.join(split, "bucket", "left_semi").join(chosen.select("id", "signature"), "id")
    more = cut_lineage(leftover_links(rows, placed, similarity))
    final = grouped if more.isEmpty() else components(links.unionByName(more))

    first = firsts.select("bag", F.col("id").alias("same_bag"))
    result = sketched.select("id", "bag").join(first, "bag", "left").join(final.withColumnRenamed("id", "same_bag"), "same_bag", "left")
    alone = F.col("id").isNull()
    return result.select(
        F.col("id").alias(key),
        F.when(~alone, F.coalesce("component", "same_bag")).alias("class_id"),
        F.when(~alone, F.col("same_bag")).alias("same_bag"),
    )


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The documents whose id is that of their class, each once, and those without an id; with the columns they came with."""
    found = classes(docs, key, text, similarity)
    first = found.where(F.col("class_id") == F.col(key)).select(F.col("class_id").alias("_first")).distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    packed = docs.select(F.col(f"`{key}`").cast("long").alias("_id"), row.alias("_row"))
    kept = packed.join(first, F.col("_id") == F.col("_first"), "left").where("_first is not null or _id is null")
    number = F.when(F.col("_id").isNull(), F.monotonically_increasing_id())
    return kept.withColumn("_number", number).dropDuplicates(["_id", "_number"]).select("_row.*")
