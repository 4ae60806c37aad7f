"""Cosine similarity between rows that carry a vector."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.feature import HashingTF, NGram, Normalizer, RegexTokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathwarden.functions.paths import strip_own_code
from pathwarden.functions.text import bucket_level_name, compose_text
from pathwarden.operators.grouping import seed_members
from pathwarden.operators.rows import drop_groups, outside_root, tag_constant
from pathwarden.operators.text_blocks import task_count
from pathwarden.session import cut_lineage

#: Parts of rows that meet in tasks: their least rows, how many there are before they grow, and their numbers at most.
CHUNK_ROWS = 2_000
PARTS = 12
CHUNK_NUMBERS = 2_000_000
#: The pairs that a task may find, about, and the products that it holds at once.
TASK_PAIRS = 4_000_000
TASK_PRODUCTS = 4_000_000
#: Cells grow with the square root of the rows up to this; the centres of all of them fit in any task.
MAX_CENTRES = 16_384
#: Numbers in the table of bounds that every task gets: cells times the centres they are bounded by.
TABLE = 4_000_000
#: Below any product of rows, in place of one with a cell that has no rows.
EMPTY = -1e9
#: Rows that a task measures against all centres at once.
SLICE_ROWS = 1_024
#: Cells are used if the sample needs at most this share of all comparisons.
WORTHWHILE = 0.9
SLACK = 1e-6


def with_unit(df: DataFrame, vector: str, name: str) -> DataFrame:
    """Add the vector in doubles at length 1 (a zero vector stays zero); rows without a vector are left out."""
    dense = df.where(F.col(vector).isNotNull()).withColumn("_dense", array_to_vector(F.col(vector)))
    scaled = Normalizer(inputCol="_dense", outputCol="_scaled").transform(dense)
    return scaled.withColumn(name, vector_to_array("_scaled")).drop("_dense", "_scaled")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def encode_text(df: DataFrame, text: str = "text", vector: str = "vector", size: int = 256) -> DataFrame:
    """A vector per text from hashed character trigrams, for tables without model vectors."""
    letters = RegexTokenizer(inputCol=text, outputCol="_letters", pattern="", toLowercase=True, minTokenLength=1)
    grams = NGram(n=3, inputCol="_letters", outputCol="_grams")
    hashed = HashingTF(numFeatures=size, inputCol="_grams", outputCol="_hashed")
    scaled = Normalizer(inputCol="_hashed", outputCol="_scaled")
    result = df
    for stage in (letters, grams, hashed, scaled):
        result = stage.transform(result)
    return result.withColumn(vector, vector_to_array("_scaled", "float32")).drop("_letters", "_grams", "_hashed", "_scaled")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


@dataclass(frozen=True)
class Cells:
    """Cells of rows around centres, with what bounds a product with any row of a cell.

    `highest` has, for each cell, the highest product of its rows with each of the first centres, `radius` how far the
    farthest of them is from the cell's own centre.
    """

    centres: np.ndarray
    highest: np.ndarray
    radius: np.ndarray

    def distances(self, u: np.ndarray, first: int | None = None) -> np.ndarray:
        """The squared distance of each row to each centre (or the first ones), less the row's own square."""
        centres = self.centres[:first]
        return (centres * centres).sum(1)[None, :] - 2 * u @ centres.T

    def homes(self, u: np.ndarray) -> np.ndarray:
        """The cell of each row: that of the nearest centre."""
        return self.distances(u).argmin(axis=1)

    def unbounded(self) -> Cells:
        """With the bounds of cells without rows, which no row can match."""
        return replace(self, highest=np.full_like(self.highest, EMPTY), radius=np.zeros(len(self.centres)))

    def widen(self, u: np.ndarray, home: np.ndarray) -> None:
        """Raise the bounds, in place, to hold for these rows too."""
        np.maximum.at(self.highest, home, u @ self.centres[: self.highest.shape[1]].T)
        np.maximum.at(self.radius, home, np.linalg.norm(u - self.centres[home], axis=1))

    def reachable(self, u: np.ndarray, home: np.ndarray, threshold: float) -> np.ndarray:
        """Whether a cell may hold a row of a product above the threshold, by two bounds, for each row and cell.

        Written as its nearest first centre g and a rest, a row x has with a row y of the cell of centre c the product
        y.g + (x - g).c + (x - g).(y - c): at most the highest y.g of the cell, one product, and one of two lengths.
        And a row nearer to its own centre than to c by more than the reach, measured across the plane between the two,
        has no match at home in c.
        """
        nearest = self.distances(u, self.highest.shape[1]).argmin(axis=1)
        rest = u - self.centres[nearest]
        most = self.highest.T[nearest] + rest @ self.centres.T + np.linalg.norm(rest, axis=1)[:, None] * self.radius[None, :]
        distance = self.distances(u)
        nearer = distance - distance[np.arange(len(u)), home][:, None]
        own = self.centres[home]
        between = np.sqrt(np.maximum((own * own).sum(1)[:, None] + self.distances(own), 0))
        reach = np.sqrt(2 - 2 * threshold) + SLACK
        return (most > threshold - SLACK) & (nearer <= 2 * reach * between + SLACK)


def _far_apart(sample: np.ndarray, wanted: int) -> np.ndarray:
    """Rows of the sample, each the farthest from those before it, so that every cluster gets a centre."""
    squares = (sample * sample).sum(1)
    picked, far = [0], np.full(len(sample), np.inf)
    while len(picked) < min(wanted, len(sample)):
        far = np.minimum(far, squares + squares[picked[-1]] - 2 * sample @ sample[picked[-1]])
        far[picked[-1]] = -np.inf
        picked.append(int(far.argmax()))
    return sample[picked]


def _sampled(nodes: DataFrame, rows: int) -> np.ndarray:
    """A bounded sample of the rows, the same one on every run."""
    picked = nodes.orderBy(F.xxhash64("id"), "id").limit(min(MAX_CENTRES, 8 * max(2, int(np.sqrt(rows))))).select("u").collect()
    return np.array([row["u"] for row in picked])


def _cells(nodes: DataFrame, threshold: float, rows: int, sample: np.ndarray | None = None) -> Cells | None:
    """Cells around centres from a bounded sample, the same one on every run; None if the sample needs about all comparisons.

    Neither the choice of the centres nor that of using cells touches the result.
    """
    wanted = min(MAX_CENTRES, int(np.sqrt(rows)))
    if wanted < 2:
        return None
    sample = np.unique(_sampled(nodes, rows) if sample is None else sample, axis=0)
    centres = _far_apart(sample, wanted)
    count = len(centres)
    cells = Cells(centres, np.zeros((count, min(count, TABLE // count))), np.zeros(count))
    home = cells.homes(sample)
    # The middle of the rows near a centre has them closer to it than a row of their rim has.
    middles = np.zeros_like(centres)
    np.add.at(middles, home, sample)
    size = np.bincount(home, minlength=count)
    cells = replace(cells, centres=np.where(size[:, None] > 0, middles / np.maximum(size, 1)[:, None], centres))

    home = cells.homes(sample)
    tried = cells.unbounded()
    tried.widen(sample, home)
    inside = np.bincount(home, minlength=count)
    probes = slice(None, None, -(-len(sample) // SLICE_ROWS))
    lower = np.arange(count)[None, :] < home[probes][:, None]
    visits = tried.reachable(sample[probes], home[probes], threshold) & lower
    compared = (visits * inside[None, :]).sum() + inside[home[probes]].sum() / 2
    return cells if compared <= WORTHWHILE * len(home[probes]) * len(sample) / 2 else None


def _at_home(nodes: DataFrame, cells: Cells | None) -> DataFrame:
    """Rows with their cell (`home`), stored once: later steps must agree on it."""
    if cells is None:
        return nodes.withColumn("home", F.lit(0))

    @F.pandas_udf("int")
    def home(vectors: pd.Series) -> pd.Series:
        slices = (np.stack(vectors.iloc[low : low + SLICE_ROWS].to_numpy()) for low in range(0, len(vectors), SLICE_ROWS))
        return pd.Series(np.concatenate([cells.homes(u) for u in slices]).astype("int32"))

    return cut_lineage(nodes.select("id", "u", home("u").alias("home")))


def _measured(cells: Cells, placed: DataFrame) -> Cells:
    """The cells with the bounds of all their rows: a table of at most TABLE numbers a task, made one by Spark."""

    def extremes(batches):
        own, seen = cells.unbounded(), set()
        for batch in batches:
            for low in range(0, len(batch), SLICE_ROWS):
                part = batch.iloc[low : low + SLICE_ROWS]
                home = part["home"].to_numpy()
                own.widen(np.stack(part["u"].to_numpy()), home)
                seen.update(home.tolist())
        for h in sorted(seen):
            yield pd.DataFrame({"home": [h], "radius": [own.radius[h]], "highest": [own.highest[h]]})

    parts = placed.select("home", "u").mapInPandas(extremes, "home int, radius double, highest array<double>")
    merged = parts.groupBy("home").agg(
        F.max("radius").alias("radius"), vector_to_array(Summarizer.max(array_to_vector(F.col("highest")))).alias("highest")
    )
    whole = cells.unbounded()
    for row in merged.collect():
        whole.highest[row["home"]], whole.radius[row["home"]] = row["highest"], row["radius"]
    return whole


def _chunk(sample: np.ndarray, threshold: float, rows: int) -> int:
    """The rows of a part: a share of all rows, so that copies grow with the rows alone, while a task can hold two parts and its pairs."""
    if not len(sample):
        return CHUNK_ROWS
    some = sample[:SLICE_ROWS]
    share = max((some @ some.T > threshold).mean() - 1 / len(some), 1e-9)
    most = min(CHUNK_NUMBERS // max(1, sample.shape[1]), int(np.sqrt(TASK_PAIRS / share)))
    return max(CHUNK_ROWS, min(-(-rows // PARTS), most))


@dataclass(frozen=True)
class Parts:
    """Rows (id, u, home, part) by parts of about `chunk` rows, and for each cell its first part and their number.

    A part has whole cells that follow each other, or a share of one larger cell.
    """

    rows: DataFrame
    first: np.ndarray
    number: np.ndarray
    total: int


def _in_parts(placed: DataFrame, cells: Cells | None, chunk: int) -> Parts:
    """There are at most MAX_CENTRES cells, so their sizes fit anywhere."""
    count = 1 if cells is None else len(cells.centres)
    first, number, part, held = np.zeros(count, int), np.ones(count, int), 0, 0
    sizes = dict(placed.groupBy("home").count().collect())
    for cell in range(count):
        size = sizes.get(cell, 0)
        if held and held + size > chunk:
            part, held = part + 1, 0
        first[cell], number[cell] = part, max(1, -(-size // chunk))
        held += size
        if size > chunk:
            part, held = part + int(number[cell]), 0
    total = part + 1 if held or not part else part
    known = placed.sparkSession.createDataFrame([(c, int(first[c]), int(number[c])) for c in range(count)], "home int, _first int, _number int")
    part_of = (F.col("_first") + F.pmod(F.xxhash64("id"), F.col("_number"))).cast("int").alias("part")
    return Parts(placed.join(F.broadcast(known), "home").select("id", "u", "home", part_of), first, number, total)


def _probes(probing: Parts, indexed: Parts, cells: Cells | None, threshold: float, own: bool) -> DataFrame:
    """Rows (id, u, home, x, y, cells): for each part `y` that may hold matches, the cells they may be at home in.

    Cells are those below the row's own that its bounds allow, and its own one if `own`. Within one side, parts of the own
    cell are those up to the row's.
    """
    within, first_of, number_of = probing is indexed, indexed.first, indexed.number

    @F.pandas_udf("array<struct<y: int, cells: array<int>>>")
    def visits(vectors: pd.Series, homes: pd.Series, parts: pd.Series) -> pd.Series:
        lists = []
        for low in range(0, len(vectors), SLICE_ROWS):
            home, part = homes.iloc[low : low + SLICE_ROWS].to_numpy(), parts.iloc[low : low + SLICE_ROWS].to_numpy()
            if cells is not None:
                near = cells.reachable(np.stack(vectors.iloc[low : low + SLICE_ROWS].to_numpy()), home, threshold)
            for k, (h, x) in enumerate(zip(home, part)):
                met = {}
                for cell in [*(np.flatnonzero(near[k, :h]) if cells is not None else []), *([h] if own else [])]:
                    last = first_of[cell] + number_of[cell] - 1
                    for y in range(first_of[cell], (min(last, x) if within and cell == h else last) + 1):
                        met.setdefault(y, []).append(int(cell))
                lists.append([{"y": int(y), "cells": found} for y, found in met.items()])
        return pd.Series(lists)

    seen = probing.rows.select("id", "u", "home", F.col("part").alias("x"), F.explode(visits("u", "home", "part")).alias("_seen"))
    return seen.select("id", "u", "home", "x", F.col("_seen.y").alias("y"), F.col("_seen.cells").alias("cells"))


def _indexed(indexed: Parts, probing: Parts, within: bool) -> DataFrame:
    """The rows of each part `y`, once for each part `x` that may probe it."""
    xs = F.sequence(F.col("part") if within else F.lit(0), F.lit(probing.total - 1))
    return indexed.rows.select("id", "u", "home", F.explode(xs).alias("x"), F.col("part").alias("y"))


def compared_blocks(
    left: DataFrame, right: DataFrame | None, threshold: float, chunk: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """The two sides (kind, cell, x, y, id, u, home, cells) of the block products that hold all pairs above the threshold, each once.

    Part y of the first side is probed by those rows of part x of the second that may match one at home in it; their
    `cells` tell where. Rows probe their own cell and lower ones (kind 0); across two sides the rows of the right one
    probe the lower cells of the left one too (kind 1). A row has a copy for each part at most, and there are few parts.
    """
    wider = left if right is None else right
    count = wider.count()
    sample = _sampled(wider, count)
    cells = _cells(wider, threshold, count, sample)
    chunk = chunk or _chunk(sample, threshold, count)
    sides = [_at_home(side, cells).select("id", "u", F.col("home").cast("int").alias("home")) for side in ([left] if right is None else [left, right])]
    if cells is not None:
        cells = _measured(cells, _union([side.select("home", "u") for side in sides]))
    parts = [_in_parts(side, cells, chunk) for side in sides]
    grids = [(_indexed(parts[-1], parts[0], right is None), _probes(parts[0], parts[-1], cells, threshold, True))]
    if right is not None and cells is not None:
        grids.append((_indexed(parts[0], parts[1], False), _probes(parts[1], parts[0], cells, threshold, False)))
    fields = ["x", "y", "id", "u", "home"]
    # Fresh names for both sides: they may stem from the same table.
    named = lambda rows, kind, more: rows.select(
        F.lit(kind).alias("kind"), F.lit(0).alias("cell"), *[F.col(f).alias(f) for f in fields], more.alias("cells")
    )
    first = _union([named(one, kind, F.array(F.col("home"))) for kind, (one, _) in enumerate(grids)])
    return first, _union([named(two, kind, F.col("cells")) for kind, (_, two) in enumerate(grids)])


def _products(a: pd.DataFrame, b: pd.DataFrame, threshold: float):
    """Places in both, the cell and the product, of the pairs above the threshold: b's rows meet those of a at home in their cells."""
    one, two = np.stack(a["u"].to_numpy()), np.stack(b["u"].to_numpy())
    home, seen = a["home"].to_numpy(), np.concatenate(b["cells"].to_numpy())
    prober = np.repeat(np.arange(len(b)), b["cells"].map(len).to_numpy())
    # Both in the order of cells, so that those of a cell stand together.
    rows, visits = np.argsort(home, kind="stable"), np.argsort(seen, kind="stable")
    for cell in np.intersect1d(home, seen):
        i = rows[slice(*np.searchsorted(home[rows], [cell, cell + 1]))]
        j = prober[visits[slice(*np.searchsorted(seen[visits], [cell, cell + 1]))]]
        step = max(1, TASK_PRODUCTS // len(i))
        for low in range(0, len(j), step):
            product = one[i] @ two[j[low : low + step]].T
            p, q = np.nonzero(product > threshold)
            yield i[p], j[low + q], np.full(len(p), cell), product[p, q]


def cosine_pairs(
    left: DataFrame,
    right: DataFrame | None = None,
    *,
    threshold: float,
    id: str = "id",
    vector: str = "vector",
    chunk: int | None = None,
) -> DataFrame:
    """Pairs (a, b, cosine) above the threshold, a < b: within `left`, or across two sides with no shared id.

    Exact at any threshold. Rows meet in the cells that may hold a match only. Cells stand together in parts and each pair
    of parts is one task, so no task holds more than two parts and only pairs above the threshold leave it.
    """

    def prepared(df):
        nodes = with_unit(df.select(F.col(id).alias("id"), F.col(vector).alias("_v")), "_v", "u").select("id", "u")
        return nodes.where(F.exists("u", lambda x: x != 0)) if threshold >= 0 else nodes

    within = right is None
    first, second = compared_blocks(prepared(left), None if within else prepared(right), threshold, chunk)

    def product(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(a) and len(b):
            ids_a, ids_b, homes = a["id"].to_numpy(), b["id"].to_numpy(), b["home"].to_numpy()
            for i, j, cell, values in _products(a, b, threshold):
                one, two = ids_a[i], ids_b[j]
                # Rows of one cell and part meet in both orders.
                keep = (one < two) | (homes[j] != cell) if within and key[2] == key[3] else slice(None)
                found.append((np.minimum(one, two)[keep], np.maximum(one, two)[keep], values[keep]))
        return pd.DataFrame(dict(zip(("a", "b", "cosine"), (np.concatenate(part) for part in zip(*found)))))

    keys = ["kind", "cell", "x", "y"]
    return (
        first.groupBy(*keys).cogroup(second.groupBy(*keys)).applyInPandas(product, "a bigint, b bigint, cosine double")
    )


def semantic_groups(df: DataFrame, threshold: float = 0.98, id: str = "row_id", vector: str = "vector", **options) -> DataFrame:
    """Groups (seed, id): a row that no earlier group holds, and all rows similar to it.

    A row can be in several groups. Equal vectors are one node while grouping.
    """
    # A digest of 128 bits stands for a vector, so that vectors are neither sorted nor joined.
    keys = [F.xxhash64(F.lit(k), F.col(vector)).alias(f"_key{k}") for k in (0, 1)]
    rows = cut_lineage(df.select(F.col(id).alias("id"), *keys, F.col(vector).alias("vector")))
    rows, keys = rows.where(F.exists("vector", lambda x: x != 0)), ["_key0", "_key1"]
    copies = rows.groupBy(*keys).agg(F.min("id").alias("first"), F.count("*").alias("n"))
    distinct = rows.join(copies.select(*keys, F.col("first").alias("id")), [*keys, "id"], "left_semi").dropDuplicates([*keys, "id"])
    nodes = distinct.select(F.lit(0).alias("block"), "id", "vector")

    def find(left, right=None):
        return cosine_pairs(left, right, threshold=threshold).select(F.lit(0).alias("block"), "a", "b")

    grouped = seed_members(nodes, find, all_neighbours=True, **options)
    # Copies follow their first row; a seed without neighbours is a group if it has copies.
    alone = copies.where(F.col("n") > 1).select(F.col("first").alias("id"))
    lone = alone.join(grouped.select("id").distinct(), "id", "left_anti").select(F.col("id").alias("seed"), "id")
    placed = grouped.select("seed", "id").unionByName(lone).withColumnRenamed("id", "first")
    keyed = placed.join(copies.select(*keys, "first"), "first")
    return rows.select("id", *keys).join(keyed, keys).select("seed", "id")


def drop_repeats(groups: DataFrame) -> DataFrame:
    """Each row in its earliest group only."""
    return groups.groupBy("id").agg(F.min("seed").alias("seed")).select("seed", "id")


def semantic_text(df: DataFrame) -> DataFrame:
    """Paths without the own code, and the text that stands for a row when comparing meanings."""
    columns = [F.col(c) for c in ("NAME", "OFFICIAL_LEVEL_NAME", "PARENT", "LEVEL_NUMBER")]
    stripped = df.withColumn("HIERARCHY", strip_own_code(F.col("HIERARCHY"), F.col("CODE")))
    return stripped.withColumn("text", compose_text(columns, " - "))


def semantic_duplicates(
    df: DataFrame, threshold: float = 0.98, order: str = "row_id", vector: str | None = None, repeats: bool = True, **options
) -> DataFrame:
    """The rows of all semantic groups with the `group` they are in, one row per place.

    Without a vector column the text is encoded. `repeats=False` lists a row once.
    """
    if vector is None:
        # As in `semantic_outliers`, encoding is much work on few bytes.
        df = df.repartition(task_count(df.sparkSession))
    described = semantic_text(df)
    encoded = encode_text(described, "text", "_vector") if vector is None else described.withColumn("_vector", F.col(vector))
    groups = semantic_groups(encoded, threshold, order, "_vector", **options)
    groups = groups if repeats else drop_repeats(groups)
    places = groups.select(F.col("id").alias(order), F.col("seed").alias("group"))
    return described.drop("text").join(places, [order])


def mean_similarity(df: DataFrame, vector: str = "vector", name: str = "mean_similarity") -> DataFrame:
    """Add a row's mean cosine with all rows that have a vector, itself included; null without a vector.

    The mean of the products is the product with the mean, so one aggregate gives the
    centre and each row is one product: linear, where the full matrix is quadratic.
    """
    units = with_unit(df, vector, "_u")
    centre = units.agg(vector_to_array(Summarizer.mean(array_to_vector(F.col("_u")))).alias("c"))
    centred = units.withColumn("_centre", centre.scalar())
    measured = centred.withColumn(name, dot(F.col("_u"), F.col("_centre"))).drop("_u", "_centre")
    return measured.unionByName(df.where(F.col(vector).isNull()).withColumn(name, F.lit(None).cast("double")))


def semantic_outliers(df: DataFrame, below: float = 0.27, vector: str | None = None) -> DataFrame:
    """Non-group rows outside the root, then those whose mean similarity is low; `reason` tells which.

    A row can be listed under both reasons.
    """
    rows = drop_groups(df.withColumn("LEVEL_NAME", bucket_level_name(F.col("LEVEL_NAME"))))
    if vector is None:
        # Encoding is much work on few bytes: a small file must not be one task's, nor a filter move back into it.
        rows = cut_lineage(rows.repartition(task_count(df.sparkSession)))
    outside = tag_constant(outside_root(rows), reason="outside root")
    text = compose_text([F.col(c) for c in ("NAME", "HIERARCHY", "LEVEL_NAME")])
    encoded = encode_text(rows.withColumn("text", text), "text", "_vector") if vector is None else rows.withColumn("_vector", F.col(vector))
    measured = mean_similarity(encoded, "_vector", "_mean").where(F.col("_mean") < below)
    far = tag_constant(measured.select(*rows.columns), reason="low similarity")
    return outside.unionByName(far)
