"""Repeated passages by content-defined chunks: a gear rolling hash cuts each text, chunks with one digest are one chunk.

The hash of a place covers the 16 bytes up to it, so where a text may be cut depends on its own bytes nearby: inserted
text moves the cuts next to it and no others. A chunk that stands in a document with a smaller id is a copy. Runs of
neighbouring copies of at least LEAST_RUN bytes are repeated passages; single short chunks, which clean texts share by
chance, stay. What goes is cut back to whole words, or to whole characters where a word is longer than LONGEST_CUT.

Chunks meet by digest, packed by the batch. What a batch of documents has several times it decides itself and sends for its
smallest document alone, so a chunk that a third of all documents share is one entry per batch.

Edge cases: null and empty texts have no chunks and stay as they are. Rows that share an id are one document, whose
text does not repeat itself. Documents with a null id come after all others and repeat each other's passages in none. An
empty table gives an empty result. Other columns stay as they are and may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathwarden.llm.packing import BUCKET_BYTES, buckets_for, ddl_of, home_column, home_of, pack, read_packed, split_rows, table_of

#: A chunk is LEAST_CHUNK to MOST_CHUNK bytes long, LEAST_CHUNK + 2 ** BITS on average.
LEAST_CHUNK, MOST_CHUNK, BITS = 16, 128, 4
#: Bytes of neighbouring copies that make a passage.
LEAST_RUN = 96
#: Bytes at the end of a passage that stay so that a word is whole, an average chunk; scripts without spaces have longer ones.
LONGEST_CUT = LEAST_CHUNK + 2**BITS

#: Chunks that a task compares at once. Any value gives the same result.
BATCH_CHUNKS = 200_000
DIGEST = np.dtype([("high", np.uint64), ("low", np.uint64)])

_rng = np.random.default_rng(20240229)
GEAR = _rng.integers(0, 1 << 16, 256, dtype=np.uint16)
SPACES = b" \t\n\v\f\r"


def may_cut(data: np.ndarray) -> np.ndarray:
    """Places after which a chunk may end. A gear hash: each byte shifts the ones before it out, after 16 they are gone."""
    rolled = GEAR[data]
    for size in (1, 2, 4, 8):
        rolled[size:] += rolled[:-size] << size
    # The top bits hold all 16 bytes.
    return np.flatnonzero(rolled >> (16 - BITS) == 0) + 1


def chunk_ends(data: bytes) -> list[int]:
    """The end of each chunk of a text."""
    ends: list[int] = []
    last, size = 0, len(data)
    for place in may_cut(np.frombuffer(data, np.uint8)).tolist():
        if place - last < LEAST_CHUNK:
            continue
        while place - last > MOST_CHUNK:
            last += MOST_CHUNK
            ends.append(last)
        if place - last >= LEAST_CHUNK:
            ends.append(place)
            last = place
    while size - last > MOST_CHUNK:
        last += MOST_CHUNK
        ends.append(last)
    if last < size:
        ends.append(size)
    return ends


COPIES = pa.schema([("bucket", pa.int32()), ("told", pa.bool_()), ("count", pa.int32()), ("digests", pa.binary()), ("ids", pa.binary()), ("firsts", pa.binary()), ("ends", pa.binary())])
HOMES = pa.schema([("bucket", pa.int32()), ("count", pa.int32()), ("ids", pa.binary()), ("firsts", pa.binary()), ("ends", pa.binary())])


def chunk_rows(ids: list, texts) -> Iterator[tuple[np.ndarray, ...]]:
    """(id, first, end, digest) of the chunks of texts, in batches of documents with an id."""
    rows: list[list] = [[], [], [], []]
    for id_, text in zip(ids, texts, strict=True):
        data = (text.as_py() or "").encode() if id_ is not None else b""
        ends = chunk_ends(data)
        firsts = [0, *ends[:-1]] if ends else []
        rows[0] += [id_] * len(ends)
        rows[1] += firsts
        rows[2] += ends
        rows[3] += [hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in zip(firsts, ends, strict=True)]
        if len(rows[0]) >= BATCH_CHUNKS:
            yield *(np.array(x, np.int64) for x in rows[:3]), np.frombuffer(b"".join(rows[3]), DIGEST)
            rows = [[], [], [], []]
    if rows[0]:
        yield *(np.array(x, np.int64) for x in rows[:3]), np.frombuffer(b"".join(rows[3]), DIGEST)


def _by_digest(ids: np.ndarray, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by digest, then id; and for each row in it the smallest id with its digest."""
    order = np.lexsort((ids, digests["low"], digests["high"]))
    sorted_ = digests[order]
    head = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
    return order, np.repeat(ids[order][head], np.diff(np.append(head, len(order))))


def chunk_keys(docs: DataFrame, buckets: int) -> DataFrame:
    """Packed chunks of rows (id, text) by bucket of their digest. Of the documents of a batch that share a chunk only the
    smallest sends it; the others' are copies already (`told`) and go to the home of their id."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, first, end, digests in chunk_rows(batch.column(0).to_pylist(), batch.column(1)):
                order, smallest = _by_digest(ids, digests)
                copy = ids[order] > smallest
                rows = []
                for b, at in split_rows((digests["low"][order[~copy]] % np.uint64(buckets)).astype(np.int64)):
                    at = np.sort(order[~copy][at])
                    rows.append((b, False, len(at), pack(digests[at].view(np.uint8)), pack(ids[at]), pack(first[at]), pack(end[at])))
                for b, at in split_rows(home_of(ids[order[copy]], buckets)):
                    at = np.sort(order[copy][at])
                    rows.append((b, True, len(at), b"", pack(ids[at]), pack(first[at]), pack(end[at])))
                yield from table_of(rows, COPIES).to_batches()

    return docs.mapInArrow(emit, ddl_of(COPIES))


def copied_chunks(keys: DataFrame, buckets: int) -> DataFrame:
    """Packed (id, first, end) of the chunks that a document with a smaller id has, by the home of the id."""

    def match(table: pa.Table) -> pa.Table:
        rows = list(zip(*(table.filter(table.column("told")).column(c).to_pylist() for c in HOMES.names), strict=True))
        asked = table.filter(pa.compute.invert(table.column("told")))
        if len(asked):
            ids, first, end = (read_packed(asked, c, np.int64) for c in ("ids", "firsts", "ends"))
            order, smallest = _by_digest(ids, read_packed(asked, "digests", np.uint8, 16).view(DIGEST))
            copies = order[ids[order] > smallest]
            for b, at in split_rows(home_of(ids[copies], buckets)):
                at = np.sort(copies[at])
                rows.append((b, len(at), pack(ids[at]), pack(first[at]), pack(end[at])))
        return table_of(rows, HOMES)

    return keys.groupBy("bucket").applyInArrow(match, ddl_of(HOMES))


def runs_of(first: np.ndarray, end: np.ndarray, least_run: int) -> list[tuple[int, int]]:
    """Neighbouring copied chunks as one run, where it is long enough."""
    order = np.argsort(first, kind="stable")
    first, end = first[order], end[order]
    if len(first):
        fresh = np.concatenate([[True], first[1:] != first[:-1]])  # repeated rows have the same chunks
        first, end = first[fresh], end[fresh]
    head = np.flatnonzero(np.concatenate([[True], first[1:] != end[:-1]])) if len(first) else np.empty(0, np.int64)
    starts, stops = first[head], end[np.append(head[1:], len(end)) - 1] if len(head) else head
    return [(a, b) for a, b in zip(starts.tolist(), stops.tolist(), strict=True) if b - a >= least_run]


def whole_words(data: bytes, first: int, end: int) -> tuple[int, int]:
    """The span without the parts of words at its ends that go on outside; of words longer than LONGEST_CUT only without the
    part of a character."""
    after = [p for p in range(first, min(first + LONGEST_CUT, end) + 1) if p == 0 or data[p - 1] in SPACES]
    before = [p for p in range(end, max(end - LONGEST_CUT, first) - 1, -1) if p == len(data) or data[p] in SPACES]
    if after:
        first = after[0]
    else:
        while first < end and data[first] & 0xC0 == 0x80:
            first += 1
    if before:
        end = before[0]
    else:
        while first < end and data[end] & 0xC0 == 0x80:
            end -= 1
    return first, end


def without(text: str | None, spans: list[tuple[int, int]]) -> tuple[str | None, int, int]:
    """The text that is left, the bytes that went, and in how many spans."""
    if not text or not spans:
        return text, 0, 0
    data, left, at, gone, count = text.encode(), [], 0, 0, 0
    for first, end in spans:
        first, end = whole_words(data, first, end)
        if first < end:
            left.append(data[at:first])
            at, gone, count = end, gone + end - first, count + 1
    return b"".join([*left, data[at:]]).decode(), gone, count


def cut_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_run: int = LEAST_RUN,
    counts: tuple[str, str] = ("n_removed", "n_spans"),
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """The documents with `text` freed of repeated passages, and the bytes removed and spans after the other columns.

    `counts` names the two; a column of the input with such a name gives way. The buckets follow the bytes of
    text, so one holds about `bucket_bytes` of it at any size of the table.
    """
    buckets = buckets_for(docs, text, bucket_bytes)
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    found = copied_chunks(chunk_keys(rows, buckets), buckets)
    others = [c for c in docs.columns if c not in counts]
    renamed = {c: f"c{n}" for n, c in enumerate(others)}
    packed = docs.select(F.col(f"`{key}`").cast("long").alias("id"), *[F.col(f"`{c}`").alias(n) for c, n in renamed.items()])
    homed = packed.withColumn("home", home_column(buckets)(F.col("id")))
    place = 1 + others.index(text)

    def free(table: pa.Table, copies: pa.Table) -> pa.Table:
        ids, first, end = (read_packed(copies, c, np.int64) if len(copies) else np.empty(0, np.int64) for c in HOMES.names[2:])
        order = np.argsort(ids, kind="stable")
        ids, first, end = ids[order], first[order], end[order]
        freed = []
        for id_, value in zip(table.column("id").to_pylist(), table.column(place), strict=True):
            low, high = (0, 0) if id_ is None else np.searchsorted(ids, [id_, id_ + 1])
            freed.append(without(value.as_py(), runs_of(first[low:high], end[low:high], least_run)))
        texts, removed, spans = zip(*freed, strict=True) if freed else ([], [], [])
        kept = table.drop_columns(["id", "home"])
        kept = kept.set_column(place - 1, kept.field(place - 1).name, pa.array(texts, pa.string()))
        return kept.append_column("_removed", pa.array(removed, pa.int64())).append_column("_spans", pa.array(spans, pa.int64()))

    kinds = ", ".join(f"{n} {packed.schema[n].dataType.simpleString()}" for n in renamed.values())
    result = homed.groupBy("home").cogroup(found.groupBy("bucket")).applyInArrow(free, f"{kinds}, _removed long, _spans long")
    names = {n: c for c, n in renamed.items()} | {"_removed": counts[0], "_spans": counts[1]}
    return result.select(*[F.col(n).alias(c) for n, c in names.items()])
