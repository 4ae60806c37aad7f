"""Exact substring deduplication: sorted suffixes of the whole collection, built column by column.

Every byte covered by a string of LEAST bytes that also starts in a document with a smaller id goes. Strings are judged
on the texts as they came; matches lie within one document.

Where equal strings meet. The smallest hashed K-gram of a string (its anchor) is the same wherever the string stands, at
the same distance from its start. So the strings around an anchor are the suffixes of one short context, the bytes from
SPAN - 1 before the anchor to LEAST after its start, and equal strings begin in the same column of contexts with one
anchor. First the anchors alone are compared, packed to five bytes each; contexts are sent only for anchors that two
documents have. What a task finds twice among its own documents it decides itself and sends once, so a passage that a
third of all documents share is one row per task. In a run of one byte every place is an anchor, and all contexts inside
the run are equal, so such a stretch is one row with its length. Contexts are made in slices of `SLICE`.

Column-wise construction. The contexts of a bucket of anchors lie in a file, last column first. Each round reads the
next column, one symbol per context, puts it before the suffixes sorted so far, and updates the order, the transform
(the symbols in that order) and the common prefixes of neighbours (one more than the smallest between two that get the
same symbol, else none), which go through files too. A column's suffixes that share LEAST bytes or more are then
neighbours, and the smallest document among them keeps the string. The files belong to the task alone; a task that is
lost starts over.

Edge cases: null and empty texts have no bytes and lose none. Rows that share an id are taken for repeated rows with one
text; none removes from another. Documents without an id neither lose bytes nor make others lose any. An empty table
gives no rows. Only the named columns are read. A removal may cut a character; `kept` is bytes.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathwarden.llm.packing import BUCKET_BYTES, buckets_for, ddl_of, home_column, home_of, pack, read_packed, scramble, split_rows, table_of

LEAST = 50
K = 24
#: Places of the anchor in a string, and columns of a context.
SPAN = LEAST - K + 1
WIDTH = SPAN - 1 + LEAST
#: Bytes of text whose anchors a task compares at once. Any value gives the same result.
BATCH_BYTES = 4_000_000
#: Contexts that a task makes and compares at once. Any value gives the same result.
SLICE = 200_000

LOW = np.uint64((1 << 40) - 1)
NOBODY = np.iinfo(np.int64).max


def _grams(data: np.ndarray) -> np.ndarray:
    """A scrambled hash of the K bytes from each place on."""
    with np.errstate(over="ignore"):
        part, power, size = data.astype(np.uint64) + np.uint64(1), 0x9E3779B97F4A7C15, 1
        while size < 8:
            part = part[:-size] + np.uint64(power) * part[size:]
            power, size = power * power % 2**64, 2 * size
        eight, once = part, np.uint64(power)
        whole = eight[: len(eight) - 16] + once * (eight[8 : len(eight) - 8] + once * eight[16:])
        return scramble(whole)


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """The anchors of texts that lie one after the other: hash, place, and the first and last string start that it anchors."""
    empty = np.empty(0, np.int64)
    if len(data) < LEAST:
        return np.empty(0, np.uint64), empty, empty, empty
    hashes = _grams(data)
    # The place breaks ties, the leftmost first, so the choice depends on the string alone.
    packed = (hashes & ~np.uint64(0xFFFFFF)) | np.arange(len(hashes), dtype=np.uint64)
    least, size = packed, 1
    while 2 * size <= SPAN:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[: len(least) - (SPAN - size)], least[SPAN - size :])
    starts = np.concatenate([[0], ends[:-1]])
    whole = np.zeros(len(least) + 1, np.int32)
    long_enough = ends - starts >= LEAST
    np.add.at(whole, starts[long_enough], 1)
    np.add.at(whole, ends[long_enough] - LEAST + 1, -1)
    begin = np.flatnonzero(np.cumsum(whole[:-1]) > 0)
    place = (least[begin] & np.uint64(0xFFFFFF)).astype(np.int64)
    new = np.ones(len(place), bool)
    new[1:] = place[1:] != place[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place)) - 1
    place = place[first]
    return hashes[place], place, begin[first], begin[last]


def _texts(ids: list, texts) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, bytes, ends) of rows that have an id and LEAST bytes, in batches."""
    batch_ids, parts, size = [], [], 0
    for id_, text in zip(ids, texts, strict=True):
        data = (text.as_py() or "").encode() if id_ is not None else b""
        if len(data) < LEAST:
            continue
        # A batch has less than 2 ** 24 places, unless one text alone has more.
        if parts and size + len(data) > BATCH_BYTES:
            yield np.array(batch_ids, np.int64), np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(p) for p in parts])
            batch_ids, parts, size = [], [], 0
        batch_ids.append(id_)
        parts.append(data)
        size += len(data)
    if parts:
        yield np.array(batch_ids, np.int64), np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(p) for p in parts])


def _pieces(data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The same texts in stretches of less than 2 ** 24 places: (first place, bytes, ends). Only a text beyond that is cut, with an overlap."""
    most = 1 << 24
    if len(data) < most:
        yield 0, data, ends
        return
    for at in range(0, len(data), most - WIDTH):
        yield at, data[at : at + most - 1], np.unique(np.minimum(np.array([*ends[ends > at] - at]), min(most - 1, len(data) - at)))


def _anchored(ids: np.ndarray, data: np.ndarray, ends: np.ndarray, buckets: int) -> tuple[np.ndarray, ...]:
    """For each anchor of a batch: document number, bucket, key in the bucket, place, first and last start."""
    found = [(h, p + at, a + at, b + at) for at, part, cuts in _pieces(data, ends) for h, p, a, b in [anchors(part, cuts)]]
    hashes, place, first, last = (np.concatenate(x) for x in zip(*found, strict=True))
    owner = np.searchsorted(ends, place, "right")
    bucket = ((hashes >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
    return owner, bucket, (hashes & LOW).astype(np.int64), place, first, last


KEYS = pa.schema([("bucket", pa.int32()), ("told", pa.bool_()), ("count", pa.int32()), ("keys", pa.binary()), ("ids", pa.binary())])
SHARED = pa.schema([("bucket", pa.int32()), ("count", pa.int32()), ("keys", pa.binary()), ("ids", pa.binary())])
CONTEXTS = pa.schema([(n, pa.int32()) for n in ("bucket", "count")] + [(n, pa.binary()) for n in ("contexts", "ids", "places", "firsts", "lasts", "repeats")])
SPANS = pa.schema([("bucket", pa.int32()), ("count", pa.int32()), ("ids", pa.binary()), ("starts", pa.binary()), ("ends", pa.binary())])


def anchor_keys(docs: DataFrame, buckets: int) -> DataFrame:
    """Packed (key, id) of the anchors of rows (id, text), by bucket. `told` rows are known to be shared, and go to the home of their id."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, data, ends in _texts(batch.column(0).to_pylist(), batch.column(1)):
                owner, bucket, key, *_ = _anchored(ids, data, ends, buckets)
                # One row per key and document, the smallest document of a key first.
                order = np.lexsort((ids[owner], key, bucket))
                bucket, key, id_ = bucket[order], key[order], ids[owner[order]]
                head = np.ones(len(key), bool)
                head[1:] = (key[1:] != key[:-1]) | (bucket[1:] != bucket[:-1])
                fresh = head.copy()
                fresh[1:] |= id_[1:] != id_[:-1]
                bucket, key, id_, head = bucket[fresh], key[fresh], id_[fresh], head[fresh]
                several = ~head
                several[:-1] |= ~head[1:]
                rows = []
                for b, at in split_rows(bucket[head]):
                    at = np.flatnonzero(head)[at]
                    at = at[np.argsort(id_[at], kind="stable")]
                    rows.append((b, False, len(at), pack(key[at].view(np.uint8).reshape(-1, 8)[:, :5]), pack(id_[at])))
                told = np.flatnonzero(several)
                for b, at in split_rows(home_of(id_[told], buckets)):
                    at = told[at]
                    rows.append((b, True, len(at), pack(key[at] + (bucket[at] << 40)), pack(id_[at])))
                if rows:
                    yield from table_of(rows, KEYS).to_batches()

    return docs.mapInArrow(emit, ddl_of(KEYS))


def shared_keys(keys: DataFrame, buckets: int) -> DataFrame:
    """The (key, id) whose key two documents have, packed by the home of the id."""

    def match(table: pa.Table) -> pa.Table:
        rows = []
        told = table.filter(table.column("told"))
        if len(told):
            rows += list(zip(*(told.column(c).to_pylist() for c in SHARED.names), strict=True))
        asked = table.filter(pa.compute.invert(table.column("told")))
        if len(asked):
            count = int(pa.compute.sum(asked.column("count")).as_py())
            wide = np.zeros((count, 8), np.uint8)
            wide[:, :5] = read_packed(asked, "keys", np.uint8, 5).reshape(-1, 5)
            key, ids = wide.view(np.int64).ravel(), read_packed(asked, "ids", np.int64)
            order = np.argsort(key, kind="stable")
            key, ids = key[order], ids[order]
            head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            many = np.minimum.reduceat(ids, head) < np.maximum.reduceat(ids, head)
            hit = np.repeat(many, np.diff(np.append(head, len(key))))
            key, ids = key[hit] + (asked.column("bucket")[0].as_py() << 40), ids[hit]
            for b, at in split_rows(home_of(ids, buckets)):
                rows.append((b, len(at), pack(key[at]), pack(ids[at])))
        return table_of(rows, SHARED)

    return keys.groupBy("bucket").applyInArrow(match, ddl_of(SHARED))


def stretches(data: np.ndarray, place: np.ndarray, first: np.ndarray, last: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The first of each stretch of anchors, place after place, whose contexts are inside one run of one byte, so are equal."""
    alike = np.concatenate([[0], np.cumsum(data[1:] == data[:-1])])
    low, high = place - (SPAN - 1), place + (LEAST - 1)
    inside = (low >= start) & (high < end)
    at = np.flatnonzero(inside)
    inside[at] = alike[high[at]] - alike[low[at]] == WIDTH - 1
    follows = np.zeros(len(place), bool)
    follows[1:] = inside[1:] & inside[:-1]
    for x in (place, first, last):
        follows[1:] &= x[1:] == x[:-1] + 1
    return np.flatnonzero(~follows)


def contexts(docs: DataFrame, shared: DataFrame, buckets: int) -> DataFrame:
    """The contexts of shared anchors, by the anchor's bucket. Of equal contexts in a group of documents only those of the
    smallest document are sent; the others' strings are decided and come as spans, at the end of the buckets."""

    def cut(texts: pa.Table, keys: pa.Table) -> pa.Table:
        rows = []
        if not len(keys):
            return table_of(rows, CONTEXTS)
        wanted_key, wanted_id = read_packed(keys, "keys", np.int64), read_packed(keys, "ids", np.int64)
        order = np.lexsort((wanted_key, wanted_id))
        wanted_key, wanted_id = wanted_key[order], wanted_id[order]
        have = np.unique(wanted_id)
        kept = [n for n, id_ in enumerate(texts.column("id").to_pylist()) if id_ is not None and have[min(np.searchsorted(have, id_), len(have) - 1)] == id_]
        few = texts.take(kept)
        for ids, data, ends in _texts(few.column("id").to_pylist(), few.column("text")):
            owner, bucket, key, place, first, last = _anchored(ids, data, ends, buckets)
            number = np.searchsorted(have, ids[owner])
            mine = np.unique(np.searchsorted(have, wanted_id).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ scramble(wanted_key.view(np.uint64)))
            asked = number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ scramble((key + (bucket << 40)).view(np.uint64))
            hit = np.flatnonzero(mine[np.minimum(np.searchsorted(mine, asked), len(mine) - 1)] == asked)
            if not len(hit):
                continue
            owner, bucket, key, place, first, last = (x[hit] for x in (owner, bucket, key, place, first, last))
            starts = np.concatenate([[0], ends[:-1]])
            heads = stretches(data, place, first, last, starts[owner], ends[owner])
            repeats = np.diff(np.append(heads, len(place)))
            # Equal contexts have one key, so a slice has most of them together.
            heads, repeats = (x[np.argsort(key[heads], kind="stable")] for x in (heads, repeats))
            padded = np.concatenate([np.zeros(SPAN - 1, np.uint8), data, np.zeros(LEAST, np.uint8)])
            windows = np.lib.stride_tricks.sliding_window_view(padded, WIDTH)
            for cut_at in range(0, len(heads), SLICE):
                some, times = heads[cut_at : cut_at + SLICE], repeats[cut_at : cut_at + SLICE]
                here, begin, end = place[some], starts[owner[some]], ends[owner[some]]
                # Columns of the text; those beyond it are zero, and no string reaches them.
                low, high = np.maximum(begin - here + SPAN - 1, 0), np.minimum(end - here + SPAN - 1, WIDTH)
                matrix = windows[here]
                columns_ = np.arange(WIDTH)
                matrix[(columns_ < low[:, None]) | (columns_ >= high[:, None])] = 0
                columns = [ids[owner[some]], here - begin, first[some] - begin, last[some] - begin, times.astype(np.int64)]
                # A zero beyond the text is not equal to one in it.
                ranged = np.concatenate([matrix, low[:, None].astype(np.uint8), high[:, None].astype(np.uint8)], 1)
                alike = ranged.view(f"V{WIDTH + 2}").ravel()
                by_text = np.lexsort((columns[0], np.unique(alike, return_inverse=True)[1]))
                alike = alike[by_text]
                head = np.ones(len(alike), bool)
                head[1:] = alike[1:] != alike[:-1]
                smallest = np.repeat(columns[0][by_text][head], np.diff(np.append(np.flatnonzero(head), len(head))))
                decided = by_text[columns[0][by_text] > smallest]
                for b, part in split_rows(home_of(columns[0][decided], buckets)):
                    part = decided[part]
                    rows.append((buckets + b, len(part), b"", pack(columns[0][part]), b"", pack(columns[2][part]), pack(columns[3][part] + columns[4][part] - 1 + LEAST), b""))
                sent = by_text[columns[0][by_text] == smallest]
                for b, part in split_rows(bucket[some][sent]):
                    part = sent[part]
                    part = part[np.argsort(columns[0][part], kind="stable")]
                    rows.append((b, len(part), pack(matrix[part]), *[pack(c[part]) for c in columns]))
        return table_of(rows, CONTEXTS)

    left = docs.groupBy("home")
    return left.cogroup(shared.groupBy("bucket")).applyInArrow(cut, ddl_of(CONTEXTS))


def _range_least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least of values[low : high] for many ranges, by tables of ranges of lengths 1, 2, 4, ..."""
    level = np.frexp((high - low).astype(float))[1] - 1
    tables = [values]
    for n in range(int(level.max(initial=0))):
        step = 1 << n
        table = tables[-1].copy()
        np.minimum(table[:-step], tables[-1][step:], out=table[:-step])
        tables.append(table)
    stacked = np.stack(tables)
    return np.minimum(stacked[level, low], stacked[level, high - (1 << level)])


def sorted_columns(matrix: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """From the last column to the first: the column, the suffixes from it in order, and the common prefix of each with the one before.

    One symbol per row and round. Columns are read, and order, transform and prefixes written and read again, one after
    the other from files without a name.
    """
    n, width = matrix.shape
    with tempfile.TemporaryFile() as symbols, tempfile.TemporaryFile() as state:
        symbols.write(np.ascontiguousarray(matrix.T[::-1]).tobytes())
        symbols.seek(0)
        state.write(np.arange(n, dtype=np.int32).tobytes() + bytes(n))
        for column in range(width - 1, -1, -1):
            state.seek(0)
            order = np.frombuffer(state.read(4 * n), np.int32)
            prefix = np.frombuffer(state.read(n), np.uint8)
            transform = np.frombuffer(symbols.read(n), np.uint8)[order]
            moved = np.argsort(transform, kind="stable")
            symbol = transform[moved]
            same = np.flatnonzero(symbol[1:] == symbol[:-1]) + 1
            updated = np.zeros(n, np.uint8)
            updated[same] = np.minimum(_range_least(prefix, moved[same - 1] + 1, moved[same] + 1), 254) + 1
            order = order[moved]
            state.seek(0)
            state.write(order.tobytes() + updated.tobytes())
            yield column, order, updated


def removable(matrix: np.ndarray, ids: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """For each context and start column, whether the string from there also starts in a document with a smaller id.

    `first` and `last` are the columns of the strings that the context stands for.
    """
    result = np.zeros((len(ids), SPAN), bool)
    for column, order, prefix in sorted_columns(matrix):
        if column < SPAN:
            own = (first[order] <= column) & (column <= last[order])
            id_ = np.where(own, ids[order], NOBODY)
            new = prefix < LEAST
            new[0] = True
            heads = np.flatnonzero(new)
            least = np.repeat(np.minimum.reduceat(id_, heads), np.diff(np.append(heads, len(new))))
            result[order, column] = own & (least < id_)
    return result


def spans(found: DataFrame, buckets: int) -> DataFrame:
    """Packed (id, start, end) of what goes, by the home of the id."""

    def judge(table: pa.Table) -> pa.Table:
        rows = []
        bucket = table.column("bucket")[0].as_py()
        ids = read_packed(table, "ids", np.int64)
        if bucket >= buckets:  # decided already
            return table_of([(bucket - buckets, len(ids), pack(ids), pack(read_packed(table, "firsts", np.int64)), pack(read_packed(table, "lasts", np.int64)))], SPANS)
        place = read_packed(table, "places", np.int64)
        begin = place - (SPAN - 1)
        matrix = read_packed(table, "contexts", np.uint8, WIDTH).reshape(-1, WIDTH)
        goes = removable(matrix, ids, read_packed(table, "firsts", np.int64) - begin, read_packed(table, "lasts", np.int64) - begin)
        edge = np.diff(np.pad(goes, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, start = np.nonzero(edge == 1)
        end = np.nonzero(edge == -1)[1] - 1 + LEAST
        # A stretch's spans, each a byte further, are one.
        end = end + read_packed(table, "repeats", np.int64)[row] - 1
        ids, start, end = ids[row], begin[row] + start, begin[row] + end
        for b, at in split_rows(home_of(ids, buckets)):
            rows.append((b, len(at), pack(ids[at]), pack(start[at]), pack(end[at])))
        return table_of(rows, SPANS)

    return found.groupBy("bucket").applyInArrow(judge, ddl_of(SPANS))


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans that meet or overlap as one, in order."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > reach[:-1]
    heads = np.flatnonzero(new)
    return starts[heads], reach[np.append(heads[1:], len(starts)) - 1]


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", with_kept: bool = True, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per document: key, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and, if wanted, kept (bytes).

    The buckets follow the bytes of text, so one holds about `bucket_bytes` of it at any size of the table.
    """
    buckets = buckets_for(docs, text, bucket_bytes)
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    shared = shared_keys(anchor_keys(rows, buckets), buckets)
    homed = rows.withColumn("home", home_column(buckets)(F.col("id")))
    gone = spans(contexts(homed, shared, buckets), buckets)
    schema = pa.schema(
        [("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
        + [("kept", pa.binary())] * with_kept
    )

    def remove(texts: pa.Table, found: pa.Table) -> pa.Table:
        ids, starts, ends = (read_packed(found, c, np.int64) for c in ("ids", "starts", "ends")) if len(found) else (np.empty(0, np.int64),) * 3
        order = np.argsort(ids, kind="stable")
        ids, starts, ends = ids[order], starts[order], ends[order]
        result = []
        for id_, value in zip(texts.column("id").to_pylist(), texts.column("text"), strict=True):
            data = (value.as_py() or "").encode()
            low, high = (0, 0) if id_ is None else np.searchsorted(ids, [id_, id_ + 1])
            first, end = merged(starts[low:high], ends[low:high]) if low < high else ((), ())
            kept, at = [], 0
            for a, b in zip(first, end, strict=True):
                kept.append(data[at:a])
                at = b
            kept = b"".join([*kept, data[at:]])
            result.append((id_, len(data), len(data) - len(kept), len(first), hashlib.sha256(kept).hexdigest(), *[kept] * with_kept))
        return table_of(result, schema)

    kinds = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_kept
    return homed.groupBy("home").cogroup(gone.groupBy("bucket")).applyInArrow(remove, kinds).withColumnRenamed("id", key)
