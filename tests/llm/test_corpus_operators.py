"""Substring removal, near duplicates, chunk dedup and sharding against brute force."""

import hashlib
import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pathwarden.llm import bag_minhash, chunk_dedup, packing, sharding, suffix_dedup
from pathwarden.session import cut_lineage
from tests.llm.conftest import ODD

# Suffix sorting


def plain_removal(rows, least=suffix_dedup.LEAST):
    """{(id, text): (bytes, removed, spans, digest)} by a table of all strings."""
    smallest = {}
    for id_, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - least + 1 if id_ is not None else 0):
            key = data[i : i + least]
            smallest[key] = min(smallest.get(key, id_), id_)
    result = {}
    for id_, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - least + 1 if id_ is not None else 0):
            if smallest[data[i : i + least]] < id_:
                gone[i : i + least] = True
        kept = bytes(np.frombuffer(data, np.uint8)[~gone[:-1]]) if data else b""
        spans = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        result[id_, text] = (len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest())
    return result


def removal_rows(prose):
    shared = prose(30, 1)
    rows = [(i, prose(20, 10 + i) + shared[i : 150 + i] + prose(5, 50 + i)) for i in range(12)]
    rows += [(20, shared[:49]), (21, shared[:50]), (22, shared[:50]), (23, "x" + shared[:50] + "y"), (24, shared[:50] * 3), (24, shared[:50] * 3)]
    rows += [(30, "a" * 400), (31, "b" + "a" * 300), (32, "a" * 49), (33, "ab" * 100), (34, "ba" * 80), (35, "é" * 60), (36, "x" + "é" * 60)]
    rows += [(40, prose(900, 99)), (41, prose(900, 99)[700:2000] + shared), (None, shared), (None, shared)]
    return rows + [(100 + n, t) for n, t in enumerate([*ODD, *ODD])]


def control_rows(prose):
    """Texts that only control characters tell apart, and runs of one byte of other lengths."""
    rows = []
    for n in range(12):
        text = prose(11, 200 + n)
        rows += [(2 * n, text), (2 * n + 1, "\0" * (n * 4) + text), (40 + n, text + "\0" * 30), (60 + n, "\x01" * n + text[:55] + "\0")]
    rows += [(100, "\0" * 90), (101, "\0" * 70 + "a"), (102, "b" + "\0" * 49), (103, "b" + "\0" * 60), (104, "\0")]
    runs = [("x" * n, "y" * (n // 2) + "x" * n + "z") for n in (49, 50, 75, 76, 77, 78, 130, 200)]
    return rows + [(200 + i, t) for i, t in enumerate(t for pair in runs for t in pair)] + [(300, "x" * 90 + prose(9, 1) + "x" * 140), (301, "xy" * 120), (302, "yx" * 99)]


@pytest.mark.parametrize("batch, piece", [(300, 7), (suffix_dedup.BATCH_BYTES, suffix_dedup.SLICE)])
def test_removal_tells_zeros_from_the_end_of_a_text(documents, prose, monkeypatch, batch, piece):
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", batch)
    monkeypatch.setattr(suffix_dedup, "SLICE", piece)
    for turned in (False, True):
        rows = [(500 - i if turned else i, t) for i, t in control_rows(prose)]
        expected = plain_removal(rows)
        got = suffix_dedup.dedup(documents(rows).repartition(3)).collect()
        assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == Counter((i, *expected[i, t]) for i, t in rows)


def test_a_long_run_of_one_byte_is_one_row():
    data = np.frombuffer(b"start" + b"x" * 1_000_000 + b"end", np.uint8)
    _, place, first, last = suffix_dedup.anchors(data, np.array([len(data)]))
    heads = suffix_dedup.stretches(data, place, first, last, np.zeros(len(place), int), np.full(len(place), len(data)))
    assert len(place) > 900_000 and len(heads) < 200


@pytest.mark.parametrize("batch", [300, suffix_dedup.BATCH_BYTES])
def test_removal_equals_brute_force(documents, prose, monkeypatch, batch):
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", batch)
    rows = removal_rows(prose)
    frame = documents(rows, extra=["id", "home", "bucket"]).repartition(3)
    expected = plain_removal(rows)
    got = suffix_dedup.dedup(frame, bucket_bytes=5_000).collect()
    assert len(got) == len(rows)
    texts = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got)
    assert texts == Counter((id_, *expected[id_, text]) for id_, text in rows)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


def test_buckets_follow_the_bytes(documents, spark):
    docs = documents([(n, "\u00e9" * 500) for n in range(40)] + [(40, None)])
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert [packing.buckets_for(docs, "text", most) for most in (1_000, 40_000, 999)] == [40, least, 41]
    assert packing.buckets_for(documents([]), "text") == least


def test_removal_of_nothing(documents):
    assert suffix_dedup.dedup(documents([])).count() == 0


def test_columns_are_sorted_suffixes():
    pick = random.Random(2)
    matrix = np.array([[pick.choice(b"ab") for _ in range(9)] for _ in range(40)], np.uint8)
    for column, order, prefix in suffix_dedup.sorted_columns(matrix):
        suffixes = [matrix[n, column:].tobytes() for n in order]
        assert suffixes == sorted(suffixes)
        for (a, b), common in zip(zip(suffixes, suffixes[1:], strict=False), prefix[1:], strict=True):
            assert common == next((i for i in range(len(a)) if a[i] != b[i]), len(a))


def test_anchor_depends_on_the_string_alone(prose):
    text = prose(60, 3).encode()
    for cut in (0, 3, 40):
        data = np.frombuffer(text[cut:], np.uint8)
        _, place, first, last = suffix_dedup.anchors(data, np.array([len(data)]))
        found = {s + cut: p + cut for p, a, b in zip(place, first, last, strict=True) for s in range(a, b + 1)}
        assert sorted(found) == list(range(cut, len(text) - suffix_dedup.LEAST + 1))
        if cut == 0:
            whole = found
        assert all(whole[s] == p for s, p in found.items())


def test_long_texts_are_cut_with_an_overlap():
    data = np.zeros((1 << 24) + 1000, np.uint8)
    pieces = list(suffix_dedup._pieces(data, np.array([len(data)])))
    assert len(pieces) == 2 and pieces[1][0] + suffix_dedup.WIDTH == (1 << 24) and pieces[1][0] + len(pieces[1][1]) == len(data)


# Near duplicates


def similarity(a, b):
    x, y = Counter(bag_minhash.Bags().shingles(a).tolist()), Counter(bag_minhash.Bags().shingles(b).tolist())
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def changed(text, n, seed):
    pick, words = random.Random(seed), text.split()
    for _ in range(n):
        words[pick.randrange(len(words))] = "changed"
    return " ".join(words)


def plain_classes(rows):
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (i, a) in enumerate(rows):
        for j, b in rows[:n]:
            wordless = not bag_minhash.Bags().shingles(a).size and not bag_minhash.Bags().shingles(b).size
            if wordless or similarity(a, b) >= 0.8:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in root}


def test_classes_equal_brute_force(documents, prose):
    base = [prose(120, n) for n in range(4)]
    rows = [(n, changed(base[n % 4], n // 4 % 4, n)) for n in range(40)]
    rows += [(50, base[0].upper().replace(" ", ", ")), (51, "one two three"), (52, "One, two. three!"), (53, "one two four")]
    rows += [(60 + n, t) for n, t in enumerate([*ODD, *ODD])]
    # A chain: neighbours are similar, its ends are not.
    chain = [base[3]]
    for n in range(6):
        words = chain[-1].split()
        words[n * 18 : n * 18 + 2] = ["c", "d"]
        chain.append(" ".join(words))
    rows += [(200 + n, t) for n, t in enumerate(chain)]
    expected = plain_classes(rows)
    got = bag_minhash.classes(documents(rows + [(None, base[0]), (None, None), (3, rows[3][1])], extra=["id", "bag"])).collect()
    assert len(got) == len(rows) + 3
    assert {r.doc_id: r.class_id for r in got if r.doc_id is not None} == expected
    assert [r.class_id for r in got if r.doc_id is None] == [None, None]


def test_lots_and_cells_do_not_change_classes(documents, prose, monkeypatch):
    base = prose(150, 5)
    # Many edits: most copies are similar to few others and to neither end of a bucket.
    rows = [(n, changed(base, (n * 7) % 12, n)) for n in range(70)]
    monkeypatch.setattr(bag_minhash, "LOT", 3)
    monkeypatch.setattr(bag_minhash, "CELL", 4)
    assert {r.doc_id: r.class_id for r in bag_minhash.classes(documents(rows)).collect()} == plain_classes(rows)


def test_agreeing_knows_the_bands_of_the_keys():
    """A pair counts in the first band whose keys are equal, and in no later one."""
    signatures = np.random.default_rng(5).choice(4, (60, bag_minhash.BANDS * bag_minhash.ROWS), p=[0.85, 0.05, 0.05, 0.05]).astype(np.uint16)
    keys = bag_minhash.band_keys(signatures)
    equal = (signatures[:, None] == signatures[None, :]).mean(2)
    for band in range(bag_minhash.BANDS):
        before = (keys[:, None, :band] == keys[None, :, :band]).any(2)
        assert (bag_minhash.agreeing(signatures, signatures, band) == np.where(before, 0, equal)).all()


def test_leftover_pair_with_no_other_path(spark, documents, prose):
    """Two near copies that agree in components 1, 26, 51, 76 and 101, which are no band, and first share band 3."""
    text = prose(200, 3)
    first = np.arange(bag_minhash.BANDS * bag_minhash.ROWS, dtype=np.uint16)
    second = first.copy()
    second[[0, 5, 10]] = 999
    rows = [(7, 3, 1, 1, first.tobytes()), (7, 3, 2, 2, second.tobytes())]
    placed = spark.createDataFrame(rows, "bucket long, band int, id long, class long, signature binary")
    docs = documents([(1, text), (2, text + " end")]).selectExpr("doc_id as id", "text")
    assert [set(r) for r in bag_minhash.leftover_links(docs, placed).collect()] == [{1, 2}]


def test_keep_first(documents, prose):
    rows = [(1, prose(60, 1)), (1, prose(60, 1)), (2, prose(60, 1) + " end"), (3, prose(60, 3)), (None, "x"), (None, "x"), (5, None), (6, "")]
    docs = documents(rows, extra=["_row", "class_id"])
    kept = bag_minhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 1, 3, 5]
    assert bag_minhash.keep_first(documents([])).count() == 0


@pytest.mark.parametrize("heaviest", [1, 3, 50])
def test_signatures_are_unbiased(heaviest):
    pick, errors = np.random.default_rng(heaviest), []
    for _ in range(40):
        runs = pick.integers(0, 2**63, 50).astype(np.uint64)
        a = pick.integers(0, heaviest + 1, 50)
        b = np.where(pick.random(50) < 0.7, a, pick.integers(0, heaviest + 1, 50))
        both = [(runs[w > 0], w[w > 0]) for w in (a, b)]
        point = bag_minhash.signatures(*(np.concatenate(x) for x in zip(*both, strict=True)), np.repeat([0, 1], [len(r) for r, _ in both]), 2, 512)
        errors.append((point[0] == point[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.01


# Chunks


def test_chunks_cover_the_text(prose):
    for text in [prose(400, 1), "a" * 5_000, "", "x", *filter(None, ODD)]:
        data = text.encode()
        ends = chunk_dedup.chunk_ends(data)
        sizes = np.diff([0, *ends])
        assert (ends[-1] if ends else 0) == len(data)
        assert all(chunk_dedup.LEAST_CHUNK <= s <= chunk_dedup.MOST_CHUNK for s in sizes[:-1])


def test_cuts_resist_shifts(prose):
    text = prose(600, 2).encode()
    ends = set(chunk_dedup.chunk_ends(text))
    moved = {e - 7 for e in chunk_dedup.chunk_ends(b"1234567" + text)}
    assert len(ends & moved) > 0.9 * len(ends)


def plain_spans(rows):
    """{id: spans} of runs of chunks that a document with a smaller id has."""
    pieces = {}
    for id_, text in rows:
        data, first = (text or "").encode(), 0
        pieces[id_] = []
        for end in chunk_dedup.chunk_ends(data):
            pieces[id_].append((data[first:end], first, end))
            first = end
    smallest = {}
    for id_, parts in pieces.items():
        for piece, _, _ in parts:
            smallest[piece] = min(smallest.get(piece, id_), id_)
    result = {}
    for id_, parts in pieces.items():
        runs, open_ = [], None
        for piece, first, end in [*parts, (None, 0, 0)]:
            if piece is not None and smallest[piece] < id_:
                open_ = (open_[0] if open_ else first, end)
            elif open_:
                runs, open_ = runs + [open_], None
        runs = [r for r in runs if r[1] - r[0] >= chunk_dedup.LEAST_RUN]
        if runs:
            result[id_] = runs
    return result


def chunk_rows(prose):
    passage = prose(60, 1)
    rows = [(n, prose(40, 10 + n) + " " + passage + " " + prose(30, 70 + n)) for n in range(8)] + [(20, prose(100, 30)), (21, prose(100, 31)), (22, prose(40, 15))]
    return rows + [(100 + n, t) for n, t in enumerate(ODD)]


@pytest.mark.parametrize("batch", [40, chunk_dedup.BATCH_CHUNKS])
def test_removal_of_chunks_equals_brute_force(documents, prose, monkeypatch, batch):
    monkeypatch.setattr(chunk_dedup, "BATCH_CHUNKS", batch)
    rows = chunk_rows(prose)
    spans = plain_spans(rows)
    got = {r.doc_id: (r.text, r.n_removed, r.n_spans) for r in chunk_dedup.cut_repeats(documents(rows).repartition(3), bucket_bytes=5_000).collect()}
    assert got == {i: chunk_dedup.without(t, spans.get(i, [])) for i, t in rows}


@pytest.mark.parametrize("first, count", [(0x4E00, 3_000), (0x61, 26)])
def test_passages_without_spaces_go(documents, first, count):
    def text(n, seed):
        pick = random.Random(seed)
        return "".join(chr(first + pick.randrange(count)) for _ in range(n))

    shared = text(600, 1)
    rows = [(1, text(200, 2) + shared + text(200, 3)), (2, text(200, 4) + shared + text(200, 5)), (3, text(100, 6) + "\n" + shared + "\n" + text(100, 7))]
    got = {r.doc_id: r for r in chunk_dedup.cut_repeats(documents(rows)).collect()}
    assert got[1].n_removed == 0
    for id_, value in rows[1:]:
        data = value.encode()
        (a, b), = plain_spans(rows)[id_]
        # Whole characters of the span, but for the ends that a line break lies close to.
        whole = len(data[a:b].decode(errors="ignore").encode())
        assert whole - 2 * chunk_dedup.LONGEST_CUT * (id_ == 3) <= got[id_].n_removed <= whole
        assert got[id_].n_removed > len(shared.encode()) - 2 * chunk_dedup.MOST_CHUNK - 2 * chunk_dedup.LONGEST_CUT
        assert got[id_].text.encode() == data[: (at := len(os.path.commonprefix([data, got[id_].text.encode()])))] + data[at + got[id_].n_removed :]


def test_passages_go_and_clean_texts_stay(documents, prose):
    rows = [*chunk_rows(prose), (None, prose(60, 1)), (3, chunk_rows(prose)[3][1])]
    docs = documents(rows, extra=["id", "spans", "n_spans"])
    freed = chunk_dedup.cut_repeats(docs, counts=("_gone", "_runs"))
    assert freed.columns == [*docs.columns, "_gone", "_runs"]
    got = {}
    for r in freed.collect():
        got.setdefault(r.doc_id, []).append(r)
    passage = prose(60, 1).split()
    assert len(got[3]) == 2 and got[3][0] == got[3][1]
    assert got[None][0].text == prose(60, 1) and got[0][0].text == rows[0][1]
    for n in range(1, 8):
        own = prose(40, 10 + n).split(), prose(30, 70 + n).split()
        words = got[n][0].text.split()
        left = len(words) - 70
        assert words[:40] == own[0] and words[-30:] == own[1] and left < 0.45 * len(passage)
    for id_, text in rows:
        if id_ in (20, 21) or (id_ or 0) >= 100:
            assert got[id_][0].text == text and got[id_][0]["_gone"] == 0
    assert chunk_dedup.cut_repeats(documents([])).count() == 0


# Shards


@pytest.mark.parametrize("bucket_rows", [3, 5_000])
def test_shards(documents, monkeypatch, bucket_rows):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", bucket_rows)
    rows = [(n, "t" * (n % 7), "hot" if n % 3 else f"s{n % 4}") for n in range(331)] + [(5, "dup", None), (5, "dup", None), (None, None, None)]
    got = sharding.interleave(documents(rows, extra=["shard", "_rank"])).collect()
    sizes = Counter(r.shard for r in got)
    assert len(got) == 334 and set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard in sizes:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sizes[shard]))
    assert sorted(r.position for r in got) == list(range(334))
    for source, n in Counter(r.source for r in got).items():
        per = Counter(r.shard for r in got if r.source == source)
        assert all(abs(per[s] - n / 8) < 2 for s in range(8))
    assert [(r.size, r.text_crc32) for r in got if r.doc_id is None] == [(1, 0)]
    again = sharding.interleave(documents(rows[::-1])).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_few_rows_and_none(documents):
    assert sharding.interleave(documents([])).count() == 0
    assert sorted(r.slot for r in sharding.interleave(documents([(1, "a"), (2, "b")])).collect()) == [0, 0]


def test_interleave_of_ties_equals_a_plain_sort(documents):
    """Many sources of one row share one fraction, rows of one id one seed."""
    rows = [(i, f"text {i}", f"s{i}") for i in range(1500)] + [(3000, f"again {i}", "big") for i in range(1500)]
    ranked = {}
    for id_, text, source in rows:
        seed = hashlib.md5(f"{sharding.SEED}:{id_}".encode()).hexdigest()
        ranked.setdefault(source, []).append((seed, id_, zlib.crc32(text.encode()), len(text.encode()) + 1))
    placed = []
    for source, members in ranked.items():
        placed += [((2 * rank - 1) / (2 * len(members)), source, *m) for rank, m in enumerate(sorted(members), 1)]
    expected = {p: (row[1], row[4]) for p, row in enumerate(sorted(placed))}
    got = sharding.interleave(documents(rows)).collect()
    assert {r.position: (r.source, r.text_crc32) for r in got} == expected
    assert Counter(r.shard for r in got) == {s: 375 for s in range(8)}


def test_ranges_split_ties(documents, monkeypatch):
    """A first column without any difference leaves no range with all rows."""
    stored = []
    monkeypatch.setattr(sharding, "cut_lineage", lambda df: stored.append(cut_lineage(df)) or stored[-1])
    rows = documents([(1, f"text {i}") for i in range(2000)]).select("source", "text", F.lit(0.5).alias("share"))
    placed = sharding._ranked(rows, 2000, [], ["share", "source", "text"], "place")
    assert [r.text for r in placed.orderBy("place").collect()] == sorted(f"text {i}" for i in range(2000))
    assert stored[0].groupBy("_range").count().agg(F.max("count")).first()[0] < 1000
