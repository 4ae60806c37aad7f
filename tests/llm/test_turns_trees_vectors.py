"""Repair of conversations, BK-trees over fingerprints and whitening, against brute force."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pathwarden.llm import bk_tree, queries, turn_repair, whitening
from tests.llm.conftest import ODD

# Conversations

TURNS = "conv_id long, turn long, role string, text string"
GOOD = re.compile("(s?(ua)+)?")
COST = {"D": 4, "I": 3, "K": 0, "R": 3}


def plain_faults(rows):
    seen, faults = set(), []
    for role, text in rows:
        if not re.search(r"[^\x20\x09-\x0D]", text):
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("" if re.search(r"[.!?][\x20\x09-\x0D]*\Z", text) else "truncated")
        seen.add((role, text))
    return faults


def plain_repair(rows):
    """(cost, audit, repaired) by trying all lists of edits, inserts of either role at any place included."""
    faults, best = plain_faults(rows), None
    most = 2 * len(rows) + 2
    for edits in itertools.product(*[["D"] if f in ("blank", "duplicate") else ["D", "K", "Ru", "Ra"] for f in faults]):
        for many in range(min(4, most) + 1):
            for places in itertools.combinations_with_replacement(range(len(rows) + 1), many):
                for roles in itertools.product(["user", "assistant"], repeat=many):
                    audit, turns, cost = "", [], 3 * many
                    for n in range(len(rows) + 1):
                        for place, role in zip(places, roles, strict=True):
                            if place == n:
                                audit += "I"
                                turns.append((role, ""))
                        if n < len(rows):
                            edit, (role, text) = edits[n], rows[n]
                            audit += edit[0]
                            cost += COST[edit[0]] + (3 if faults[n] == "truncated" and edit != "D" else 0)
                            if edit != "D":
                                turns.append(({"K": role, "Ru": "user", "Ra": "assistant"}[edit], text))
                    if GOOD.fullmatch("".join(r[:1] or "-" for r, _ in turns)) and (best is None or (cost, audit) < best[:2]):
                        best = cost, audit, "\n".join(f"{r}:{t}" for r, t in turns)
    return best


def some_conversations(seed, number=40):
    pick = random.Random(seed)
    texts = ["Yes.", "No!", "why", "", " \n", "Yes. ", "a.b", "é?"]
    for conv in range(number):
        yield conv, [(n, pick.choice(["user", "assistant", "system", "user", "assistant", "tool", ""]), pick.choice(texts)) for n in range(pick.randint(1, 3))]


@pytest.mark.parametrize("block", [1, 2, turn_repair.BLOCK])
def test_repair_equals_brute_force(spark, block):
    talks = dict(some_conversations(block))
    frame = spark.createDataFrame([(c, *row) for c, rows in talks.items() for row in rows], TURNS).repartition(3)
    got = {r.conv_id: r for r in turn_repair.audits(frame, block=block).collect()}
    assert set(got) == set(talks)
    for conv, rows in talks.items():
        rows = [(role, text) for _, role, text in rows]
        cost, audit, repaired = plain_repair(rows)
        r, faults = got[conv], plain_faults(rows)
        assert (r.cost, r.audit, r.repaired_sha256) == (cost, audit, hashlib.sha256(repaired.encode()).hexdigest())
        assert (r.blank, r.duplicate, r.truncated) == tuple(faults.count(f) for f in ("blank", "duplicate", "truncated"))
        assert r.illegal == sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))


def test_a_step_gives_the_same_edits_by_its_relative_costs():
    kinds = range(16)
    reached, waiting = set(), [turn_repair.AT_END]
    while waiting:
        costs = waiting.pop()
        if costs not in reached:
            reached.add(costs)
            waiting += [turn_repair.step(kind, costs)[1] for kind in kinds]
    # A task remembers a step for each of them: few, however long its conversations are.
    assert len(reached) < 200


def test_long_conversation_in_blocks_and_rows(spark):
    pick = random.Random(5)
    rows = [(7, n, pick.choice(["user", "assistant"]), f"{pick.choice(['x', 'y'])}{n // 3}.") for n in range(3_000)]
    frame = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("x") for c in ("conv", "kind", "sort", "choices", "digest")})
    one, many = (turn_repair.audits(frame, block=b).collect() for b in (turn_repair.BLOCK, 100))
    assert one == many
    edits = sorted(turn_repair.repair(frame, block=100).collect(), key=lambda r: r.place)
    assert [r.place for r in edits] == list(range(len(edits)))
    assert "".join(r.edit for r in edits) == one[0].audit
    kept = [r for r in edits if r.edit != "D"]
    assert GOOD.fullmatch("".join(r.role[0] for r in kept))
    assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in kept).encode()).hexdigest() == one[0].repaired_sha256
    assert [r.turn for r in edits if r.turn is not None] == list(range(3_000)) and all(r.turn is None for r in edits if r.edit == "I")


def test_odd_conversations(spark):
    rows = [(None, 1, "user", "a."), (None, None, "assistant", None), (1, None, None, "b."), (1, 2**53 + 1, "user", "x" * 70_000 + "."), (1, 2**53 + 3, "assistant", "c."), (2**53 + 1, 4, "user", "d")]
    rows += [(3, 1, "user", "e."), (3, 1, "assistant", "f."), (3, 1, "user", "e.")]
    also = spark.createDataFrame([(9,), (1,), (9,)], "conv_id long")
    got = {r.conv_id: r for r in turn_repair.audits(spark.createDataFrame(rows, TURNS), also).collect()}
    assert set(got) == {None, 1, 2**53 + 1, 3, 9}
    assert (got[None].gaps, got[None].blank, got[None].audit) == (0, 1, "DKI")
    assert (got[1].gaps, got[1].audit, got[1].illegal) == (1, "DKK", 1)
    assert (got[2**53 + 1].cost, got[2**53 + 1].audit) == (4, "D")
    # Ties are taken by role: assistant, then the two equal user turns.
    assert (got[3].duplicate, got[3].gaps, got[3].audit) == (1, 0, "IKKDI")
    assert got[9][1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert turn_repair.audits(spark.createDataFrame([], TURNS)).count() == turn_repair.repair(spark.createDataFrame([], TURNS)).count() == 0


def test_damage(spark):
    import zlib

    rows = [(c, t, "assistant", "A. b! c?") for c in range(30) for t in range(10)] + [(None, None, None, None)]
    got = sorted(tuple(r) for r in queries._damaged(spark.createDataFrame(rows, TURNS)).collect() if r.conv_id is not None)
    expected = []
    for c, t, role, text in rows[:-1]:
        fate = zlib.crc32(f"{c}:{t}".encode()) % 20
        if fate:
            row = (c, t, "user" if fate == 4 else role, {1: "", 2: "A b c"}.get(fate, text))
            expected += [row] * (2 if fate == 3 else 1)
    assert got == sorted(expected)


# Fingerprints


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(words[n : n + 3]) for n in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """The smallest place that each print is linked to by a chain."""
    prints, root = np.array(prints, np.uint64), list(range(len(prints)))
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[i] ^ prints) <= bk_tree.RADIUS):
            a, b = root[i], root[int(j)]
            root = [min(a, b) if r in (a, b) else r for r in root]
    return root


@pytest.mark.parametrize("piece", [1, 7, 40, bk_tree.PIECE])
def test_fingerprint_in_pieces(prose, piece):
    texts = [*ODD[:5], prose(300, 1), "AÉ b", "a\tB\x0bc\x1cd", " lead and trail \n", "aa bb", "  x y z w"]
    assert [bk_tree.fingerprint(t, piece) for t in texts] == [plain_print(t) for t in texts]


def near_prints(seed, number, centres=3, flips=6):
    pick = random.Random(seed)
    base = [pick.getrandbits(64) for _ in range(centres)] + [0, 2**64 - 1]
    made = set()
    while len(made) < number:
        value = pick.choice(base)
        for _ in range(pick.randint(0, flips)):
            value ^= 1 << pick.randrange(64)
        made.add(value)
    return list(made)


def test_search_finds_all_pairs_within_the_radius():
    prints = np.array(near_prints(1, 700), np.uint64)
    cell = np.sort(np.arange(700) % 3)
    forest = bk_tree.Forest(cell, prints)
    found = {(int(a), int(b)) for x, y in forest.search(np.arange(700)) for a, b in zip(x, y, strict=True)}
    assert found == {(i, j) for i, j in itertools.combinations(range(700), 2) if cell[i] == cell[j] and (int(prints[i]) ^ int(prints[j])).bit_count() <= 3}
    assert sum(len(x) for x, _ in forest.search(np.arange(700))) == len(found)


@pytest.mark.parametrize("cell, visits", [(48, 50), (bk_tree.CELL, bk_tree.VISITS)])
def test_links_connect_what_is_near(spark, monkeypatch, cell, visits):
    prints = near_prints(cell, 400, centres=2)
    signed = [bk_tree._signed(p) for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "print long")
    largest = bk_tree.cells(frame, cell).groupBy("mask", "value").count().agg(F.max("count")).first()[0]
    assert largest <= cell
    pairs = [(signed.index(r.a), signed.index(r.b)) for r in bk_tree.print_links(frame, cell).collect()]
    assert all((prints[a] ^ prints[b]).bit_count() <= 3 for a, b in pairs)
    root = list(range(len(prints)))
    for a, b in pairs:
        x, y = root[a], root[b]
        root = [min(x, y) if r in (x, y) else r for r in root]
    assert root == plain_components(prints)
    local = bk_tree.links(np.zeros(400, np.int64), np.array(prints, np.uint64), visits)
    assert len(local) == 400 - len(set(root))


def test_masks_leave_no_pair_apart():
    pick = random.Random(3)
    for mask in (0, bk_tree.block_masks()[3], bk_tree.block_masks(bk_tree.block_masks()[0])[5]):
        finer = bk_tree.block_masks(mask)
        for _ in range(300):
            a = pick.getrandbits(64)
            b = a ^ sum({1 << pick.randrange(64) for _ in range(3)})
            assert a & mask != b & mask or any(a & m == b & m for m in finer)


def test_documents_have_the_components_of_brute_force(documents, prose):
    text = prose(200, 5)
    edits = [text.replace(w, w + "x", 1) for w in text.split()[::9]]
    rows = [*enumerate([text, *edits, prose(150, 6), text, text.upper(), *ODD, *ODD, "a b c", "A  B\tc"]), (None, text), (None, prose(50, 8))]
    rows = [(100 - i if i is not None else None, t) for i, t in rows]
    got = bk_tree.near_components(documents([*rows, rows[0]], extra=["print", "component", "mask", "id"]).repartition(3)).collect()
    prints = [plain_print(t) for _, t in rows]
    root = plain_components(prints)
    least = {c: min((i for (i, _), r in zip(rows, root, strict=True) if r == c and i is not None), default=None) for c in root}
    expected = [(i, bk_tree._signed(p), least[c]) for (i, _), p, c in zip(rows, prints, root, strict=True)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, [*expected, expected[0]]))
    assert bk_tree.near_components(documents([])).count() == 0


# Vectors

VECTORS = "vec_id long, embedding array<float>"


def check_whitening(rows, got, most):
    """The rows of the operator against the eigenvectors of the whole covariance.

    They come from the SVD of the centred rows: squaring these first loses the digits that small eigenvalues need.
    """
    x = np.floor(64 * np.array([np.array(v, np.float32) for _, v in rows], float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(0)
    _, roots, vectors = np.linalg.svd(x - sums / n, full_matrices=False)
    values, vectors = roots**2 / n, vectors.T
    real = int((values > values[0] * 1e-11).sum())
    size = min(most, real)
    assert len(got) == n * size
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    expected = (x - sums / n) @ vectors[:, :size] / np.sqrt(values[:size])
    ours = np.array([[by_id[i][k + 1].whitened for k in range(size)] for i, _ in rows])
    signs = np.sign((ours * expected).sum(0))
    assert np.abs(ours - signs * expected).max() < 1e-8
    assert np.allclose([by_id[rows[0][0]][k + 1].explained for k in range(size)], values[:size] / values.sum(), rtol=1e-6)
    for (i, _), row in zip(rows, x, strict=True):
        assert by_id[i][1].deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True)) and by_id[i][1].n == n
    assert np.abs(np.cov(ours.T, bias=True).reshape(size, size) - np.eye(size)).max() < 1e-8 and got[0].identity_error < 1e-8


@pytest.mark.parametrize("kind", ["round", "stretched", "dependent"])
def test_whitening_equals_eigenvectors(spark, kind):
    pick = np.random.default_rng(3)
    x = pick.normal(size=(300, 10)) * (np.ones(10) if kind == "round" else np.logspace(4, -1, 10))
    x = x @ np.linalg.qr(pick.normal(size=(10, 10)))[0] + 7
    if kind == "dependent":
        # Two entries that repeat another, and one that is the same in all rows.
        x = np.concatenate([x, x[:, :2], np.full((300, 1), 5.0)], 1)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, VECTORS).repartition(5)
    check_whitening(rows, whitening.whiten(frame, most=8 if kind == "round" else 32).collect(), 8 if kind == "round" else 32)


def test_given_vectors(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    check_whitening(rows, whitening.whiten(frame).collect(), 32)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [0.0, 1.0]), (1, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [2.0, -1.0]), (None, [0.25, 0.0])]
    bad = [(5, None), (6, [None, 1.0]), (7, [nan, 1.0]), (8, [1.0, inf]), (9, [-inf, 0.0]), (10, []), (11, [1.0])]
    frame = spark.createDataFrame(good + bad, VECTORS).withColumns({c: F.lit("x") for c in ("x", "n", "component", "whitened", "c")})
    got = whitening.whiten(frame).collect()
    assert sorted((r.vec_id if r.vec_id is not None else -1, r.component) for r in got) == sorted(
        (i, k) for i in (-1, 0, 1, 1, 2) for k in (1, 2)
    )
    assert {r.n for r in got} == {5}
    for rows in ([], bad[:6], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]):
        assert whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect() == []
    with pytest.raises(Exception, match="beyond 2"):
        whitening.whiten(spark.createDataFrame([(1, [1e30]), (2, [1.0])], VECTORS)).collect()


def test_triangular_solve():
    pick = np.random.default_rng(1)
    r, rows = np.triu(pick.normal(size=(6, 6))) + 4 * np.eye(6), pick.normal(size=(9, 6))
    assert np.allclose(whitening.solve_right(rows, r) @ r, rows)
