"""Similarity joins, groups and vector operators against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pathwarden.functions.similarity import _ratio, weighted_score
from pathwarden.operators import fuzzy, vectors
from pathwarden.operators.grouping import covered_nodes, ordered_groups, ordered_members, seed_members
from pathwarden.operators.similarity_join import similar_pairs

STEMS = [
    "saint peter port", "port of new haven", "new haven port of", "abc", "ab", "x" * 30,
    "https://www.abcdef.example.com/a/123456", "the quick brown fox jumps over the lazy dog again and again",
]


def edited(rnd, text):
    chars = list(text)
    for _ in range(rnd.randint(0, 4)):
        kind = rnd.random()
        if chars and kind < 0.4:
            chars[rnd.randrange(len(chars))] = rnd.choice("abc #1")
        elif chars and kind < 0.7:
            del chars[rnd.randrange(len(chars))]
        else:
            chars.insert(rnd.randint(0, len(chars)), rnd.choice("abc #1"))
    return "".join(chars)


def some_names(count, seed=5):
    rnd = random.Random(seed)
    names = []
    for _ in range(count):
        name = edited(rnd, rnd.choice(STEMS))
        if rnd.random() < 0.15:
            words = name.split()
            rnd.shuffle(words)
            name = " ".join(words)
        names.append(name + (" port" if rnd.random() < 0.1 else ""))
    return names


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def levenshtein(a, b):
    longer = max(len(a), len(b))
    return 100 if longer == 0 else (200 * (longer - distance(a, b)) + longer) // (2 * longer)


SCORES = {"levenshtein": levenshtein, "ratio": _ratio, "weighted": weighted_score}


@pytest.mark.parametrize(
    "scorer,cutoff", [("levenshtein", 90), ("levenshtein", 60), ("ratio", 85), *[("weighted", c) for c in (91, 93, 95, 97)]]
)
def test_pairs_are_complete(spark, scorer, cutoff):
    rnd = random.Random(cutoff)
    nodes = [(rnd.choice("AB"), i, n) for i, n in enumerate([*some_names(100, cutoff), "new haven port authority x", "port authority new haven y"])]
    score = SCORES[scorer]
    truth = {
        (x[1], y[1])
        for x in nodes
        for y in nodes
        if x[1] < y[1] and x[0] == y[0] and max(score(x[2], y[2]), score(y[2], x[2])) >= cutoff
    }
    df = spark.createDataFrame(nodes, "block string, id bigint, name string")
    got = [(r["a"], r["b"]) for r in similar_pairs(df, scorer=scorer, name_cutoff=cutoff).collect()]
    assert len(got) == len(set(got)) and set(got) == truth
    across = similar_pairs(df.where("id % 3 = 0"), df.where("id % 3 <> 0"), scorer=scorer, name_cutoff=cutoff)
    assert {(r["a"], r["b"]) for r in across.collect()} == {(a, b) for a, b in truth if (a % 3 == 0) != (b % 3 == 0)}


def test_moved_tokens_are_found_below_95(spark):
    names = ["new haven port authority x", "port authority new haven y"]
    df = spark.createDataFrame([("A", i, n) for i, n in enumerate(names)], "block string, id bigint, name string")
    assert similar_pairs(df, scorer="weighted", name_cutoff=91).first()["name_score"] == weighted_score(*names) == 91


def test_joins_are_plain_and_lazy(spark):
    """No job runs while the plan is built, and Spark may split any exchange of the join."""
    df = spark.createDataFrame([("A", i, n) for i, n in enumerate(some_names(40))], "block string, id bigint, name string")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "build")
    try:
        pairs = similar_pairs(df, scorer="weighted", name_cutoff=91)
        assert tracker.getJobIdsForGroup("build") == []
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert "REPARTITION_BY" not in pairs._jdf.queryExecution().executedPlan().toString()


def sweep(nodes, similar):
    """The sequential sweep: (seed, member) pairs of groups of two or more."""
    taken, found = set(), set()
    for i in nodes:
        if i in taken:
            continue
        group = [j for j in nodes if j > i and j not in taken and similar(i, j)]
        if group:
            taken.update([i, *group])
            found.update((i, j) for j in [i, *group])
    return found


@pytest.mark.parametrize("options", [{}, {"head": 7, "peel_above": 10, "min_yield": 0.01}, {"head": 3, "peel_above": 10, "min_yield": 0.9}])
def test_groups_equal_the_sequential_sweep(spark, options):
    for seed in range(3):
        rnd = random.Random(seed)
        ids = sorted(rnd.sample(range(200), 60))
        edges = {(a, b) for a in ids for b in ids if a < b and rnd.random() < 0.06}
        nodes = spark.createDataFrame([("g", i) for i in ids], "block string, id bigint")
        every = spark.createDataFrame([("g", a, b) for a, b in edges], "block string, a bigint, b bigint").cache()

        def find(left, right=None):
            ids_of = lambda side, name: side.select(F.col("id").alias(name))
            if right is None:
                return every.join(ids_of(left, "a"), "a", "left_semi").join(ids_of(left, "b"), "b", "left_semi").select("block", "a", "b")
            one = every.join(ids_of(left, "a"), "a", "left_semi").join(ids_of(right, "b"), "b", "left_semi")
            two = every.join(ids_of(right, "a"), "a", "left_semi").join(ids_of(left, "b"), "b", "left_semi")
            return one.select("block", "a", "b").union(two.select("block", "a", "b"))

        got = {(r["seed"], r["id"]) for r in seed_members(nodes, find, **options).collect()}
        assert got == sweep(ids, lambda i, j: (i, j) in edges)

        near = lambda i, j: i == j or (min(i, j), max(i, j)) in edges
        visited, groups = set(), set()
        for i in ids:
            similar = [j for j in ids if near(i, j)]
            if i not in visited and len(similar) > 1:
                groups.update((i, j) for j in similar)
                visited.update(similar)
        got = {(r["seed"], r["id"]) for r in seed_members(nodes, find, all_neighbours=True, **options).collect()}
        assert got == groups


@pytest.mark.parametrize("sweep_edges", [2_000_000, 4])
def test_chain_takes_every_second_node(spark, sweep_edges):
    """In one sweep, and by ranges of the chain."""
    edges = spark.createDataFrame([("g", i, i + 1) for i in range(9)], "block string, a bigint, b bigint")
    assert sorted(r["id"] for r in covered_nodes(edges, sweep_edges).collect()) == [1, 3, 5, 7, 9]


def test_a_long_chain_takes_as_many_rounds_as_ranges(spark, monkeypatch):
    """100,000 links, one hanging on the other: the rounds are the ranges, not the links."""
    from pathwarden.operators import grouping as G

    stored, store = [], G.cut_lineage
    monkeypatch.setattr(G, "cut_lineage", lambda df, by=None: stored.append(by) or store(df, by))
    edges = spark.range(100_000).selectExpr("'g' as block", "id as a", "id + 1 as b")
    got = covered_nodes(edges, sweep_edges=20_000)
    # The edges, the edges by range, and two tables for each of five ranges.
    assert len(stored) == 12 and stored.count("range") == 1
    assert got.count() == 50_000 and got.where("id % 2 = 0").count() == 0


def ordered_sweep(pairs, places):
    taken, expected = set(), set()
    for i in sorted(places, key=lambda n: (places[n], n)):
        free = [j for j in sorted(places) if (i, j) in pairs and j not in taken]
        if i not in taken and free:
            taken.update([i, *free])
            expected.update((i, j) for j in [i, *free])
    return expected


@pytest.mark.parametrize("sweep_edges", [2_000_000, 40])
def test_ranges_give_the_sequential_sweep(spark, sweep_edges):
    """Random graphs in several blocks of other sizes, a hub among them, by id and by another order."""
    rnd = random.Random(sweep_edges)
    graphs = {}
    for block, size in (("x", 40), ("y", 12), ("z", 3)):
        pairs = {(a, b) for a in range(size) for b in range(a + 1, size) if rnd.random() < 0.1} | {(1, b) for b in range(2, size)}
        graphs[block] = pairs, {i: rnd.randrange(size) for i in range(size)}
    block = lambda g: (g, 1)
    edges = spark.createDataFrame([(block(g), a, b) for g, (pairs, _) in graphs.items() for a, b in pairs], "block struct<level: string, n: int>, a bigint, b bigint")
    order = spark.createDataFrame([(block(g), i, p) for g, (_, places) in graphs.items() for i, p in places.items()], "block struct<level: string, n: int>, id bigint, place bigint")
    covered, groups = covered_nodes(edges, sweep_edges).collect(), ordered_groups(edges, order, sweep_edges).collect()
    for g, (pairs, places) in graphs.items():
        seeds = []
        for i in places:
            if not any((s, i) in pairs for s in seeds):
                seeds.append(i)
        assert sorted(r["id"] for r in covered if r["block"]["level"] == g) == [i for i in places if i not in seeds]
        assert {(r["seed"], r["id"]) for r in groups if r["block"]["level"] == g} == ordered_sweep(pairs, places)
    assert len(groups) == len({(r["block"], r["id"]) for r in groups})


def test_no_edges_give_no_groups(spark):
    edges = spark.createDataFrame([], "block string, a bigint, b bigint")
    order = spark.createDataFrame([("g", 1, 1)], "block string, id bigint, place bigint")
    assert covered_nodes(edges).count() == ordered_groups(edges, order).count() == 0


def test_groups_in_another_order(spark):
    """Rows are visited by place and take rows of a larger id only, in no group yet."""
    pairs = {(1, 2), (2, 3), (3, 4), (1, 4), (5, 6), (5, 7), (6, 7)}
    edges = spark.createDataFrame([("g", a, b) for a, b in pairs], "block string, a bigint, b bigint")
    for places in ([4, 3, 2, 1, 7, 6, 5], [1, 2, 3, 4, 5, 6, 7], [2, 1, 4, 3, 7, 5, 6]):
        placed = dict(enumerate(places, 1))
        order = spark.createDataFrame([("g", i, p) for i, p in placed.items()], "block string, id bigint, place bigint")
        assert {(r["seed"], r["id"]) for r in ordered_groups(edges, order).collect()} == ordered_sweep(pairs, placed)


def locations(names, paths=None, levels=None):
    rows = []
    for i, name in enumerate(names):
        path = paths[i] if paths else f"ALL#W#{i % 3}"
        rows.append((i, name, f"C{i}", path, False, None, levels[i] if levels else "CITY"))
    return rows


SCHEMA = "row_id bigint, NAME string, CODE string, HIERARCHY string, IS_GROUP boolean, CHILDREN string, LEVEL_NAME string"


def name_sweep(rows, k, cutoff, score):
    """Top-k matches per row in order; groups as lists of row numbers."""
    done, groups = set(), []
    for i, name in rows:
        if i in done:
            continue
        ranked = sorted(((score(name, n), -j) for j, n in rows), reverse=True)[:k]
        matched = [-j for s, j in ranked if s >= cutoff]
        if len(matched) > 1:
            groups.append((i, matched))
            names = {n for j, n in rows if j in matched}
            done.update(j for j, n in rows if n in names)
    return groups


@pytest.mark.parametrize("scorer,cutoff", [("weighted", 95), ("levenshtein", 85)])
def test_name_groups_equal_the_sweep(spark, scorer, cutoff):
    names = some_names(70, seed=8) + ["saint peter port"] * 7 + ["SAINT PETER PORT"] * 3
    random.Random(4).shuffle(names)
    levels = ["CITY" if i % 3 else "PORT" for i in range(len(names))]
    df = spark.createDataFrame(locations(names, levels=levels), SCHEMA)
    groups = fuzzy.group_by_name(fuzzy.similar_names(df, scorer=scorer, cutoff=cutoff)).collect()
    expected = set()
    for level in ("CITY", "PORT"):
        rows = [(i, n) for i, n in enumerate(names) if levels[i] == level]
        for group, matched in name_sweep(rows, 5, cutoff, SCORES[scorer]):
            expected.update((level, group, rank, row) for rank, row in enumerate(matched, 1))
    rows_of = lambda items: {(g[0], g[3]) for g in items}
    got = {(r["block"], r["group"], r["rank"], r["row"]) for r in groups}
    assert rows_of(got) == rows_of(expected)
    # A name outside its own top five opens a group per row in the sweep, of the same rows.
    assert got <= expected


def test_path_groups_with_copies(spark):
    rnd = random.Random(2)
    names = [rnd.choice(["alpha beta", "alpha bet", "gamma delta", "gamma delt"]) for _ in range(60)]
    paths = [rnd.choice(["ALL#W#FRA#X1", "ALL#W#FRA#X2", "ALL#W#DEU#LONGER#Y"]) for _ in range(60)]
    df = spark.createDataFrame(locations(names, paths), SCHEMA)
    similar = lambda i, j: _ratio(names[i], names[j]) >= 90 and _ratio(paths[i], paths[j]) >= 90
    got = fuzzy.similar_groups(df, name_cutoff=90, path_cutoff=90)
    assert {(r["seed"], r["id"]) for r in got.collect()} == sweep(range(60), similar)
    strip = lambda p, k: p if k == 0 else "#".join(p.split("#")[:-k])
    stripped = fuzzy.similar_groups_stripped(df, [0, 1, 2])
    for k in (0, 1, 2):
        similar = lambda i, j: _ratio(names[i], names[j]) >= 90 and _ratio(strip(paths[i], k), strip(paths[j], k)) >= 90
        assert {(r["seed"], r["id"]) for r in stripped.where(F.col("levels") == k).collect()} == sweep(range(60), similar)


def test_names_in_several_blocks_meet_once(spark):
    """Pairs by names of the level equal those by names of each block, for one side and for two."""
    rnd = random.Random(4)
    names = ["alpha beta", "alpha bet", "alpha", "gamma delta", "gamma delt", ""]
    rows = [(("x" if i % 3 else "y", i % 4 // 2), i, rnd.choice(names), rnd.choice(["A#B#C1", "A#B#C2", "A#LONGER#Y", ""])) for i in range(80)]
    nodes = spark.createDataFrame(rows, "block struct<level: string, n: int>, id bigint, name string, path string")
    close = lambda a, b: _ratio(a, b) >= 90
    # Two empty texts are alike.
    wanted = {(i, j) for b, i, n, p in rows for c, j, m, q in rows if b == c and i < j and (n == m or close(n, m)) and (p == q or close(p, q))}
    for right in (False, True):
        sides = (nodes,) if not right else (nodes.where("id % 2 = 0"), nodes.where("id % 2 = 1"))
        for block in ("block", "block.level"):
            found = similar_pairs(*sides, scorer="ratio", name_cutoff=90, path_cutoff=90, name_block=block).collect()
            pairs = [(r["a"], r["b"]) for r in found]
            assert len(pairs) == len(set(pairs)) and set(pairs) == {(i, j) for i, j in wanted if not right or (i - j) % 2}


def test_members_in_another_order_without_all_pairs(spark):
    """Two blocks of other sizes, dense clusters among them, ids that repeat: the sweep's groups, and no full list of pairs."""
    rnd = random.Random(9)
    graphs, rows = {}, []
    for block, size in (("x", 30), ("y", 8)):
        cluster = [rnd.randrange(3) for _ in range(size)]
        pairs = {(a, b) for a in range(size) for b in range(a + 1, size) if rnd.random() < (0.9 if cluster[a] == cluster[b] else 0.02)}
        places = {i: rnd.choice([i, rnd.randrange(size)]) for i in range(size)}
        graphs[block] = pairs, places
        rows += [((block, 1), i, p) for i, p in places.items()] + [((block, 1), 3, places[3])]
    edges = spark.createDataFrame([((g, 1), a, b) for g, (pairs, _) in graphs.items() for a, b in pairs], "block struct<level: string, n: int>, a bigint, b bigint")
    nodes = spark.createDataFrame(rows, "block struct<level: string, n: int>, id bigint, place bigint")
    listed = []

    def find(left, right=None):
        of = lambda side, name: side.select("block", F.col("id").alias(name)).distinct()
        if right is None:
            found = edges.join(of(left, "a"), ["block", "a"], "left_semi").join(of(left, "b"), ["block", "b"], "left_semi")
        else:
            cross = lambda x, y: edges.join(of(x, "a"), ["block", "a"], "left_semi").join(of(y, "b"), ["block", "b"], "left_semi")
            found = cross(left, right).unionByName(cross(right, left))
        listed.append(found.count())
        return found

    groups = ordered_members(nodes, find, head=6, peel_above=14, min_yield=0.01).collect()
    for g, (pairs, places) in graphs.items():
        assert {(r["seed"], r["id"]) for r in groups if r["block"]["level"] == g} == ordered_sweep(pairs, places)
    assert len(listed) >= 3 and listed[-1] < edges.count() / 2


def test_static_detection_lists_a_row_once(spark):
    names = ["alpha beta"] * 3 + ["gamma delta"] * 2 + ["lonely one"]
    paths = ["A#B#C1", "A#B#C2", "A#Q#LONGCODE", "A#SOMEWHERE#X", "A#ELSEWHERE#YY", "A#B"]
    df = spark.createDataFrame(locations(names, paths), SCHEMA)
    got = {r["row_id"]: r["LEVELS_REMOVED"] for r in fuzzy.static_detection(df).collect()}
    # Two levels off, the third one's path equals the others'.
    assert got == {0: "1 LEVELS", 1: "1 LEVELS", 2: "2 LEVELS", 3: "2 LEVELS", 4: "2 LEVELS"}
    assert {r["row_id"] for r in fuzzy.name_duplicates(df).collect()} == {0, 1, 2, 3, 4}


def unit_rows(count, width, seed, clusters=8, noise=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, width))
    points = centres[rng.integers(clusters, size=count)] + noise * rng.normal(size=(count, width))
    points[count // 2] = 0
    return [(int(i), [float(x) for x in p]) for i, p in enumerate(points)]


def cosine_matrix(rows):
    m = np.array([r[1] for r in rows])
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    u = np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)
    return u @ u.T


@pytest.mark.parametrize("threshold,chunk", [(0.98, 2000), (0.98, 40), (0.9, 60), (0.3, 90)])
def test_cosine_pairs_are_complete(spark, threshold, chunk):
    rows = unit_rows(900, 8, 1)
    df = spark.createDataFrame(rows, "id bigint, vector array<double>")
    cosine = cosine_matrix(rows)
    truth = {(i, j) for i, j in zip(*np.nonzero(cosine > threshold)) if i < j}
    got = [(r["a"], r["b"]) for r in vectors.cosine_pairs(df, threshold=threshold, chunk=chunk).collect()]
    assert len(got) == len(set(got)) and set(got) == truth
    across = vectors.cosine_pairs(df.where("id % 5 = 0"), df.where("id % 5 <> 0"), threshold=threshold, chunk=chunk)
    assert {(r["a"], r["b"]) for r in across.collect()} == {(a, b) for a, b in truth if (a % 5 == 0) != (b % 5 == 0)}


def unit_nodes(spark, rows):
    nodes = vectors.with_unit(spark.createDataFrame(rows, "id bigint, vector array<double>"), "vector", "u")
    return nodes.select("id", "u").where(F.exists("u", lambda x: x != 0))


def compared(blocks):
    """The number of pairs that the block products compare."""
    keys = ["kind", "cell", "x", "y"]
    one, two = (side.groupBy(*keys).agg(F.count("*").alias(name)) for side, name in zip(blocks, ("one", "two")))
    return one.join(two, keys).agg(F.sum(F.col("one") * F.col("two"))).first()[0]


@pytest.mark.parametrize("threshold", [0.45, 0.9])
def test_clustered_vectors_are_hardly_compared(spark, threshold):
    count = 6000
    nodes = unit_nodes(spark, unit_rows(count, 64, 2, clusters=40, noise=0.3))
    assert compared(vectors.compared_blocks(nodes, None, threshold, chunk=100)) < count * count / 20
    some, rest = nodes.where("id % 3 = 0"), nodes.where("id % 3 <> 0")
    assert compared(vectors.compared_blocks(some, rest, threshold, chunk=100)) < count * count / 20


def test_vectors_without_clusters_are_one_cell(spark):
    rng = np.random.default_rng(4)
    nodes = unit_nodes(spark, [(i, rng.normal(size=64).tolist()) for i in range(700)])
    assert vectors._cells(nodes, 0.3, 700) is None
    assert compared(vectors.compared_blocks(nodes, None, 0.3)) == 700 * 700


@pytest.mark.parametrize("threshold", [-0.2, 0.05, 0.4, 0.7])
def test_bounds_lose_no_pair_at_low_thresholds(spark, threshold):
    rng = np.random.default_rng(8)
    # Small clusters, some of them near to each other, loose rows between them, ties and a zero vector.
    rows = unit_rows(1200, 24, 9, clusters=30, noise=0.4)
    rows += [(1200 + i, rng.normal(size=24).tolist()) for i in range(60)] + [(1260 + i, np.eye(24)[i % 5].tolist()) for i in range(40)]
    cosine = cosine_matrix(rows)
    truth = {(i, j) for i, j in zip(*np.nonzero(cosine > threshold)) if i < j}
    unsure = {(i, j) for i, j in zip(*np.nonzero(np.abs(cosine - threshold) < 1e-9))}
    df = spark.createDataFrame(rows, "id bigint, vector array<double>")
    got = [(r["a"], r["b"]) for r in vectors.cosine_pairs(df, threshold=threshold, chunk=70).collect()]
    assert len(got) == len(set(got)) and not (set(got) ^ truth) - unsure
    across = vectors.cosine_pairs(df.where("id % 4 = 0"), df.where("id % 4 <> 0"), threshold=threshold).collect()
    crossing = {(a, b) for a, b in truth if (a % 4 == 0) != (b % 4 == 0)}
    assert not ({(r["a"], r["b"]) for r in across} ^ crossing) - unsure


@pytest.mark.parametrize("options", [{}, {"head": 20, "peel_above": 50}])
def test_semantic_groups_equal_the_sweep(spark, options):
    rows = unit_rows(150, 6, 3, clusters=40, noise=0.1)
    rows += [(150 + i, rows[i % 7][1]) for i in range(30)]
    cosine = cosine_matrix(rows)
    visited, expected = set(), set()
    for i in range(len(rows)):
        similar = np.flatnonzero(cosine[i] > 0.97).tolist()
        if i not in visited and len(similar) > 1:
            expected.update((i, j) for j in similar)
            visited.update(similar)
    df = spark.createDataFrame(rows, "row_id bigint, vector array<double>")
    got = vectors.semantic_groups(df, 0.97, **options).collect()
    assert {(r["seed"], r["id"]) for r in got} == expected
    assert len(got) == len(expected)


def test_mean_similarity_equals_the_matrix_mean(spark):
    rows = unit_rows(80, 5, 7)
    df = spark.createDataFrame(rows, "id bigint, vector array<float>")
    got = {r["id"]: r["mean_similarity"] for r in vectors.mean_similarity(df).collect()}
    assert np.allclose([got[i] for i in range(80)], cosine_matrix(rows).mean(axis=1), atol=1e-6)


def test_encoded_texts(spark):
    df = spark.createDataFrame([(1, "port louis"), (2, "port louis"), (3, "something else"), (4, "")], "id int, text string")
    got = {r["id"]: np.array(r["vector"]) for r in vectors.encode_text(df).collect()}
    assert np.allclose(got[1], got[2]) and got[1] @ got[2] == pytest.approx(1, abs=1e-5)
    assert got[1] @ got[3] < 0.5 and not got[4].any()


def test_copies_of_a_vector_are_bounded_by_the_parts(spark):
    """Rows go to parts, not to cells: the most copies of a row do not grow with the number of cells."""
    rng = np.random.default_rng(5)
    # Near pairs among vectors without clusters: bounds spare few cells.
    nodes = unit_nodes(spark, [(i, rng.normal(size=16).tolist()) for i in range(4000)])
    first, second = vectors.compared_blocks(nodes, None, 0.9)
    assert first.count() + second.count() <= 4000 * (1 + -(-4000 // vectors.CHUNK_ROWS) + 1)


def test_equal_vectors_are_one_node_by_their_digest(spark):
    rows = [(i, [1.0, float(i % 3 == 0), 0.0]) for i in range(12)]
    df = spark.createDataFrame(rows, "id bigint, vector array<double>")
    got = {(r["seed"], r["id"]) for r in vectors.semantic_groups(df, 0.98, "id").collect()}
    assert got == {(i % 3 > 0, i) for i in range(12)}
