"""Names compared in parts, where keys would bring most of them together."""

import random

import numpy as np
import pandas as pd
import pytest

from pathwarden.operators import similarity_join, text_blocks
from pathwarden.operators.similarity_join import similar_pairs
from pathwarden.operators.text_blocks import near_pairs


def common_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_parts_find_every_pair_of_enough_common_characters(spark):
    """Texts of no, one and several words of bits, characters of any plane, blocks that are structs, parts of any size."""
    rnd = random.Random(3)
    text = lambda: "".join(rnd.choice("abé\0漢😀") for _ in range(rnd.choice([0, 1, 5, 60, 64, 65, 130])))
    rows = [((rnd.choice("xy"), 1), i, text()) for i in range(90)]
    df = spark.createDataFrame(rows, "block struct<level: string, n: int>, id bigint, text string")
    needed = lambda a, b: np.ceil(0.6 * np.maximum(a, b))
    wanted = {
        (i, j) for b, i, s in rows for c, j, t in rows if b == c and i < j and common_length(s, t) >= np.ceil(0.6 * max(len(s), len(t)))
    }
    found = [(r["a"], r["b"]) for r in near_pairs(df, None, needed, 1 / 0.6, rows_a_part=20).collect()]
    assert len(found) == len(set(found)) and set(found) == wanted
    across = near_pairs(df.where("id % 2 = 0"), df.where("id % 2 = 1"), needed, 1 / 0.6, rows_a_part=20).collect()
    assert {(r["a"], r["b"]) for r in across} == {(i, j) for i, j in wanted if (i - j) % 2}


@pytest.mark.parametrize("scorer", ["levenshtein", "ratio"])
def test_crowded_names_give_the_same_pairs_by_keys_and_in_parts(spark, monkeypatch, scorer):
    rnd = random.Random(6)
    names = [f"https://{rnd.choice(['www', 'm'])}.example.com/en/{rnd.randrange(4000)}{rnd.choice(['', '/', '#top'])}" for _ in range(120)]
    df = spark.createDataFrame([("A", i, n, n[8:]) for i, n in enumerate(names)], "block string, id bigint, name string, path string")
    results = []
    for crowded in (-1, 1e9):
        monkeypatch.setattr(similarity_join, "CROWDED", crowded)
        found = similar_pairs(df, scorer=scorer, name_cutoff=90, path_cutoff=85).collect()
        results.append(sorted((r["a"], r["b"], r["a_name"], r["name_score"], r["path_score"]) for r in found))
    assert results[0] == results[1] and len(results[0]) > 100


@pytest.mark.parametrize("kinds, bits, dense", [(64, 255, 0.3), (2, 255, 2), (3, 5, -1), (64, 9, 2)])
def test_counts_bound_what_texts_have_in_common(monkeypatch, kinds, bits, dense):
    """Few kinds, few bits, pairs that advance one by one or all together: no pair is lost, and few are left to compare."""
    for name, value in (("KINDS", kinds), ("COUNT_BITS", bits), ("DENSE", dense), ("ALONE", 50), ("COUNTED", 7), ("TOGETHER", 3)):
        monkeypatch.setattr(text_blocks, name, value)
    rnd = random.Random(bits)
    text = lambda: "".join(rnd.choice("abcdé\0漢😀") for _ in range(rnd.choice([0, 1, 20, 64, 65, 130])))
    sides = [[text() for _ in range(40)] for _ in "ab"]
    sides[1] += ["".join(c for c in t if rnd.random() < 0.9) for t in sides[0]]
    one, two = (text_blocks.Texts(pd.DataFrame({"id": range(len(side)), "text": side})) for side in sides)
    symbols = np.unique(one.points)
    bound = text_blocks.Counts(one.numbered(symbols), two.numbered(symbols), len(symbols)).bound(0, len(one.ids), 0, len(two.ids))
    common = np.array([[common_length(sides[0][i], sides[1][j]) for j in two.ids] for i in one.ids])
    assert (bound >= common).all()
    needed = lambda a, b: np.ceil(0.8 * np.maximum(a, b))
    wanted = {(i, j) for i, j in zip(*np.nonzero(common >= needed(one.sizes[:, None], two.sizes[None, :])))}
    found = [pair for i, j in text_blocks.near_texts(one, two, needed, 1 / 0.8) for pair in zip(i, j)]
    assert len(found) == len(set(found)) and set(found) == wanted and len(wanted) > 20
    if bits == 255 and kinds == 64:
        assert (bound >= needed(one.sizes[:, None], two.sizes[None, :])).mean() < 0.2


@pytest.mark.parametrize("crowded", [-1, 1e9])
def test_a_choice_made_now_leaves_one_way_in_the_plan(spark, monkeypatch, crowded):
    """Groups made in rounds read pairs again and again: a plan with both ways filled the driver's memory."""
    monkeypatch.setattr(similarity_join, "CROWDED", crowded)
    df = spark.createDataFrame([("A", i, f"place number {i % 9}{i}", f"A#{i}") for i in range(30)], "block string, id bigint, name string, path string")
    plan = lambda pairs: pairs._jdf.queryExecution().optimizedPlan().toString()
    for options in ({"name_cutoff": 92, "path_cutoff": 60, "bare": True, "scorer": "ratio"}, {"name_cutoff": 95, "scorer": "weighted"}):
        later, now = similar_pairs(df, **options), similar_pairs(df, now=True, **options)
        assert ("FlatMapCoGroupsInPandas" in plan(now)) == (crowded == -1)
        assert "scalar-subquery" not in plan(now) and len(plan(now)) < len(plan(later)) / 2
        assert sorted(map(tuple, now.collect())) == sorted(map(tuple, later.collect())) != []
