"""Scores of many pairs at once against those of one pair, and the pairs found with them."""

import random

import pytest
from pyspark.sql import functions as F

from pathwarden.functions import similarity
from pathwarden.functions.batches import edit_distances, ratios
from pathwarden.operators import similarity_join, text_blocks, vectors
from pathwarden.operators.similarity_join import similar_pairs


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def some_pairs(letters, count):
    rnd = random.Random(5)
    text = lambda: "".join(rnd.choice(letters) for _ in range(rnd.choice([0, 1, 2, 9, 40, 64, 130, 199, 200, 260])))
    left = [text() for _ in range(count)]
    return left, [text() if rnd.random() < 0.5 else "".join(c for c in x if rnd.random() < 0.9) for x in left]


@pytest.mark.parametrize("letters", ["ab", "abé漢😀 \0", "abcdefgh0123456789/"])
def test_batches_score_as_single_pairs(letters):
    left, right = some_pairs(letters, 150)
    assert ratios(left, right).tolist() == [similarity._ratio(x, y) for x, y in zip(left, right)]
    assert edit_distances(left, right).tolist() == [distance(x, y) for x, y in zip(left, right)]


def test_texts_that_begin_or_end_alike_score_as_single_pairs():
    """Repeating texts too, whose longest common piece is not where they begin or end alike."""
    rnd, left, right = random.Random(4), [], []
    for _ in range(3000):
        letters, size = rnd.choice(["a", "ab", "0123456789/"]), rnd.choice([3, 12, 30, 60])
        text = "".join(rnd.choice(letters) for _ in range(size))
        if rnd.random() < 0.4:
            text = (text[: rnd.randint(1, 5)] * 30)[:size] + text[:3]
        cut = rnd.randint(0, len(text))
        left.append(text)
        right.append(rnd.choice([text[:cut] + rnd.choice(letters) + text[cut + 1 :], text[:cut] + text[cut + 2 :], text[cut:] + text[:cut], text + text[:cut]]))
    assert ratios(left, right).tolist() == [similarity._ratio(x, y) for x, y in zip(left, right)]


def test_weighted_scores_are_exact_from_the_least_one_on():
    rnd = random.Random(2)
    words = ["north", "South", "port-harbour", "bay", "12345", "é", "x", "terminal"]
    left = [" ".join(rnd.choices(words, k=rnd.randint(0, 5))) for _ in range(1500)]
    right = [rnd.choice([x, x[::-1], x + " bay", x[1:], " ".join(sorted(x.split())), rnd.choice(left)]) for x in left]
    single = [similarity.weighted_score(x, y) for x, y in zip(left, right)]
    for least in (0, 92, 95, 98, 100):
        found = similarity.weighted_scores(left, right, least)
        assert [s if s >= least else None for s in found] == [s if s >= least else None for s in single]
    assert {95, 100} <= set(single)


@pytest.mark.parametrize("scorer, across", [("levenshtein", False), ("ratio", True)])
def test_scored_parts_give_the_pairs_of_keys(spark, monkeypatch, scorer, across):
    """Blocks that are structs and share names, repeated names and rows, parts of a few rows, within one side and across two."""
    rnd = random.Random(6)
    names = [f"https://{rnd.choice(['www', 'm'])}.example.com/en/{rnd.randrange(400)}{rnd.choice(['', '/', '#top'])}" for _ in range(90)]
    rows = [(("A", k), i, n, n[8 : len(n) - k]) for i, n in enumerate(names) for k in (0, 1)]
    df = spark.createDataFrame(rows + rows[:6], "block struct<level: string, removed: int>, id bigint, name string, path string")
    monkeypatch.setattr(text_blocks.scored_pairs, "__defaults__", (20,))
    monkeypatch.setattr(text_blocks, "SCORED", 50)
    sides = (df.where("id % 2 = 0"), df.where("id % 2 = 1")) if across else (df, None)
    results = []
    for crowded in (-1, 1e9):
        monkeypatch.setattr(similarity_join, "CROWDED", crowded)
        found = similar_pairs(*sides, scorer=scorer, name_cutoff=88, path_cutoff=85, name_block="block.level", bare=True).collect()
        results.append(sorted(tuple(r) for r in found))
    assert results[0] == results[1] and len(results[0]) > 100


def test_scores_are_spread_over_tasks(spark):
    """Few bytes, much work: AQE must not put it into one task."""
    df = spark.range(64).select(F.lit("A").alias("block"), "id", F.concat(F.lit("place number "), "id").alias("name"), F.col("id").cast("string").alias("path"))
    met = text_blocks.near_pairs(df.select("block", "id", F.col("name").alias("text")), None, lambda a, b: a * 0, 9.0, rows_a_part=8)
    scored = text_blocks.scored_pairs(
        df.withColumns({"copies": F.lit(1), "name_block": F.col("block")}), None, "ratio", (0, 0), lambda a, b: a * 0, 9.0, rows_a_part=8
    )
    for pairs in (met, scored):
        assert pairs.count() == 64 * 63 // 2
        assert pairs.select(F.spark_partition_id().alias("p")).distinct().count() > 4


def test_texts_of_one_file_are_encoded_in_many_tasks(spark, monkeypatch):
    rows = [(i, f"place {i}", f"C{i}", f"ALL#C{i}", "CITY", False, "N1", 2) for i in range(200)]
    names = "row_id long, NAME string, CODE string, HIERARCHY string, LEVEL_NAME string, IS_GROUP boolean, PARENT string, LEVEL_NUMBER int"
    df = spark.createDataFrame(rows, names).withColumn("OFFICIAL_LEVEL_NAME", F.col("LEVEL_NAME")).coalesce(1)
    low = vectors.semantic_outliers(df, below=2.0)
    assert low.count() == 200 and low.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    seen = []
    whole = vectors.semantic_groups
    monkeypatch.setattr(vectors, "semantic_groups", lambda encoded, *a, **b: seen.append(encoded) or whole(encoded, *a, **b))
    assert vectors.semantic_duplicates(df, order="row_id") is not None
    assert seen[0].select(F.spark_partition_id().alias("p")).distinct().count() > 1
