"""Joins with one key holding a third of the rows, and the fuzzy lookups."""

import pytest
from pyspark.sql import functions as F

from pathwarden.functions.similarity import plain_ratio, weighted_score
from pathwarden.operators import hierarchy as H
from pathwarden.operators import joins as J
from pathwarden.operators import rows as R


def skewed(spark):
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 == 1, F.lit(None)).otherwise(F.col("id") % 50)
    return spark.range(0, 3000, 1, 6).select(key.cast("int").alias("k"), F.lit("copy").alias("v"))


@pytest.mark.parametrize("hot_side", ["left", "right"])
def test_a_hot_key_of_either_side_is_split(spark, hot_side):
    """A key with a third of the rows goes to several tasks, whichever side has it."""
    hot = spark.range(0, 60_000, 1, 12).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("int").alias("k"), F.lit("x" * 50).alias("v"))
    few = spark.range(0, 60_000, 1, 4).select(F.col("id").cast("int").alias("k"), F.lit("y" * 20).alias("w"))
    settings = {"autoBroadcastJoinThreshold": "-1", "adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k"}
    settings |= {"adaptive.advisoryPartitionSizeInBytes": "1k", "adaptive.skewJoin.skewedPartitionFactor": "1.2", "adaptive.coalescePartitions.enabled": "false"}
    settings = {f"spark.sql.{k}": v for k, v in settings.items()}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = J.inner_on_key(*((hot, few) if hot_side == "left" else (few, hot)), "k")
        assert len(joined.collect()) == joined.where("k is not null").count() == 60_000
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_small_tables_are_checked(spark, monkeypatch):
    monkeypatch.setattr(J, "SMALL_ROWS", 3)
    df = spark.createDataFrame([("a#b",)], "path string")
    large = spark.createDataFrame([(c, c) for c in "abcd"], "prefix string, v string")
    assert J.under_prefix(df, "path", large, "prefix", ["v"]).first()["v"] == "a"
    with pytest.raises(Exception, match="over 3 rows"):
        J.under_prefix(df, "path", large, "prefix", ["v"], small=True).collect()


def test_lookups_take_a_million_codes(spark):
    codes = spark.range(1_000_000).selectExpr("concat('C', id) as CODE", "concat('ALL#W#C', id) as HIERARCHY", "false as IS_GROUP")
    paths = ["ALL#W#C7#C999999#X", "ALL#W#C999999", "ALL#W#X", "ALL", None, "ALL#W#C1234567#C5", "ALL#W#C55#a#b"]
    df = spark.createDataFrame([(p, False) for p in paths], "HIERARCHY string, IS_GROUP boolean")
    got = {r["HIERARCHY"]: r["PARENT"] for r in H.first_ancestor_in(df, codes).collect()}
    assert got == dict(zip(paths, ["C7", "C999999", None, None, None, "C5", "C55"], strict=True))
    got = {r["HIERARCHY"]: r["LEVEL_NUMBER"] for r in H.assign_level_number(df, codes).collect()}
    assert got == dict(zip(paths, [2, 0, None, None, None, None, 2], strict=True))


@pytest.mark.parametrize("rows", [1, 7, 10_000])
def test_best_match_over_choices_in_parts(spark, monkeypatch, rows):
    """However the choices are cut, the result is that of all of them."""
    import random

    monkeypatch.setattr(J, "SMALL_ROWS", rows)
    pick = random.Random(1)
    words = sorted({"".join(pick.choice("abc") for _ in range(4)) for _ in range(25)})
    choices = [(pick.randrange(9), w) for w in words]
    dim = spark.createDataFrame(choices + [(20, words[0])], "ordinal bigint, choice string")
    names = sorted({"".join(pick.choice("abc") for _ in range(4)) for _ in range(12)})
    df = spark.createDataFrame([(n,) for n in [*names, names[0], None]], "n string")
    got = J.best_match(df, "n", dim, "levenshtein", 60).collect()
    assert len(got) == len(names) + 2 and [r["score"] for r in got if r["n"] is None] == [None]

    def distance(a, b):
        line = list(range(len(b) + 1))
        for x in a:
            before, line[0] = line[0], line[0] + 1
            for n, y in enumerate(b, 1):
                before, line[n] = line[n], min(line[n] + 1, line[n - 1] + 1, before + (x != y))
        return line[-1]

    for r in got:
        if r["n"] is not None:
            least, ordinal = min((distance(r["n"], w), o) for o, w in choices)
            best = {w for o, w in choices if distance(r["n"], w) == least and o == ordinal}
            assert r["score"] == 100 - 25 * least
            assert r["match"] in best if r["score"] >= 60 else r["match"] is None
    assert J.best_match(df, "n", dim.limit(0), "levenshtein", 60).where("score is not null").count() == 0


def test_null_keys(spark):
    a = spark.createDataFrame([("x",), (None,), ("",)], "k string")
    b = spark.createDataFrame([("x",), (None,)], "k string")
    assert [r["k"] for r in J.anti_by_key(a, b, "k").collect()] == [""]
    assert sorted(str(r["k"]) for r in J.anti_by_key(a, b, "k", null_matches_null=False).collect()) == ["", "None"]
    assert J.inner_on_key(a, b, "k").count() == 1
    assert J.semi_by_key(a, b, "k").count() == 1


def test_last_entry_of_a_dimension_wins(spark):
    df = spark.createDataFrame([("a", "old", 1), ("a", "new", 2), ("b", "only", None)], "k string, v string, o int")
    dim = J.dimension(df, F.col("k"), "k", {"v": F.col("v")}, F.col("o"))
    assert {(r["k"], r["v"]) for r in dim.collect()} == {("a", "new"), ("b", "only")}


def test_keyed_update_keeps_what_is_not_given(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, n int, t string")
    changes = spark.createDataFrame([("a", None, "z")], "k string, n int, t string")
    assert {tuple(r) for r in J.keyed_update(df, changes, "k").collect()} == {("a", 1, "z"), ("b", 2, "y")}


def test_prefixes_match_at_separators(spark):
    df = spark.createDataFrame([("A#GBR#X",), ("A#GB#X",), ("A#GB",), ("Z",), (None,)], "path string")
    prefixes = spark.createDataFrame([("A#GB", "short"), ("A#GB#X", "long")], "prefix string, v string")
    for small in (True, False):
        got = {r["path"]: r["v"] for r in J.under_prefix(df, "path", prefixes, "prefix", ["v"], small).collect()}
        assert got == {"A#GBR#X": None, "A#GB#X": "long", "A#GB": "short", "Z": None, None: None}
    assert "Exchange hash" not in J.under_prefix(df, "path", prefixes, "prefix", ["v"], small=True)._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]


def test_best_match_is_exact(spark):
    names = ["Frnace", "Germany ", "unite states", "xyz", "ITALY", "Frnace"]
    choices = ["France", "Germany", "United States", "Italy", "Greece", "Franc"]
    df = spark.createDataFrame([(n,) for n in names] + [(None,)], "n string")
    dim = spark.createDataFrame(list(enumerate(choices)), "ordinal bigint, choice string")
    for scorer, score in [("ratio_plain", plain_ratio), ("weighted", weighted_score)]:
        expected = []
        for n in names:
            top = max(score(n, c) for c in choices)
            expected.append((n, next(c for c in choices if score(n, c) == top) if top >= 60 else None, top))
        repeated = dim.unionByName(dim.selectExpr("ordinal + 10 as ordinal", "choice"))
        got = J.best_match(df, "n", repeated, scorer, 60).where("n is not null").collect()
        assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def test_best_match_levenshtein_ties_go_to_the_first(spark):
    df = spark.createDataFrame([("ab",)], "n string")
    dim = spark.createDataFrame([(5, "aX"), (3, "aY"), (9, "aZ")], "ordinal bigint, choice string")
    assert J.best_match(df, "n", dim, "levenshtein", 50).first()["match"] == "aY"


def test_ordinals_follow_the_order(spark):
    df = spark.range(0, 1000, 1, 7).select(((F.col("id") * 37) % 1000).alias("x"))
    got = R.with_ordinal(df, ["x"]).collect()
    assert sorted((r["x"], r["ordinal"]) for r in got) == [(i, i) for i in range(1000)]


def test_top_k_is_cut_before_the_shuffle(spark):
    df = spark.range(0, 100, 1, 4).select((F.col("id") % 3).alias("k"), "id")
    top = R.top_k(df, ["k"], [F.desc("id")], 2)
    assert sorted(map(tuple, top.collect())) == [(0, 96), (0, 99), (1, 94), (1, 97), (2, 95), (2, 98)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
