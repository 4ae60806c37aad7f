"""Plans are built without running queries, and answers that no registered table exercises."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from pathwarden.functions.text import title_name
from pathwarden.model import PROCESSED_SCHEMA
from pathwarden.operators import checks as C
from pathwarden.operators import hierarchy as H
from pathwarden.operators import joins
from pathwarden.operators import rules as R
from pathwarden.operators import vectors as V
from pathwarden.operators import violations
from pathwarden.operators.joins import under_prefix

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["h6_first_ancestor_in", "h10_assign_level_number", "h16_official_level_name", "c9_missing_parent", "e10_orphan_rows", "j1_orders_of_customers", "j6_best_match", "j7_under_prefix"])
def test_building_a_plan_runs_no_query(spark, name):
    """Reading a Parquet footer is a job of its own; nothing else may run."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    frame = queries()[name](spark, SF)
    assert store.executionsCount() == before
    assert frame.columns


def test_small_lookups_do_not_shuffle(spark):
    df = spark.createDataFrame([("A#B", "x")], "HIERARCHY string, v string")
    codes = spark.createDataFrame([("A",)], "CODE string")
    prefixes = codes.selectExpr("CODE as prefix", "1 as n")
    for found in (H.first_ancestor_in(df, codes, small=True), under_prefix(df, "HIERARCHY", prefixes, "prefix", ["n"], small=True)):
        main = found._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
        assert "Join" not in main and "posexplode" not in main and found.count() == 1


@pytest.mark.parametrize("name", ["h6_first_ancestor_in", "h10_assign_level_number", "h16_official_level_name", "j6_best_match", "j7_under_prefix"])
def test_lookups_have_no_limit(spark, monkeypatch, name):
    """The same rows if no table counts as small."""
    usual = sorted(map(str, queries()[name](spark, SF).collect()))
    monkeypatch.setattr(joins, "SMALL_ROWS", 1)
    assert sorted(map(str, queries()[name](spark, SF).collect())) == usual


def test_titles_begin_after_any_other_character(spark):
    names = {"GUINEA-BISSAU": "Guinea-Bissau", "cote d'ivoire": "Cote D'Ivoire", " saint_lucia ": "Saint Lucia", "éire 1st": "Éire 1St", "": ""}
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert {r["n"]: r["t"] for r in df.select("n", title_name(F.col("n")).alias("t")).collect()} == names
    assert all(n.lower().strip().replace("_", " ").title() == t for n, t in names.items())


def test_a_path_of_many_segments_is_counted_whole(spark):
    path = "#".join(["P", *["s"] * 1500])
    df = spark.createDataFrame([("n", "c", path, False, "[]", "CITY", "P", 1500, "CITY")], PROCESSED_SCHEMA)
    assert df.where(R.RULES[R.LEVEL_MATCHES][1]()).count() == 1


def test_a_repeated_country_keeps_its_first_place(spark):
    """Two names equally like the unknown one: the first place wins, with the values of the last entry."""
    rows = [("Abc", "One", 0), ("Abd", "Two", 1), ("Abc", "Three", 2)]
    reference = spark.createDataFrame(rows, "country string, continent_name string, ordinal bigint")
    countries = spark.createDataFrame([("C1", "Abx")], "CODE string, NAME string")
    known = spark.createDataFrame([("none", "Europe")], "country string, continent string")
    got = H.assign_continent(countries, known, reference, scorer="levenshtein", above=60).first()
    assert got["CONTINENT"] == "Three"


def test_a_missing_level_word_is_left_out(spark):
    df = spark.createDataFrame([("FRA", "region", 1)], "PARENT string, LEVEL_NAME string, LEVEL_NUMBER int")
    entry = [("FRA", "France", "Europe", [None, "Region"], None, None, 0)]
    kinds = "code string, country string, continent_name string, level_1 array<string>, level_2 string, level_3 string, ordinal bigint"
    for scorer in ("ratio_plain", "levenshtein"):
        assert H.official_level_name(df, spark.createDataFrame(entry, kinds), scorer).first()["OFFICIAL_LEVEL_NAME"] == "REGION"


def test_rows_without_a_vector_have_no_measure(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 1.0])], "id int, vector array<double>")
    got = {r["id"]: r["mean_similarity"] for r in V.mean_similarity(df).collect()}
    assert got == {1: 0.5, 2: None, 3: 0.5}


def test_rows_behind_any_constraint(spark):
    row = lambda name, code, number: (name, code, "ALL#X#Y", False, "[]", "CITY", "P", number, "CITY")
    df = spark.createDataFrame([row("a", "1", 1), row("a", "2", 5), row(None, "3", None)], PROCESSED_SCHEMA)
    check = C.Check("Error", "own").is_unique("NAME").satisfies("LEVEL_NUMBER < 3", "low").has_pattern("NAME", "^b").has_distinctness(["NAME"], lambda x: x > 2)
    found = violations.extract_all(df, C.run_suite(df, [check]), [check])
    assert {(r["PROBLEM"], r["CODE"]) for r in found.collect()} == {
        ("UniquenessConstraint - Duplicate NAME entries", "1"),
        ("UniquenessConstraint - Duplicate NAME entries", "2"),
        ("ComplianceConstraint - low", "2"),
        ("ComplianceConstraint - low", "3"),
        ("PatternMatchConstraint - Incorrect NAME pattern", "1"),
        ("PatternMatchConstraint - Incorrect NAME pattern", "2"),
        ("PatternMatchConstraint - Incorrect NAME pattern", "3"),
    }
