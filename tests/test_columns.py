"""Scalar expressions and their null rules."""

from pyspark.sql import functions as F

from pathwarden.functions import paths as P
from pathwarden.functions import text as X
from pathwarden.functions.similarity import levenshtein_score, plain_ratio, weighted_score


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_paths(spark):
    rows = [("A#B#C", "B", "C"), ("A", "Z", "A"), (None, "A", "A"), ("A#B#B", "B", None), ("X#AB", "X", "B")]
    path, parent, code = F.col("path"), F.col("parent"), F.col("code")
    got = values(
        spark, rows, "path string, parent string, code string",
        P.segment_count(path), P.path_depth(path), P.parent_path(path), P.segments_after(path, parent),
        P.strip_own_code(path, code), P.path_prefixes(path),
    )
    assert got == [
        (3, 2, "A#B", 1, "A#B", ["A", "A#B", "A#B#C"]),
        (1, 0, "A", None, "A", ["A"]),
        (-1, None, None, None, None, None),
        (3, 2, "A#B", 1, "A#B#B", ["A", "A#B", "A#B#B"]),
        (2, 1, "X", 1, "X#AB", ["X", "X#AB"]),
    ]


def test_strip_levels(spark):
    rows = [("A#B#C", k) for k in (-1, 0, 1, 2, 3, 4)]
    got = values(spark, rows, "path string, k int", P.strip_levels(F.col("path"), F.col("k")))
    assert [g[0] for g in got] == ["A#B#C", "A#B#C", "A#B", "A", "", ""]


def test_code_suffix(spark):
    rows = [("A#FRA", "FRA12"), ("A#FRA", "FR12"), ("A#FRA", "FRA"), ("A#FRA", "DE12"), (None, "X1"), ("A#FRA", None), ("A#FR", "FR1a")]
    got = values(spark, rows, "p string, c string", X.code_suffix_valid(F.col("p"), F.col("c")))
    assert [g[0] for g in got] == [True, True, False, False, False, False, False]


def test_attribute_words(spark):
    rows = [("Completeness(LEVEL_NAME,None)",), ("a HIERARCHY of LEVEL_NAME",), ("level_number bad",), ("UniquenessConstraint - CODE",), (None,)]
    got = values(spark, rows, "t string", X.attribute_column(F.col("t")), X.attribute_column(F.col("t"), True))
    assert got == [
        ("LEVEL_NAME", "LEVEL_NAME"), ("HIERARCHY", "HIERARCHY"), (None, "LEVEL_NUMBER"), ("CODE", "NAME"), (None, None),
    ]


def test_kinds_and_texts(spark):
    rows = [("12",), ("-1.5",), ("true",), ("x1",), (None,), (" True ",)]
    got = values(
        spark, rows, "t string", X.inferred_kind(F.col("t")), X.normalize_bool_text(F.col("t")), X.compose_text([F.col("t"), F.lit(1)], "-"),
    )
    assert got == [
        ("Integral", False, "12-1"), ("Fractional", False, "-1.5-1"), ("Boolean", True, "true-1"),
        ("String", False, "x1-1"), ("Unknown", False, "nan-1"), ("String", True, " True -1"),
    ]


def test_title(spark):
    assert values(spark, [(" NORTH_america ",)], "t string", X.title_name(F.col("t"))) == [("North America",)]


def test_scores(spark):
    rows = [("abc", "abd"), ("", ""), ("", "a"), ("same", "same")]
    got = values(spark, rows, "a string, b string", levenshtein_score(F.col("a"), F.col("b")))
    assert [g[0] for g in got] == [67, 100, 0, 100]
    assert weighted_score("AFRICA", "Africa") == 100
    assert weighted_score("AMERICA", "South America") == 90
    assert weighted_score("york new", "New York") == 95
    assert weighted_score("", "x") == 0 and weighted_score("--", "x") == 0
    assert plain_ratio("City", "CITY ") == 100
