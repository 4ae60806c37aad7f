"""Metrics, the suite and violating rows on tiny tables."""

from pyspark.sql import functions as F

from pathwarden.model import PROCESSED_SCHEMA
from pathwarden.operators import analyzers as A
from pathwarden.operators import checks as C
from pathwarden.operators import rules as R
from pathwarden.operators import violations as V


def location(code, path, level="CITY", parent="FRA", number=1, name="n", group=False, children="[]"):
    return (name, code, path, group, children, level, parent, number, level)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), PROCESSED_SCHEMA)


def codes(df):
    return sorted(r["CODE"] for r in df.collect())


def test_key_metrics_ignore_null_rows(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string")
    row = A.key_counts(df, ["x"]).agg(A.distinctness().alias("d"), A.uniqueness().alias("u")).first()
    assert (row["d"], row["u"]) == (2 / 3, 1 / 3)


def test_pattern_needs_a_non_empty_piece(spark):
    df = spark.createDataFrame([("ALL#A",), ("x",), (None,), ("",)], "x string")
    assert df.agg(A.pattern_match(F.col("x"), "ALL#.*").alias("v")).first()["v"] == 0.25
    assert df.agg(A.pattern_match(F.col("x"), "z*").alias("v")).first()["v"] == 0.0


def test_datatype_ratio_leaves_out_unknown(spark):
    df = spark.createDataFrame([("1",), ("2.5",), ("x",), (None,)], "x string")
    row = df.agg(A.datatype_ratio(F.col("x"), "Numeric").alias("n"), A.datatype_ratio(F.col("x"), "Boolean").alias("b")).first()
    assert (row["n"], row["b"]) == (2 / 3, 0.0)


def test_approximate_count_is_near(spark):
    df = spark.range(20000).select((F.col("id") % 5000).alias("x"))
    assert abs(df.agg(A.approx_count_distinct(F.col("x")).alias("v")).first()["v"] / 5000 - 1) < 0.15


def test_country_rules_with_null_path(spark):
    df = frame(
        spark,
        location("A", "ALL#WORLD#E#A", "COUNTRY", "Europe", 0),
        location("B", None, "COUNTRY", "Europe", 0),
        location("W", "ALL#WORLD#W", "REGION", "WORLD", 0),
        location("N", "ALL#WORLD#N", None, "WORLD", 0),
    )
    assert codes(V.country_depth_rows(df)) == ["B"]
    assert codes(V.under_world_rows(df)) == ["W"]
    share = df.agg(A.compliance(R.RULES[R.UNDER_WORLD][1]()).alias("v")).first()["v"]
    assert share == 0.5


def test_level_rule_is_stricter_than_its_rows(spark):
    df = frame(
        spark,
        location("C", "ALL#WORLD#E#FRA#R#C", "CITY", "FRA", 2),
        location("D", "ALL#WORLD#E#FRA#D", "CITY", "FRA", 2),
        location("FRA", "ALL#WORLD#E#FRA", "COUNTRY", "Europe", 0),
        location("P", "ALL#P", "CITY", None, 1),
    )
    assert df.agg(A.compliance(R.RULES[R.LEVEL_MATCHES][1]()).alias("v")).first()["v"] == 0.5
    rows = V.level_mismatch_rows(df).collect()
    assert [(r["CODE"], r["count_after_parent"]) for r in rows] == [("D", 1)]


def test_rows_behind_problems(spark):
    df = frame(
        spark,
        location("A", "ALL#WORLD#E", "CONTINENT", "WORLD", -1),
        location("B", "ALL#WORLD#E#B", "COUNTRY", "E", 0),
        location("C", "ALL#WORLD#X#C", "COUNTRY", "X", 0),
        location("C", None, group=True, children=" "),
        location(None, "BAD", group=True, children=None),
        location(None, "ALL#Q#R", group=True, children='["x"]', number=None),
    )
    assert codes(V.orphan_rows(df.where("CODE is not null"))) == ["C", "C"]
    assert [r["count"] for r in V.duplicate_key_rows(df).collect()] == [2, 2]
    assert V.pattern_rows(df).count() == 1
    assert V.group_children_rows(df).count() == 2
    assert V.null_rows(df, "CODE").count() == 2


def test_texts_that_do_not_cast(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,), ('["a"]',), ("true",)], "t string")
    text = lambda rows: [r["t"] for r in rows.collect()]
    assert text(V.bad_number_rows(df, "t")) == ["x", None, '["a"]', "true"]
    assert text(V.bad_boolean_rows(df, "t")) == ["x", None, '["a"]']
    assert text(V.bad_array_rows(df, "t")) == ["1", "x", "true"]


def test_suite_levels_and_messages(spark):
    df = frame(spark, location("A", "ALL#W#A"), location("A", "ALL#W#A", name=None))
    own = C.Check("Warning", "own").is_complete("CODE").is_unique("CODE").satisfies("NAME = 'n'", "names", lambda x: x >= 0.5)
    fine = C.Check("Error", "fine").is_complete("CODE")
    rows = {r["constraint"]: r for r in C.run_suite(df, [own, fine]).collect() if r["check"] == "own"}
    unique = rows["UniquenessConstraint(Uniqueness(List(CODE),None,None))"]
    assert unique["constraint_message"] == "Value: 0.0 does not meet the constraint requirement!"
    assert {r["check_status"] for r in rows.values()} == {"Warning"}
    assert sum(r["constraint_status"] == "Success" for r in rows.values()) == 2


def test_empty_table_fails(spark):
    results = C.run_suite(frame(spark).limit(0), [C.error_check()])
    assert results.where("constraint_status = 'Success'").count() == 0


def test_placeholder_keeps_old_scores(spark):
    df = frame(spark, location("A", "ALL#W#A"))
    row = C.run_suite(df, [C.error_check(placeholder=True)]).where(F.col("rule") == R.MISSING_PARENT).first()
    assert row["constraint_message"].startswith("Value: 0.0 ")


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    shares = df.agg(A.compliance("l_discount < 0.05"), A.completeness(F.col("l_tax")), A.pattern_match(F.col("l_returnflag"), "A"))
    assert plan_text(shares).count("Scan parquet") == 1
    locations = frame(spark, location("A", "ALL#W#A"))
    assert "Python" not in plan_text(V.level_mismatch_rows(locations))
    assert "PushedFilters: [IsNotNull(l_tax), GreaterThan" in plan_text(df.where("l_tax > 0.05").select("l_orderkey"))
