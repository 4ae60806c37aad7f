"""The rows that break a constraint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathwarden.functions.paths import parent_path, segment_count, segments_after
from pathwarden.operators import rules as R
from pathwarden.operators.analyzers import group_count_having

# The pattern of paths that the suite demands.
SUITE_PATTERN = "ALL#.*#.*"
# Problem names: fixed, because later steps and stored files use them.
BAD_PATTERN = "PatternMatchConstraint - Incorrect HIERARCHY pattern"
BAD_COUNTRY_DEPTH = "ComplianceConstraint - Incorrect COUNTRY level hierarchy structure"
BAD_LEVEL_NUMBER = "ConsistencyConstraint - LEVEL_NUMBER mismatch with HIERARCHY after PARENT"
ORPHAN = "ConsistencyConstraint - Orphan hierarchy (parent missing)"
BAD_UNDER_WORLD = "ComplianceConstraint - Non-CONTINENT rows directly under WORLD"
NO_CHILDREN = "ConsistencyConstraint - CHILDREN NULL"


def duplicate_problem(column: str) -> str:
    return f"UniquenessConstraint - Duplicate {column} entries"


def null_problem(column: str) -> str:
    return f"CompletenessConstraint - Null values in {column}"


def datatype_problem(column: str) -> str:
    return f"AnalysisBasedConstraint - {column} has incorrect datatype"


def null_in(column: str) -> Column:
    return F.col(column).isNull()


def not_a_number(column: str = "LEVEL_NUMBER") -> Column:
    return F.col(column).try_cast("int").isNull()


def not_a_boolean(column: str = "IS_GROUP") -> Column:
    return F.col(column).try_cast("boolean").isNull()


def not_an_array(column: str = "CHILDREN") -> Column:
    """A value that is there but is no JSON array of texts."""
    return F.col(column).isNotNull() & F.from_json(F.col(column), "array<string>").isNull()


def bad_pattern() -> Column:
    return ~F.col("HIERARCHY").rlike(f"^{SUITE_PATTERN}")


def bad_country_depth() -> Column:
    return (F.col("LEVEL_NAME") == "COUNTRY") & (segment_count(F.col("HIERARCHY")) != 4)


def count_after_parent() -> Column:
    return segments_after(F.col("HIERARCHY"), F.col("PARENT"))


def bad_level_number() -> Column:
    """Null inputs compare to null, so they are never reported."""
    return (F.col("LEVEL_NUMBER") != count_after_parent()) & (F.col("LEVEL_NAME") != "CONTINENT")


def bad_under_world() -> Column:
    path = F.col("HIERARCHY")
    return F.startswith(path, F.lit("ALL#WORLD#")) & (segment_count(path) == 3) & (F.col("LEVEL_NAME") != "CONTINENT")


def group_without_children() -> Column:
    children = F.col("CHILDREN")
    return F.col("IS_GROUP") & (children.isNull() | (F.trim(children) == "") | (children == "[]"))


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(null_in(column))


def bad_number_rows(df: DataFrame, column: str = "LEVEL_NUMBER") -> DataFrame:
    return df.where(not_a_number(column))


def bad_boolean_rows(df: DataFrame, column: str = "IS_GROUP") -> DataFrame:
    return df.where(not_a_boolean(column))


def bad_array_rows(df: DataFrame, column: str = "CHILDREN") -> DataFrame:
    return df.where(not_an_array(column))


def bad_string_rows(df: DataFrame, column: str) -> DataFrame:
    """Any value casts to a string, so only missing ones are wrong."""
    return df.where(null_in(column))


def duplicate_key_rows(df: DataFrame, key: str = "CODE") -> DataFrame:
    """Every row whose key occurs more than once, with the `count`.

    The counts are pre-aggregated; a window over the key would put a hot key in one task.
    """
    return df.join(group_count_having(df.where(F.col(key).isNotNull()), [key]), [key])


def pattern_rows(df: DataFrame) -> DataFrame:
    return df.where(bad_pattern())


def country_depth_rows(df: DataFrame) -> DataFrame:
    return df.where(bad_country_depth())


def level_mismatch_rows(df: DataFrame) -> DataFrame:
    return df.where(bad_level_number()).withColumn("count_after_parent", count_after_parent())


def orphan_rows(df: DataFrame) -> DataFrame:
    """Numbered rows whose parent path is no row's path; a row without a path is one of them."""
    numbered = df.where(F.col("LEVEL_NUMBER") >= 0).withColumn("_parent_path", parent_path(F.col("HIERARCHY")))
    paths = df.select(F.col("HIERARCHY").alias("_parent_path")).distinct()
    return numbered.join(paths, ["_parent_path"], "left_anti").select(*df.columns)


def under_world_rows(df: DataFrame) -> DataFrame:
    return df.where(bad_under_world())


def group_children_rows(df: DataFrame) -> DataFrame:
    return df.where(group_without_children())


_DATATYPE_TESTS = {"LEVEL_NUMBER": not_a_number, "IS_GROUP": not_a_boolean, "CHILDREN": not_an_array}


def _row_problems(kind: str, column: str, rule: str) -> dict[str, Column]:
    """The problem that a failed constraint of the suite stands for, as a row predicate."""
    if kind == "Completeness":
        return {null_problem(column): null_in(column)}
    if kind == "DataType":
        return {datatype_problem(column): _DATATYPE_TESTS.get(column, null_in)(column)}
    if kind == "PatternMatch" and column == "HIERARCHY":
        return {BAD_PATTERN: bad_pattern()}
    by_rule = {
        R.COUNTRY_DEPTH: {BAD_COUNTRY_DEPTH: bad_country_depth()},
        R.LEVEL_MATCHES: {BAD_LEVEL_NUMBER: bad_level_number()},
        R.UNDER_WORLD: {BAD_UNDER_WORLD: bad_under_world()},
        R.GROUP_HAS_CHILDREN: {NO_CHILDREN: group_without_children()},
        R.CHILDREN_PRESENT: {NO_CHILDREN: group_without_children()},
    }
    return by_rule.get(rule, {})


def tag_rows(df: DataFrame, problems: dict[str, Column]) -> DataFrame:
    """One output row per row and problem it has, from a single scan."""
    names = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in problems.items()]))
    return df.withColumn("PROBLEM", F.explode(names))


def _constraint_problems(row, constraint) -> dict[str, Column]:
    """The problems of a failed constraint that rows show by themselves.

    Constraints of the suite have fixed problems; any other is broken by the rows that its own test names.
    """
    own_pattern = row["kind"] == "PatternMatch" and constraint is not None and SUITE_PATTERN not in constraint.text
    own_type = row["kind"] == "DataType" and constraint is not None and row["column"] not in (*_DATATYPE_TESTS, *R.STRING_COLUMNS)
    known = {} if own_pattern or own_type else _row_problems(row["kind"], row["column"], row["rule"])
    if known or constraint is None or constraint.broken is None:
        return known
    about = {"PatternMatch": f"Incorrect {row['column']} pattern", "DataType": f"{row['column']} has incorrect datatype"}
    return {f"{row['kind']}Constraint - {about.get(row['kind'], row['rule'])}": constraint.broken()}


def extract_all(df: DataFrame, results: DataFrame, checks: list | None = None) -> DataFrame:
    """The rows behind every failed constraint, each tagged with its PROBLEM.

    `results` comes from `run_suite` on `checks`; without `checks` only the suite's own constraints are known.
    Distinctness and approximate counts are about the table as a whole, so no rows stand behind them. `results` has one
    row per constraint, so the driver reads a few dozen rows at most; knowing them keeps passing constraints out of the plan.
    """
    listed = [c for check in checks or [] for c in check.constraints]
    failed = results.where(F.col("constraint_status") == "Failure").select("position", "kind", "column", "rule")
    problems: dict[str, Column] = {}
    joined: dict[str, DataFrame] = {}
    for row in failed.orderBy("position").collect():
        constraint = listed[row["position"]] if listed else None
        if row["kind"] == "Uniqueness":
            joined[duplicate_problem(row["column"])] = duplicate_key_rows(df, row["column"])
        elif row["rule"] == R.MISSING_PARENT:
            joined[ORPHAN] = orphan_rows(df)
        elif constraint is not None and constraint.violations is not None:
            joined[f"{row['kind']}Constraint - {row['rule']}"] = constraint.violations(df)
        else:
            problems.update(_constraint_problems(row, constraint))
    parts = [tag_rows(df, problems)] if problems else [df.withColumn("PROBLEM", F.lit("")).where(F.lit(False))]
    if BAD_LEVEL_NUMBER in problems:
        shown = F.when(F.col("PROBLEM") == BAD_LEVEL_NUMBER, count_after_parent())
        parts[0] = parts[0].withColumn("count_after_parent", shown)
    tagged = parts[0]
    for problem, rows in joined.items():
        tagged = tagged.unionByName(rows.withColumn("PROBLEM", F.lit(problem)), allowMissingColumns=True)
    return tagged
