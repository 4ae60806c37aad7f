"""Declarative checks: a metric, an assertion on it, and the result table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pathwarden.operators import analyzers as A
from pathwarden.operators.rules import (
    COMPLETE_COLUMNS,
    MISSING_PARENT,
    RULE_COLUMNS,
    RULES,
    STRING_COLUMNS,
)
from pathwarden.operators.violations import SUITE_PATTERN, orphan_rows

Assertion = Callable[[Column], Column]


# The texts of constraints and the thresholds below are fixed values: stored results and scores depend on them.


def is_one(value: Column) -> Column:
    return value == 1.0


@dataclass(frozen=True)
class Constraint:
    """One expectation. `kind`, `column` and `name` drive dispatch; `text` is for people.

    `violations` replaces the metric where the offending rows come from a join: the
    value is then the share of rows that are not among them. `broken` tells whether a
    row breaks the constraint; constraints on the table as a whole have none.
    """

    kind: str
    column: str
    text: str
    metric: A.Metric | None
    assertion: Assertion = is_one
    name: str = ""
    violations: Callable[[DataFrame], DataFrame] | None = None
    broken: Callable[[], Column] | None = None


@dataclass
class Check:
    """A named list of constraints of one severity, built by chaining."""

    level: str
    description: str
    constraints: list[Constraint] = field(default_factory=list)

    def _add(self, constraint: Constraint) -> Check:
        return Check(self.level, self.description, [*self.constraints, constraint])

    def has_data_type(self, column: str, kind: str, assertion: Assertion = is_one) -> Check:
        text = f"AnalysisBasedConstraint(DataType({column},None),<function1>,Some(<function1>),None)"
        metric = A.Metric("DataType", column, lambda: A.datatype_ratio(F.col(column), kind))
        broken = lambda: ~F.coalesce(A.looks_like(F.col(column), kind), F.lit(False))
        return self._add(Constraint("DataType", column, text, metric, assertion, broken=broken))

    def is_complete(self, column: str) -> Check:
        text = f"CompletenessConstraint(Completeness({column},None,None))"
        metric = A.Metric("Completeness", column, lambda: A.completeness(F.col(column)))
        return self._add(Constraint("Completeness", column, text, metric, broken=lambda: F.col(column).isNull()))

    def is_unique(self, column: str) -> Check:
        text = f"UniquenessConstraint(Uniqueness(List({column}),None,None))"
        return self._add(Constraint("Uniqueness", column, text, A.Metric("Uniqueness", column, A.uniqueness, (column,))))

    def has_distinctness(self, columns: list[str], assertion: Assertion) -> Check:
        names = ", ".join(columns)
        text = f"DistinctnessConstraint(Distinctness(Stream({names}, ?),None))"
        metric = A.Metric("Distinctness", names, A.distinctness, tuple(columns))
        return self._add(Constraint("Distinctness", columns[0], text, metric, assertion))

    def has_approx_count_distinct(self, column: str, assertion: Assertion) -> Check:
        text = f"ApproxCountDistinctConstraint(ApproxCountDistinct({column},None))"
        metric = A.Metric("ApproxCountDistinct", column, lambda: A.approx_count_distinct(F.col(column)))
        return self._add(Constraint("ApproxCountDistinct", column, text, metric, assertion))

    def has_pattern(self, column: str, pattern: str, assertion: Assertion = is_one) -> Check:
        text = f"PatternMatchConstraint({column}, {pattern})"
        metric = A.Metric("PatternMatch", column, lambda: A.pattern_match(F.col(column), pattern))
        broken = lambda: ~F.coalesce(A.finds(F.col(column), pattern), F.lit(False))
        return self._add(Constraint("PatternMatch", column, text, metric, assertion, broken=broken))

    def satisfies(
        self, predicate: str | Callable[[], Column], name: str, assertion: Assertion = is_one, column: str = "", shown: str = ""
    ) -> Check:
        """What every row should meet: SQL, or a function that gives a column. `shown` stands for the latter in texts."""
        holds = (lambda: F.expr(predicate)) if isinstance(predicate, str) else predicate
        text = f"ComplianceConstraint(Compliance({name},{predicate if isinstance(predicate, str) else shown},None,List(),None))"
        metric = A.Metric("Compliance", name, lambda: A.compliance(holds()))
        broken = lambda: ~F.coalesce(holds(), F.lit(False))
        return self._add(Constraint("Compliance", column, text, metric, assertion, name, broken=broken))

    def has_no_rows(
        self, violations: Callable[[DataFrame], DataFrame], name: str, assertion: Assertion = is_one, column: str = ""
    ) -> Check:
        """No row may be among those that `violations` returns."""
        text = f"ComplianceConstraint(Compliance({name},no violating row,None,List(),None))"
        return self._add(Constraint("Compliance", column, text, None, assertion, name, violations))


def error_check(placeholder: bool = False, approximate: bool = True) -> Check:
    """The checks at level Error. `placeholder` makes the missing-parent rule fail always, as in old scores."""
    check = Check("Error", "Data Quality Checks Errors")
    for column in STRING_COLUMNS:
        check = check.has_data_type(column, "String")
    check = check.has_data_type("IS_GROUP", "Boolean").has_data_type("LEVEL_NUMBER", "Numeric")
    for column in COMPLETE_COLUMNS:
        check = check.is_complete(column)
    check = check.is_unique("CODE").has_distinctness(["NAME"], lambda x: x >= 0.9)
    if approximate:
        check = check.has_approx_count_distinct("NAME", lambda x: x >= 12000)
    check = check.has_pattern("HIERARCHY", SUITE_PATTERN)
    for name in RULE_COLUMNS:
        column = RULE_COLUMNS[name]
        if name != MISSING_PARENT:
            shown, rule = RULES[name]
            check = check.satisfies(rule, name, lambda x: x >= 1.0, column, shown)
        elif placeholder:
            check = check.satisfies("false", name, lambda x: x >= 1.0, column)
        else:
            check = check.has_no_rows(orphan_rows, name, lambda x: x >= 1.0, column)
    return check


def warning_check(approximate: bool = True) -> Check:
    check = Check("Warning", "Data Quality Checks Warning").has_distinctness(["NAME"], lambda x: x >= 0.96)
    return check.has_approx_count_distinct("NAME", lambda x: x >= 11500) if approximate else check


def legacy_check(approximate: bool = True) -> Check:
    """The older, shorter list with its own thresholds."""
    check = Check("Error", "Data Quality Checks").is_complete("NAME").is_complete("LEVEL_NAME").is_complete("HIERARCHY")
    check = check.has_distinctness(["NAME"], lambda x: x >= 0.85)
    if approximate:
        check = check.has_approx_count_distinct("NAME", lambda x: x >= 10000)
    return check.has_pattern("HIERARCHY", "^ALL#WORLD#([A-Z]+#)*[A-Z]+$", lambda x: x >= 0.95)


def constraint_values(df: DataFrame, constraints: list[Constraint]) -> DataFrame:
    """(position, value) of every constraint, scans shared."""
    plain = [(i, c) for i, c in enumerate(constraints) if c.metric is not None]
    places = F.array(*[F.lit(i) for i, _ in plain])
    values = None
    if plain:
        measured = A.measure(df, [c.metric for _, c in plain])
        values = measured.select(F.get(places, F.col("position")).alias("position"), "value")
    for i, constraint in enumerate(constraints):
        if constraint.metric is None:
            total = df.agg(F.count("*").alias("n"))
            bad = constraint.violations(df).agg(F.count("*").alias("bad"))
            value = (1 - F.col("bad") / F.col("n")).alias("value")
            row = bad.select(F.lit(i).alias("position"), "bad", total.scalar().alias("n"))
            row = row.select("position", F.when(F.col("n") > 0, value).alias("value"))
            values = row if values is None else values.unionByName(row)
    return values


def run_suite(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One row per constraint: its value, status and message, and the worst status of its check.

    The assertions are applied to the value column, so the whole result stays lazy.
    """
    listed = [(check, c) for check in checks for c in check.constraints]
    values = constraint_values(df, [c for _, c in listed])
    names = ["check", "check_level", "constraint", "kind", "column", "rule"]
    labels = df.sparkSession.createDataFrame(
        [(i, check.description, check.level, c.text, c.kind, c.column, c.name) for i, (check, c) in enumerate(listed)],
        "position int, " + ", ".join(f"`{n}` string" for n in names),
    )
    outcome = F.lit(None).cast("boolean")
    for i, (_, c) in enumerate(listed):
        outcome = F.when(F.col("position") == i, c.assertion(F.col("value"))).otherwise(outcome)
    passed = F.coalesce(outcome, F.lit(False))
    message = F.concat(
        F.lit("Value: "), F.col("value").cast("string"), F.lit(" does not meet the constraint requirement!")
    )
    rows = values.withColumn("passed", passed).join(F.broadcast(labels), "position")
    failed_level = F.max(F.when(~F.col("passed"), F.col("check_level"))).over(Window.partitionBy("check", "check_level"))
    return rows.select(
        "position",
        "check",
        "check_level",
        F.coalesce(failed_level, F.lit("Success")).alias("check_status"),
        "constraint",
        F.when(F.col("passed"), "Success").otherwise("Failure").alias("constraint_status"),
        F.when(F.col("passed"), "").otherwise(F.coalesce(message, F.lit("Empty state for the metric"))).alias("constraint_message"),
        "kind",
        "column",
        "rule",
        "value",
    )


def results_table(results: DataFrame) -> DataFrame:
    """The six columns of the published result table."""
    return results.select(
        "check", "check_level", "check_status", "constraint", "constraint_status", "constraint_message"
    )


def failed_constraints(results: DataFrame) -> DataFrame:
    return results.where(F.col("constraint_status") == "Failure").select("constraint")
