"""Scores, problem tables and comparisons of detectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathwarden.functions.text import attribute_column, normalize_bool_text
from pathwarden.operators.joins import anti_by_key, inner_on_key
from pathwarden.operators.rows import tag_constant, union_ragged, with_ordinal

DUPLICATE = "UniquenessConstraint - duplicate"
OUTLIER = "ComplianceConstraint - outlier"


def quality_score(results: DataFrame) -> DataFrame:
    """Share of constraints that passed, from 0 to 100."""
    passed = (F.col("constraint_status") == "Success").cast("double")
    return results.agg((F.avg(passed) * 100).alias("total_score"))


def with_column_name(results: DataFrame) -> DataFrame:
    """Add the attribute that each constraint's text names first."""
    return results.withColumn("column_name", attribute_column(F.col("constraint")))


def merge_problems(problems: DataFrame, duplicates: DataFrame, outliers: DataFrame) -> DataFrame:
    """All problem rows in one table, with the attribute each problem is about."""
    merged = union_ragged(
        problems, tag_constant(duplicates, PROBLEM=DUPLICATE), tag_constant(outliers, PROBLEM=OUTLIER)
    )
    return merged.withColumn("COLUMN_PROBLEM", attribute_column(F.col("PROBLEM"), ignore_case=True))


def compare_detections(a: DataFrame, b: DataFrame, key: str = "CODE") -> dict[str, DataFrame]:
    """Rows that both found, and rows that only one of them found."""
    return {"common": inner_on_key(a, b, key), "a_only": anti_by_key(a, b, key), "b_only": anti_by_key(b, a, key)}


def side_counts(parts: dict[str, DataFrame]) -> DataFrame:
    """One row per part with its number of rows."""
    counts = [part.agg(F.count("*").alias("n")).select(F.lit(side).alias("side"), "n") for side, part in parts.items()]
    return union_ragged(*counts)


def changed_rows(corrected: DataFrame, original: DataFrame, column: str = "HIERARCHY") -> DataFrame:
    return anti_by_key(corrected, original, column)


def correction_pairs(reviewed: DataFrame, order: list[str]) -> DataFrame:
    """Two rows in sequence are a pair: the valid one corrects the other, none if both are invalid."""
    marked = with_ordinal(reviewed, order).select(
        "CODE",
        normalize_bool_text(F.col("Valid")).alias("ok"),
        F.expr("ordinal div 2").alias("pair"),
        (F.col("ordinal") % 2).alias("place"),
    )

    def at(place, value):
        return F.max(F.when(F.col("place") == place, value))

    pairs = marked.groupBy("pair").agg(
        at(0, F.col("CODE")).alias("first"),
        at(1, F.col("CODE")).alias("second"),
        F.coalesce(at(0, F.col("ok")), F.lit(False)).alias("first_ok"),
        F.coalesce(at(1, F.col("ok")), F.lit(False)).alias("second_ok"),
    )
    kept = pairs.where(F.col("first_ok") | F.col("second_ok"))
    return kept.select(
        F.when(F.col("first_ok"), F.col("second")).otherwise(F.col("first")).alias("Old"),
        F.when(F.col("first_ok"), F.col("first")).otherwise(F.col("second")).alias("Corrected"),
    )
