"""The whole runs: repair a raw table, validate it, find duplicates, collect all problems."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathwarden.model import CONTINENTS, PROCESSED_COLUMNS
from pathwarden.operators import checks as C
from pathwarden.operators import fuzzy, report, vectors
from pathwarden.operators import hierarchy as H
from pathwarden.operators import rows as R
from pathwarden.operators.violations import extract_all
from pathwarden.session import cut_lineage
from pathwarden.sources import writers


@dataclass(frozen=True)
class Locations:
    """The outcome of a repair."""

    processed: DataFrame
    continents: DataFrame
    countries: DataFrame
    countries_without_continent: DataFrame
    outliers: DataFrame


def process_locations(
    raw: DataFrame,
    reference: DataFrame,
    known: DataFrame,
    order: str = "row_id",
    continents: list[str] = CONTINENTS,
    scorer: str = "weighted",
    level_scorer: str = "ratio_plain",
    names: list[str] = CONTINENTS,
) -> Locations:
    """Rebuild the hierarchy of a raw location table.

    `raw` has the raw columns and an order column, `reference` the level reference with
    `ordinal`, `known` (country, continent). `scorer` compares names, those of continents
    with `names`, and `level_scorer` the names of levels. Tables that later steps read
    several times are stored once.
    """
    place = F.col(order)
    found_continents, rest = H.build_continents(raw, names, scorer)
    # The row for Oceania is made up, so it has no place in the raw order.
    found_continents = found_continents.withColumn(order, F.coalesce(place, F.lit(-1)))
    found_continents, rest = cut_lineage(found_continents), cut_lineage(rest)
    named = H.assign_continent(rest.where(F.col("LEVEL_NAME") == "COUNTRY"), known, reference, continents, scorer)
    with_continent, without = H.split_found(cut_lineage(named), continents)
    countries = cut_lineage(H.build_country_path(with_continent, found_continents, place))

    below = H.add_parent(rest, countries, without, found_continents)
    below = cut_lineage(H.rebase_path(below, countries, place))
    below = H.assign_level_number(below, countries)
    merged = cut_lineage(H.fix_port_paths(H.merge_levels(below, countries, found_continents), place))
    processed = cut_lineage(H.official_level_name(merged, reference, level_scorer))
    return Locations(processed, found_continents, countries, without, H.find_outliers(raw, merged))


def validate(processed: DataFrame, checks: list[C.Check] | None = None) -> tuple[DataFrame, DataFrame]:
    """The result of every constraint and the rows behind the failed ones, the roots left out."""
    rows = R.drop_roots(processed)
    checks = checks or [C.error_check(), C.warning_check()]
    results = cut_lineage(C.run_suite(rows, checks))
    return results, extract_all(rows, results, checks)


def report_run(spark, processed: DataFrame, history_path: str, at, checks: list[C.Check] | None = None) -> tuple[DataFrame, DataFrame]:
    """Validate, score the run, append the score to the history; the results with their attribute, and the history."""
    results, _ = validate(processed, checks)
    scores = report.quality_score(results).select(F.lit(at).cast("timestamp").alias("date"), "total_score")
    writers.append_history_if_absent(spark, scores, history_path)
    return report.with_column_name(results), writers.read_history(spark, history_path)


def problem_rows(
    processed: DataFrame, outliers: DataFrame, order: str = "row_id", vector: str | None = None, threshold: float = 0.98
) -> DataFrame:
    """All problem rows of a run: failed constraints, semantic duplicates and outliers."""
    _, problems = validate(processed)
    duplicates = vectors.semantic_duplicates(processed, threshold, order, vector)
    columns = [order, *PROCESSED_COLUMNS]
    return report.merge_problems(problems.select(*columns, "PROBLEM"), duplicates.select(*columns), outliers)


def compare_detectors(df: DataFrame, order: str = "row_id", vector: str | None = None) -> dict[str, DataFrame]:
    """Rows found by the semantic detector, by the static one, and by both."""
    semantic = vectors.semantic_duplicates(df, order=order, vector=vector, repeats=False)
    return report.compare_detections(semantic, fuzzy.static_detection(df, order=order))
