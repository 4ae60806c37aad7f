"""Column metrics. Every metric but the key-based ones is a plain aggregate, so one scan serves them all."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathwarden.functions.text import inferred_kind


def completeness(column: Column) -> Column:
    return F.avg(column.isNotNull().cast("double"))


def approx_count_distinct(column: Column, rsd: float = 0.05) -> Column:
    return F.approx_count_distinct(column, rsd).cast("double")


def finds(column: Column, pattern: str) -> Column:
    """The pattern finds a non-empty piece."""
    return F.regexp_extract(column, pattern, 0) != ""


def pattern_match(column: Column, pattern: str) -> Column:
    """Share of rows where the pattern finds a non-empty piece; null finds none."""
    return F.avg(F.coalesce(finds(column, pattern), F.lit(False)).cast("double"))


def looks_like(column: Column, kind: str) -> Column:
    return inferred_kind(column).isin({"Numeric": ["Fractional", "Integral"]}.get(kind, [kind]))


def datatype_ratio(column: Column, kind: str) -> Column:
    """Share of the known values that look like `kind`; 0 if no value does."""
    hits = F.count_if(looks_like(column, kind))
    return F.when(hits == 0, F.lit(0.0)).otherwise(hits / F.count(column))


def compliance(predicate: str | Column) -> Column:
    """Share of all rows where the predicate is true; null is not true."""
    holds = F.expr(predicate) if isinstance(predicate, str) else predicate
    return F.avg(F.coalesce(holds, F.lit(False)).cast("double"))


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Occurrences of each key over the rows that have any part of it."""
    present = reduce(lambda a, b: a | b, [F.col(k).isNotNull() for k in keys])
    return df.where(present).groupBy(*keys).agg(F.count("*").alias("n"))


def distinctness() -> Column:
    """Over `key_counts`: distinct keys per row."""
    return F.count("*") / F.sum("n")


def uniqueness() -> Column:
    """Over `key_counts`: keys that occur once, per row."""
    return F.count_if(F.col("n") == 1) / F.sum("n")


def group_count_having(df: DataFrame, keys: list[str], more_than: int = 1) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("count")).where(F.col("count") > more_than)


@dataclass(frozen=True)
class Metric:
    """A named measure: an aggregate over the table, or over the counts of `keys`.

    The aggregate is made when the metric is used, so metrics can be listed without a session.
    """

    name: str
    instance: str
    value: Callable[[], Column]
    keys: tuple[str, ...] = ()


def profile_metrics() -> list[Metric]:
    """The profile of the raw table."""
    return [
        Metric("Completeness", "NAME", lambda: completeness(F.col("NAME"))),
        Metric("Completeness", "LEVEL_NAME", lambda: completeness(F.col("LEVEL_NAME"))),
        Metric("Distinctness", "NAME", distinctness, ("NAME",)),
        Metric("Completeness", "HIERARCHY", lambda: completeness(F.col("HIERARCHY"))),
        Metric("PatternMatch", "HIERARCHY", lambda: pattern_match(F.col("HIERARCHY"), "^ALL#WORLD#.*")),
        Metric("ApproxCountDistinct", "NAME", lambda: approx_count_distinct(F.col("NAME"))),
    ]


def measure(df: DataFrame, metrics: list[Metric]) -> DataFrame:
    """(position, value) per metric: one scan for all aggregates and one grouping per key set."""
    parts = []
    for keys in dict.fromkeys(m.keys for m in metrics):
        chosen = [(i, m) for i, m in enumerate(metrics) if m.keys == keys]
        source = key_counts(df, list(keys)) if keys else df
        wide = source.agg(*[m.value().cast("double").alias(f"v{i}") for i, m in chosen])
        cells = F.array(*[F.struct(F.lit(i).alias("position"), F.col(f"v{i}").alias("value")) for i, _ in chosen])
        parts.append(wide.select(F.inline(cells)))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def metrics_table(df: DataFrame, metrics: list[Metric]) -> DataFrame:
    """One row per metric: entity, instance, name, value."""
    labels = df.sparkSession.createDataFrame(
        [(i, "Column", m.instance, m.name) for i, m in enumerate(metrics)],
        "position int, entity string, instance string, name string",
    )
    return measure(df, metrics).join(F.broadcast(labels), "position").select("entity", "instance", "name", "value")
