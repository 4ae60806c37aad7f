"""Joins by key, lookups in dimensions, and the most similar entry of a dimension.

Joins are plain equi-joins: Spark chooses a broadcast by the size it knows or measures, and its adaptive skew
handling splits a hot key of either side, so lookups work for tables of any size. Nothing here runs a job while a plan
is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathwarden.functions.paths import path_prefixes
from pathwarden.functions.similarity import best_of

#: The most rows of a table that travels whole to every task, and about the choices that a name is compared with at once.
SMALL_ROWS = 10_000


def small_table(df: DataFrame, entry: Column, name: str) -> Column:
    """All entries of a small table as one array, for use in any row. Its size is checked when it is read."""
    few = df.select(entry.alias("e")).limit(SMALL_ROWS + 1)
    too_many = F.raise_error(F.lit(f"{name}: over {SMALL_ROWS} rows; use the join for large tables"))
    packed = few.agg(F.when(F.count("*") <= SMALL_ROWS, F.sort_array(F.collect_list("e"))).otherwise(too_many).alias("e"))
    return packed.scalar()


def lookup(df: DataFrame, dimension: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join to a table with one row per key."""
    return df.join(dimension, keys, how)


def dimension(
    df: DataFrame, key: Column, key_name: str, values: dict[str, Column], order: Column, place: str | None = None
) -> DataFrame:
    """One row per non-null key, the last one in `order` winning; `place` adds the key's first `order`.

    That is how a dictionary fills: a repeated key keeps its first place and takes the last value.
    """
    # In a struct a null order is the lowest one; bare, max_by would skip the row.
    last = F.max_by(F.struct(*[v.alias(k) for k, v in values.items()]), F.struct(order))
    first = [] if place is None else [F.min(order).alias(place)]
    return (
        df.where(key.isNotNull())
        .groupBy(key.alias(key_name))
        .agg(last.alias("v"), *first)
        .select(key_name, *[F.col(f"v.{k}").alias(k) for k in values], *([place] if place else []))
    )


def lookup_default(
    df: DataFrame, key: str, dim: DataFrame, value: str, default: Column | None = None, name: str | None = None
) -> DataFrame:
    """Add `dim`'s `value` for `key` (`dim` has those two columns), or `default` without a match."""
    name = name or value
    found = lookup(df, dim.select(F.col(key), F.col(value).alias("_found")), [key])
    result = F.col("_found") if default is None else F.coalesce(F.col("_found"), default)
    return found.withColumn(name, result).drop("_found")


def inner_on_key(left: DataFrame, right: DataFrame, key: str, suffixes=("_x", "_y")) -> DataFrame:
    """Rows of both sides with equal keys; other shared columns get the suffixes. Null keys do not match."""
    shared = [c for c in left.columns if c in right.columns and c != key]
    a = left.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    b = right.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    return a.join(b, [key])


def semi_by_key(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    return df.join(other.select(key).distinct(), [key], "left_semi").select(*df.columns)


def anti_by_key(df: DataFrame, other: DataFrame, key: str, null_matches_null: bool = True) -> DataFrame:
    """Rows whose key the other side lacks. A null key counts as found if the other side has one too."""
    keys = other.select(F.col(key).alias("_key")).distinct()
    same = F.col(key).eqNullSafe(F.col("_key")) if null_matches_null else F.col(key) == F.col("_key")
    return df.join(keys, same, "left_anti")


def keyed_update(df: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Overwrite columns with the non-null values of the row of `changes` that has the same key."""
    changed = [c for c in changes.columns if c != key]
    renamed = changes.select(key, *[F.col(c).alias(f"_new_{c}") for c in changed])
    joined = df.join(renamed, [key], "left")
    return joined.select(
        *[F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in changed else F.col(c) for c in df.columns]
    )


def under_prefix(
    df: DataFrame, path: str, prefixes: DataFrame, prefix: str, values: list[str], small: bool = False
) -> DataFrame:
    """Add the `values` of the longest of `prefixes` that the path lies under, matched at separators.

    The steps of the distinct paths are joined with the prefixes, and the longest match of each path is kept. A table that
    is known to be `small` (at most SMALL_ROWS, checked) is looked up within each row instead, with no shuffle.
    """
    if small:
        entry = F.struct(F.col(prefix).alias("key"), F.struct(*values).alias("value"))
        known = prefixes.where(F.col(prefix).isNotNull()).dropDuplicates([prefix])
        rows = df.withColumn("_known", F.map_from_entries(small_table(known, entry, "prefixes")))
        found = F.filter(F.transform(path_prefixes(F.col(path)), lambda p: F.try_element_at(F.col("_known"), p)), lambda v: v.isNotNull())
        rows = rows.withColumn("_hit", F.try_element_at(found, F.lit(-1)))
        return rows.select(*df.columns, *[F.col(f"_hit.{v}").alias(v) for v in values])
    paths = df.select(F.col(path)).where(F.col(path).isNotNull()).distinct()
    steps = paths.select(path, F.posexplode(path_prefixes(F.col(path))).alias("_step", "_prefix"))
    marks = prefixes.where(F.col(prefix).isNotNull()).select(F.col(prefix).alias("_prefix"), F.struct(*values).alias("_value"))
    best = steps.join(marks, ["_prefix"]).groupBy(path).agg(F.max_by("_value", "_step").alias("_hit"))
    found = df.join(best, [path], "left")
    return found.select(*df.columns, *[F.col(f"_hit.{v}").alias(v) for v in values])


def best_match(df: DataFrame, name: str, choices: DataFrame, scorer: str, cutoff: int, strict: bool = False) -> DataFrame:
    """Add the best of `choices` (choice, ordinal) for each `name`, with its score.

    `match` is null where the best score is under the cutoff (`strict`: not above it). Ties go to the lowest ordinal.
    Names and choices are taken once per distinct value. The choices are cut into arrays of about SMALL_ROWS by their hash,
    one array for a short list; each name meets every array, in different tasks, and the best of the arrays' bests stays.
    """
    distinct = choices.where(F.col("choice").isNotNull()).groupBy("choice").agg(F.min("ordinal").alias("ordinal"))
    parts = F.greatest(F.ceil(distinct.agg(F.count("*")).scalar() / SMALL_ROWS), F.lit(1)).cast("int")
    arrays = distinct.groupBy(F.pmod(F.xxhash64("choice"), parts).cast("int").alias("_part"))
    arrays = arrays.agg(F.sort_array(F.collect_list(F.struct("ordinal", "choice"))).alias("_choices"))
    names = df.select(F.col(name).alias("_name")).where(F.col(name).isNotNull()).distinct()
    met = names.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).join(arrays, "_part")
    scored = met.select("_name", best_of(F.col("_name"), F.col("_choices"), scorer).alias("_b"))
    top = scored.groupBy("_name").agg(F.max_by("_b", F.struct("_b.score", -F.col("_b.ordinal"))).alias("_b"))
    accepted = F.col("_b.score") > cutoff if strict else F.col("_b.score") >= cutoff
    best = top.select(
        F.col("_name").alias(name),
        F.when(accepted, F.col("_b.choice")).alias("match"),
        F.col("_b.score").alias("score"),
    )
    return df.join(best, [name], "left").select(*df.columns, "match", "score")
