"""Repair of the hierarchy: continents, countries, parents, paths, levels, official level names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathwarden.functions.paths import path_depth, segments, tail_after
from pathwarden.functions.similarity import best_of, score_of
from pathwarden.functions.text import title_name
from pathwarden.model import CONTINENTS, ROOT_CODES, SEPARATOR
from pathwarden.operators.joins import (
    anti_by_key,
    best_match,
    dimension,
    lookup,
    lookup_default,
    small_table,
    under_prefix,
)
from pathwarden.operators.rows import continent_candidates, drop_groups, key_union, union_ragged

NOT_FOUND = "NOT FOUND"


def first_ancestor_in(df: DataFrame, codes: DataFrame, name: str = "PARENT", small: bool = False) -> DataFrame:
    """Add the first path segment that is one of `codes` (column CODE); null without one.

    The segments of the distinct paths are joined with the codes. A table of codes that is known to be `small` (checked)
    is looked up within each row instead, with no shuffle.
    """
    others = [c for c in df.columns if c != name]
    if small:
        known = small_table(codes.select("CODE").dropna().distinct(), F.col("CODE"), "codes")
        within = F.array_intersect(segments(F.col("HIERARCHY")), F.col("_codes"))
        return df.withColumn("_codes", known).select(*others, F.get(within, F.lit(0)).alias(name))
    paths = df.select("HIERARCHY").where(F.col("HIERARCHY").isNotNull()).distinct()
    steps = paths.select("HIERARCHY", F.posexplode(segments(F.col("HIERARCHY"))).alias("_at", "CODE"))
    hits = steps.join(codes.select("CODE").distinct(), ["CODE"])
    first = hits.groupBy("HIERARCHY").agg(F.min_by("CODE", "_at").alias(name))
    return df.drop(name).join(first, ["HIERARCHY"], "left").select(*others, name)


def drop_unparented(df: DataFrame) -> DataFrame:
    return df.where(F.col("PARENT").isNotNull() | F.coalesce(F.col("CODE").isin(ROOT_CODES), F.lit(False)))


def rebase_path(df: DataFrame, countries: DataFrame, order: Column) -> DataFrame:
    """Put rows under their country's corrected path; countries themselves keep theirs.

    What precedes the country's segment is replaced, a missing path becomes the
    country's path, and a path without that segment stays.
    """
    paths = dimension(countries, F.col("CODE"), "PARENT", {"_base": F.col("HIERARCHY")}, order)
    found = lookup(df, paths, ["PARENT"])
    path, parent, base = F.col("HIERARCHY"), F.col("PARENT"), F.col("_base")
    moved = F.concat_ws(SEPARATOR, F.concat(F.array(base), tail_after(path, parent)))
    is_country = F.coalesce(F.upper("LEVEL_NAME") == "COUNTRY", F.lit(False))
    rebased = (
        F.when(base.isNull() | is_country, path)
        .when(path.isNull(), base)
        .when(F.array_contains(segments(path), parent), moved)
        .otherwise(path)
    )
    return found.withColumn("HIERARCHY", rebased).select(*df.columns)


def build_country_path(countries: DataFrame, continents: DataFrame, order: Column) -> DataFrame:
    """A country's path is its continent's path and its own code; no continent leaves the first part empty."""
    paths = dimension(continents, F.col("NAME"), "CONTINENT", {"_base": F.col("HIERARCHY")}, order)
    found = lookup_default(countries, "CONTINENT", paths, "_base", F.lit(""))
    return found.withColumn("HIERARCHY", F.concat("_base", F.lit(SEPARATOR), "CODE")).select(*countries.columns)


def assign_level_number(df: DataFrame, countries: DataFrame) -> DataFrame:
    """LEVEL_NUMBER is the depth below the nearest country path above the row; null under none."""
    rows = drop_groups(df).drop("LEVEL_NUMBER")
    bases = countries.select(F.col("HIERARCHY").alias("_prefix")).where("_prefix is not null").distinct()
    bases = bases.withColumn("_base_depth", path_depth(F.col("_prefix")))
    found = under_prefix(rows, "HIERARCHY", bases, "_prefix", ["_base_depth"])
    return found.withColumn("LEVEL_NUMBER", path_depth(F.col("HIERARCHY")) - F.col("_base_depth")).drop("_base_depth")


def fix_port_paths(df: DataFrame, order: Column) -> DataFrame:
    """Port terminals of a wrong level go right below their country, at level 1."""
    countries = df.where(F.col("LEVEL_NAME") == "COUNTRY")
    paths = dimension(countries, F.col("CODE"), "PARENT", {"_base": F.col("HIERARCHY")}, order)
    found = lookup_default(df, "PARENT", paths, "_base", F.lit(""))
    wrong = F.coalesce((F.col("LEVEL_NAME") == "PORT_TERMINAL") & (F.col("LEVEL_NUMBER") != 1), F.lit(False))
    moved = F.coalesce(F.concat("_base", F.lit(SEPARATOR), "CODE"), F.col("HIERARCHY"))
    return (
        found.withColumn("HIERARCHY", F.when(wrong, moved).otherwise(F.col("HIERARCHY")))
        .withColumn("LEVEL_NUMBER", F.when(wrong, F.lit(1)).otherwise(F.col("LEVEL_NUMBER")))
        .select(*df.columns)
    )


def build_continents(
    raw: DataFrame, names: list[str] = CONTINENTS, scorer: str = "weighted", above: int = 90
) -> tuple[DataFrame, DataFrame]:
    """The continent rows, and all other non-group rows.

    Continents are the candidates whose name scores above the cutoff for one of the
    fixed names, plus South America with its path set, Oceania and Antarctica.
    """
    rows = drop_groups(raw)
    candidates = continent_candidates(rows)
    distinct = candidates.select("NAME").where(F.col("NAME").isNotNull()).distinct()
    compared = distinct.withColumn("_continent", F.explode(F.array(*[F.lit(n) for n in names])))
    scored = compared.withColumn("_score", score_of(F.col("_continent"), F.col("NAME"), scorer))
    named = candidates.join(scored.where(F.col("_score") > above).select("NAME"), ["NAME"]).select(*rows.columns)
    south = rows.where(F.col("CODE") == "SOAME").withColumn("HIERARCHY", F.lit("ALL#WORLD#SOAME"))
    oceania = raw.sparkSession.range(1).select(
        F.lit("Oceania").alias("NAME"),
        F.lit("OCE").alias("CODE"),
        F.lit("ALL#WORLD#OCE").alias("HIERARCHY"),
        F.lit(False).alias("IS_GROUP"),
        F.lit(None).cast("string").alias("CHILDREN"),
    )
    antarctica = rows.where(F.col("CODE") == "ATA")
    continents = (
        union_ragged(named, south, oceania, antarctica)
        .withColumn("LEVEL_NAME", F.lit("CONTINENT"))
        .withColumn("NAME", title_name(F.col("NAME")))
    )
    return continents, anti_by_key(rows, continents, "CODE")


def assign_continent(
    countries: DataFrame,
    known: DataFrame,
    reference: DataFrame,
    continents: list[str] = CONTINENTS,
    scorer: str = "weighted",
    above: int = 80,
) -> DataFrame:
    """Add CONTINENT: the known one (country, continent), else that of the most similar reference name.

    `reference` has (country, continent_name, ordinal); names scoring `above` or less are NOT FOUND.
    """
    exact = dimension(known, F.col("country"), "NAME", {"_exact": F.col("continent")}, F.col("continent"))
    exact = exact.where(F.col("_exact").isin(continents))
    found = lookup_default(countries, "NAME", exact, "_exact")
    entries = dimension(
        reference,
        F.col("country"),
        "country",
        {"continent_name": F.col("continent_name")},
        F.col("ordinal"),
        place="place",
    )
    choices = entries.select(F.col("country").alias("choice"), F.col("place").alias("ordinal"))
    unknown = found.where(F.col("_exact").isNull() & F.col("NAME").isNotNull()).select("NAME").distinct()
    similar = best_match(unknown, "NAME", choices, scorer, above, strict=True).where(F.col("match").isNotNull())
    named = entries.select(F.col("country").alias("match"), "continent_name")
    similar = lookup(similar, named, ["match"]).select("NAME", F.col("continent_name").alias("_similar"))
    filled = lookup_default(found, "NAME", similar, "_similar")
    continent = F.coalesce("_exact", "_similar", F.lit(NOT_FOUND))
    return filled.select(*countries.columns, continent.alias("CONTINENT"))


def split_found(countries: DataFrame, continents: list[str] = CONTINENTS) -> tuple[DataFrame, DataFrame]:
    """Countries with a continent, and those without. A code on both sides counts as without."""
    known = F.coalesce(F.col("CONTINENT").isin(continents), F.lit(False))
    missing = countries.where(~known)
    return anti_by_key(countries, missing, "CODE"), missing


def add_parent(rest: DataFrame, countries: DataFrame, missing: DataFrame, continents: DataFrame) -> DataFrame:
    """Rows below countries with PARENT set; continents and countries are taken out."""
    taken = key_union(continents, missing, countries, key="CODE")
    return drop_unparented(first_ancestor_in(anti_by_key(rest, taken, "CODE"), countries))


def merge_levels(rest: DataFrame, countries: DataFrame, continents: DataFrame) -> DataFrame:
    """Countries at level 0 under their continent, continents at -1 under WORLD, and the rest."""
    level_0 = countries.withColumnRenamed("CONTINENT", "PARENT").withColumn("LEVEL_NUMBER", F.lit(0))
    level_1 = continents.withColumn("LEVEL_NUMBER", F.lit(-1)).withColumn("PARENT", F.lit("WORLD"))
    return union_ragged(rest, level_0, level_1)


def find_outliers(raw: DataFrame, processed: DataFrame) -> DataFrame:
    return anti_by_key(raw, processed, "CODE")


def official_level_name(
    df: DataFrame, reference: DataFrame, scorer: str = "ratio_plain", country_cutoff: int = 85, level_cutoff: int = 50
) -> DataFrame:
    """Add OFFICIAL_LEVEL_NAME, the country's own word for the row's level.

    `reference` has (code, country, level_1 array, level_2, level_3, ordinal). Each distinct
    (PARENT, LEVEL_NAME, LEVEL_NUMBER) is resolved once. Without an entry or a
    candidate the row keeps LEVEL_NAME.
    """
    keys = ["PARENT", "LEVEL_NAME", "LEVEL_NUMBER"]
    level = F.lower(F.trim(F.coalesce("LEVEL_NAME", F.lit("nan"))))
    cases = df.select(*keys).where(F.col("PARENT").isNotNull() & F.col("LEVEL_NUMBER").isin(1, 2, 3)).distinct()
    cases = cases.where(~level.isin("country", "continent", "all", "world"))
    cases = cases.withColumn("_code", F.trim("PARENT"))

    # The country by its code, or by the name most similar to the code.
    by_code = dimension(reference, F.col("code"), "_code", {"_country": F.col("country")}, F.col("ordinal"))
    values = {c: F.col(c) for c in ("level_1", "level_2", "level_3")}
    by_name = dimension(reference, F.col("country"), "country", values, F.col("ordinal"), place="place")
    cases = lookup(cases, by_code, ["_code"])
    choices = by_name.select(F.col("country").alias("choice"), F.col("place").alias("ordinal"))
    unknown = cases.where(F.col("_country").isNull()).select("_code").distinct()
    similar = best_match(unknown, "_code", choices, scorer, country_cutoff).select("_code", F.col("match").alias("_similar"))
    cases = lookup(cases, similar, ["_code"])
    entries = by_name.select(F.col("country").alias("_named"), F.struct(*values).alias("_entry"))
    cases = cases.join(entries, F.coalesce("_country", "_similar") == F.col("_named"), "left")
    single = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.array(c))
    names = F.when(F.col("LEVEL_NUMBER") == 1, F.col("_entry.level_1")).when(F.col("LEVEL_NUMBER") == 2, single("_entry.level_2"))
    named = F.filter(names.otherwise(single("_entry.level_3")), lambda n: n.isNotNull())
    options = F.transform(named, lambda n, i: F.struct(i.alias("ordinal"), n.alias("choice")))
    scored = cases.select(*keys, level.alias("_level"), options.alias("_options"))
    scored = scored.withColumn("_best", best_of(F.col("_level"), F.col("_options"), scorer))
    chosen = F.when(F.col("_best.score") >= level_cutoff, F.col("_best.choice")).otherwise(
        F.get(F.col("_options"), F.lit(0))["choice"]
    )
    official = scored.select(*[F.col(k).alias(f"_{k}") for k in keys], F.upper(chosen).alias("_official"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    found = df.join(official, same, "left")
    return found.select(*df.columns, F.coalesce("_official", "LEVEL_NAME").alias("OFFICIAL_LEVEL_NAME"))
