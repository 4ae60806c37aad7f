"""A location table derived from the star-schema tables, defects included (see FIXTURES.md)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathwarden.model import RAW_COLUMNS

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _rows(
    df: DataFrame, row_id, name, code, path, level, parent, number, is_group="false", children="cast(null as string)"
) -> DataFrame:
    return df.selectExpr(
        f"cast({row_id} as bigint) as row_id",
        f"{name} as NAME",
        f"{code} as CODE",
        f"{path} as HIERARCHY",
        f"{is_group} as IS_GROUP",
        f"{children} as CHILDREN",
        f"{level} as LEVEL_NAME",
        f"{parent} as PARENT",
        f"cast({number} as int) as LEVEL_NUMBER",
        f"{level} as OFFICIAL_LEVEL_NAME",
    )


def _every(n: int) -> str:
    return f"(c_custkey > 0 AND c_custkey % {n} = 0)"


def location_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The processed location table with `row_id` as its order."""
    region, nation, customer, supplier, part = (
        table(spark, sf_dir, t) for t in ("region", "nation", "customer", "supplier", "part")
    )
    country = nation.join(region, F.expr("n_regionkey = r_regionkey")).selectExpr(
        "n_nationkey",
        "n_name",
        "r_name",
        "concat('N', n_nationkey) as n_code",
        "concat('ALL#WORLD#R', r_regionkey, '#N', n_nationkey) as n_path",
    )
    segments = customer.select("c_nationkey", "c_mktsegment").where("c_nationkey % 7 <> 0").distinct()
    places = "array(" + ", ".join(f"'{s}'" for s in SEGMENTS) + ")"
    names = part.selectExpr("p_partkey as part_key", "p_name")
    parts = part.agg(F.count("*")).scalar()

    def named(rows, key, nation_key):
        """Rows with their country and the name of the part their key falls on."""
        keyed = rows.withColumn("part_key", F.col(key) % parts)
        return keyed.join(names, "part_key").join(country, F.expr(f"{nation_key} = n_nationkey"))

    cities = named(customer, "c_custkey", "c_nationkey").selectExpr(
        "*", f"concat('C', if({_every(73)}, c_custkey - 1, c_custkey)) as code"
    )
    roots = spark.sql("SELECT * FROM VALUES (0, 'ALL', 'ALL'), (1, 'WORLD', 'ALL#WORLD') AS t(id, code, path)")
    null = "cast(null as string)"
    sections = [
        _rows(roots, "id", "code", "code", "path", null, null, "null"),
        _rows(
            region, "r_regionkey + 10", "r_name", "concat('R', r_regionkey)", "concat('ALL#WORLD#R', r_regionkey)",
            "'CONTINENT'", "'WORLD'", "-1",
        ),
        _rows(
            country, "n_nationkey + 100", "n_name", "n_code", "if(n_nationkey = 24, 'ALL#WORLD#N24', n_path)",
            "'COUNTRY'", "r_name", "0",
        ),
        _rows(
            segments.join(country, F.expr("c_nationkey = n_nationkey")),
            f"n_nationkey * 10 + array_position({places}, c_mktsegment) + 1000", "c_mktsegment",
            "concat(n_code, '_', c_mktsegment)", "concat(n_path, '#', n_code, '_', c_mktsegment)",
            "'REGION'", "n_code", "1",
        ),
        _rows(
            cities, "c_custkey * 2 + 10000", "p_name", "code",
            f"CASE WHEN {_every(67)} THEN concat('BAD_', code) WHEN {_every(83)} THEN null"
            " ELSE concat(n_path, '#', n_code, '_', c_mktsegment, '#C', c_custkey) END",
            f"if({_every(71)}, 'COUNTRY', 'CITY')", f"if({_every(89)}, null, n_code)", f"if({_every(97)}, 3, 2)",
            _every(79), f"CASE WHEN NOT {_every(79)} THEN null WHEN c_custkey % 3 = 0 THEN '[]' WHEN c_custkey % 3 = 2 THEN '[\"X\"]' END",
        ),
        _rows(
            named(supplier, "s_suppkey", "s_nationkey"), "s_suppkey * 2 + 10001", "p_name", "concat('S', s_suppkey)",
            "concat(n_path, '#S', s_suppkey)", "'PORT_TERMINAL'", "n_code", "1",
        ),
    ]
    return reduce(lambda a, b: a.unionByName(b), sections)


def raw_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as they come in: raw columns only, continents still called REGION."""
    level = F.when(F.col("LEVEL_NAME") == "CONTINENT", "REGION").otherwise(F.col("LEVEL_NAME"))
    return location_view(spark, sf_dir).withColumn("LEVEL_NAME", level).select("row_id", *RAW_COLUMNS)


def level_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per nation: its continent and the official names of its levels, in nation order."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    segments = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        F.sort_array(F.collect_set("c_mktsegment")).alias("level_1")
    )
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey).join(
        segments, nation.n_nationkey == segments.c_nationkey, "left"
    )
    return joined.select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("code"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("continent_name"),
        "level_1",
        F.lit("CITY").alias("level_2"),
        F.lit(None).cast("string").alias("level_3"),
        F.col("n_nationkey").cast("bigint").alias("ordinal"),
    )
