"""Filters, sets, top-k, first rows and ordinals over whole rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pathwarden.functions.paths import path_depth
from pathwarden.model import ROOT_CODES
from pathwarden.session import fix_layout

LOW_BITS = (1 << 33) - 1


def drop_roots(df: DataFrame) -> DataFrame:
    """Without the two roots; a null code is dropped with them."""
    return df.where(~F.col("CODE").isin(ROOT_CODES))


def drop_groups(df: DataFrame) -> DataFrame:
    return df.where(F.col("IS_GROUP") == F.lit(False))


def continent_candidates(df: DataFrame) -> DataFrame:
    """REGION rows that sit directly under WORLD."""
    return df.where(
        F.startswith("HIERARCHY", F.lit("ALL#WORLD")) & (path_depth(F.col("HIERARCHY")) == 2) & (F.col("LEVEL_NAME") == "REGION")
    )


def filter_by_level(df: DataFrame, level: str) -> DataFrame:
    return df.where(F.col("LEVEL_NAME") == level)


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns).dropna().distinct()


def outside_root(df: DataFrame) -> DataFrame:
    """Rows whose path does not begin at the root; a missing path is outside as well."""
    return df.where(~F.coalesce(F.startswith("HIERARCHY", F.lit("ALL")), F.lit(False)))


def tag_constant(df: DataFrame, **tags) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in tags.items()})


def first_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first `n` rows in `order`: each task keeps its own first `n`, no full sort."""
    return df.orderBy(*order).limit(n)


def union_ragged(*frames: DataFrame) -> DataFrame:
    """All rows of all frames; a column that a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def key_union(*frames: DataFrame, key: str) -> DataFrame:
    return reduce(lambda a, b: a.union(b), [f.select(key) for f in frames]).distinct()


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first `k` rows of every key. Spark keeps only `k` per key before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key; null keys are equal to each other."""
    return top_k(df, keys, order, 1)


def in_group_order(groups: DataFrame, group: str = "seed", member: str = "id", name: str = "place") -> DataFrame:
    """Add a member's place in its group from 0: the row that opened it, then the others in order."""
    order = Window.partitionBy(group).orderBy(F.col(member) != F.col(group), member)
    return groups.withColumn(name, F.row_number().over(order) - 1)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def with_ordinal(df: DataFrame, order: list[str], name: str = "ordinal") -> DataFrame:
    """Number the rows from 0 in `order` without one task seeing them all.

    Rows are range-partitioned and sorted, and that layout is fixed by a checkpoint.
    A row's number is its place in its partition plus the rows of the partitions
    before it; the table of counts has one row per partition.
    """
    laid_out = fix_layout(df.repartitionByRange(*order).sortWithinPartitions(*order))
    placed = laid_out.withColumn("_at", F.monotonically_increasing_id())
    partition = F.shiftright("_at", 33).cast("int")
    counts = placed.groupBy(partition.alias("p")).count().orderBy("p").collect()
    starts, total = {}, 0
    for row in counts:
        starts[row["p"]] = total
        total += row["count"]
    if not starts:
        return df.withColumn(name, F.lit(0).cast("bigint"))
    offsets = df.sparkSession.createDataFrame(list(starts.items()), "_p int, _start bigint")
    numbered = placed.withColumn("_p", partition).join(F.broadcast(offsets), "_p")
    return numbered.withColumn(name, F.col("_start") + F.col("_at").bitwiseAND(F.lit(LOW_BITS))).select(
        *df.columns, name
    )
