"""Near-duplicate names and paths, in blocks of one level."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pathwarden.functions.paths import strip_levels
from pathwarden.model import RAW_COLUMNS
from pathwarden.operators.grouping import covered_nodes, ordered_members, seed_members
from pathwarden.operators.rows import distinct_rows, keep_first, top_k
from pathwarden.operators.similarity_join import similar_pairs
from pathwarden.session import cut_lineage


def _names(df: DataFrame, block: str, order: str, k: int) -> DataFrame:
    """One node per distinct name of a block: its first row as `id`, its first `k` rows as `rows`."""
    rows = df.select(F.col(block).alias("block"), F.col("NAME").alias("name"), F.col(order).alias("row")).dropna()
    firsts = top_k(rows, ["block", "name"], [F.col("row")], k)
    return firsts.groupBy("block", "name").agg(
        F.min("row").alias("id"), F.sort_array(F.collect_list("row")).alias("rows")
    )


def similar_names(
    df: DataFrame, block: str = "LEVEL_NAME", order: str = "row_id", k: int = 5, cutoff: int = 95, scorer: str = "weighted"
) -> DataFrame:
    """For each distinct name of a block, the `k` rows with the most similar names, if they reach the cutoff.

    Columns: block, id (first row with the name), name, rank (1 to k), row, match, score.
    Ties go to the earlier row, and a name's own rows are among its matches. Names
    travel with their first `k` rows, so a popular name costs no more than a rare one.
    """
    nodes = cut_lineage(_names(df, block, order, k))
    pairs = similar_pairs(nodes, scorer=scorer, name_cutoff=cutoff, extra=("rows",), now=True)

    def directed(me, other, score):
        return pairs.select(
            "block",
            F.col(me).alias("id"),
            F.col(f"{me}_name").alias("name"),
            F.col(f"{other}_name").alias("match"),
            F.col(f"{other}_rows").alias("rows"),
            F.col(score).alias("score"),
        ).where(F.col("score") >= cutoff)

    own = nodes.select("block", "id", "name", F.col("name").alias("match"), "rows", F.lit(100).alias("score"))
    if scorer == "weighted":
        own = own.where(F.col("name").rlike(r"(?U)\w"))
    matches = directed("a", "b", "name_score").unionByName(directed("b", "a", "name_score_back")).unionByName(own)
    each = matches.withColumn("row", F.explode("rows")).drop("rows")
    # Copies of a pair share their rank, so the cut at k before the shuffle keeps what is needed.
    place = F.dense_rank().over(Window.partitionBy("block", "id").orderBy(F.desc("score"), "row"))
    return distinct_rows(each.withColumn("rank", place).where(F.col("rank") <= k)).select(
        "block", "id", "name", "rank", "row", "match", "score"
    )


def group_by_name(matches: DataFrame) -> DataFrame:
    """Groups (block, group, rank, row) from `similar_names`, in row order.

    A name with two or more matched rows opens a group unless an earlier group
    matched it. The group is named by the first row with the name.
    """
    matches = cut_lineage(matches)
    several = matches.groupBy("block", "id").agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
    openers = matches.join(several.select("block", "id"), ["block", "id"], "left_semi")
    nodes = matches.select("block", F.col("name").alias("match"), F.col("id").alias("b")).distinct()
    edges = openers.select("block", F.col("id").alias("a"), "match").distinct()
    edges = edges.join(nodes, ["block", "match"]).where(F.col("a") < F.col("b"))
    seeds = openers.join(covered_nodes(edges.select("block", "a", "b")), ["block", "id"], "left_anti")
    return seeds.select("block", F.col("id").alias("group"), "rank", "row")


def group_rows(groups: DataFrame, df: DataFrame, order: str = "row_id", block: str = "LEVEL_NAME") -> DataFrame:
    """The rows of the groups, once each, with the columns `group` and `rank` of their first place."""
    first = groups.groupBy("row").agg(F.min(F.struct("group", "rank")).alias("_first"))
    placed = first.select(F.col("row").alias(order), F.col("_first.group").alias("group"), F.col("_first.rank").alias("rank"))
    return df.join(placed, [order])


def similar_path_pairs(
    df: DataFrame,
    block: str = "LEVEL_NAME",
    order: str = "row_id",
    name_cutoff: int = 95,
    path_cutoff: int = 95,
    scorer: str = "ratio",
) -> DataFrame:
    """Row pairs (block, a, b, name_score, path_score) whose names and paths both reach the cutoffs."""
    nodes = df.select(F.col(block).alias("block"), F.col(order).alias("id"), F.col("NAME").alias("name"), F.col("HIERARCHY").alias("path"))
    pairs = similar_pairs(nodes.dropna(), scorer=scorer, name_cutoff=name_cutoff, path_cutoff=path_cutoff, bare=True)
    return pairs.select("block", "a", "b", "name_score", "path_score")


def _similar_groups(nodes: DataFrame, scorer: str, name_cutoff: int, path_cutoff: int, name_block: str = "block", **options) -> DataFrame:
    """Groups (block, seed, id) of nodes (block, id, name, path). Full copies are one node while grouping."""
    nodes = cut_lineage(nodes.dropna())
    distinct = nodes.groupBy("block", "name", "path").agg(F.min("id").alias("id"))
    find = partial(similar_pairs, scorer=scorer, name_cutoff=name_cutoff, path_cutoff=path_cutoff, name_block=name_block, bare=True, now=True)
    grouped = seed_members(distinct, find, **options)
    # A copy is similar to whatever its first row is similar to, and to that row.
    first = nodes.groupBy("block", "name", "path").agg(F.min("id").alias("first"), F.count("*").alias("copies"))
    placed = first.withColumnRenamed("first", "id").join(grouped, ["block", "id"], "left")
    placed = placed.where(F.col("seed").isNotNull() | (F.col("copies") > 1))
    placed = placed.select("block", "name", "path", F.coalesce("seed", "id").alias("seed"))
    return nodes.join(placed, ["block", "name", "path"]).select("block", "seed", "id")


def similar_groups(
    df: DataFrame,
    block: str = "LEVEL_NAME",
    order: str = "row_id",
    name_cutoff: int = 95,
    path_cutoff: int = 95,
    scorer: str = "ratio",
    **options,
) -> DataFrame:
    """Groups (block, seed, id): each row joins the earliest row that opened a group and is similar to it."""
    nodes = df.select(F.col(block).alias("block"), F.col(order).alias("id"), F.col("NAME").alias("name"), F.col("HIERARCHY").alias("path"))
    return _similar_groups(nodes, scorer, name_cutoff, path_cutoff, **options)


def stripped_nodes(df: DataFrame, levels: list[int], block: str, order: str, more: list[str] | None = None) -> DataFrame:
    """A node for each row and number of levels taken off its path; the block is its level and that number."""
    nodes = df.withColumn("_levels", F.explode(F.array(*[F.lit(n) for n in levels]))).select(
        F.struct(F.col(block).alias("level"), F.col("_levels").alias("removed")).alias("block"),
        F.col(order).alias("id"),
        F.col("NAME").alias("name"),
        strip_levels(F.col("HIERARCHY"), F.col("_levels")).alias("path"),
        *(more or []),
    )
    return nodes.where(F.col("block.level").isNotNull())


def similar_groups_stripped(
    df: DataFrame,
    levels: int | list[int],
    block: str = "LEVEL_NAME",
    order: str = "row_id",
    name_cutoff: int = 90,
    path_cutoff: int = 90,
    scorer: str = "ratio",
    **options,
) -> DataFrame:
    """`similar_groups` on paths without their last levels, for one or several numbers of levels.

    Columns: block, levels, seed, id. All numbers of levels are grouped in the same rounds.
    """
    numbers = levels if isinstance(levels, list) else [levels]
    nodes = stripped_nodes(df, numbers, block, order)
    groups = _similar_groups(nodes, scorer, name_cutoff, path_cutoff, "block.level", **options)
    return groups.select(F.col("block.level").alias("block"), F.col("block.removed").alias("levels"), "seed", "id")


def name_groups(df: DataFrame, block: str, order: str, k: int, cutoff: int, scorer: str) -> DataFrame:
    return cut_lineage(group_by_name(similar_names(df, block, order, k, cutoff, scorer)))


def name_duplicates(
    df: DataFrame, block: str = "LEVEL_NAME", order: str = "row_id", k: int = 5, cutoff: int = 95, scorer: str = "weighted"
) -> DataFrame:
    """The rows of all name groups, full copies once (the order column aside)."""
    rows = group_rows(name_groups(df, block, order, k, cutoff, scorer), df, order).select(*df.columns)
    columns = [c for c in df.columns if c != order]
    return keep_first(rows, columns, [F.col(order)])


def static_detection(
    df: DataFrame,
    block: str = "LEVEL_NAME",
    order: str = "row_id",
    k: int = 5,
    cutoff: int = 95,
    path_cutoff: int = 90,
    scorer: str = "weighted",
    pair_scorer: str = "ratio",
    removed: tuple[int, ...] = (0, 1, 2, 3),
    **options,
) -> DataFrame:
    """Rows that share a name group and, with up to three path levels removed, a similar path.

    Adds LEVELS_REMOVED. A row (by its six raw columns) is listed once, at its first
    level, then its smallest number of removed levels.
    """
    found = cut_lineage(group_rows(name_groups(df, block, order, k, cutoff, scorer), df, order).select(*df.columns, "group", "rank"))
    rows = found.select(*df.columns)
    # Rows are visited in the order of the name groups, as they were found there.
    nodes = stripped_nodes(found, list(removed), block, order, ["group", "rank"]).dropna()
    nodes = nodes.withColumn("place", F.col("group") * (k + 1) + F.col("rank")).drop("group", "rank")
    find = partial(similar_pairs, scorer=pair_scorer, name_cutoff=path_cutoff, path_cutoff=path_cutoff, name_block="block.level", bare=True, now=True)
    groups = ordered_members(nodes, find, **options).select(F.col("block.removed").alias("levels"), "seed", F.col("id").alias(order))
    placed = rows.join(groups, [order])
    tagged = placed.withColumn("LEVELS_REMOVED", F.concat(F.col("levels").cast("string"), F.lit(" LEVELS")))
    # The key holds the level, so rows of different levels never compete.
    kept = keep_first(tagged, RAW_COLUMNS, [F.col("levels"), F.col("seed"), F.col(order)])
    return kept.select(*df.columns, "LEVELS_REMOVED")
