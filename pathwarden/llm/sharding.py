"""Sharding by proportional stratified interleaving: every shard has the mixture of sources of the whole.

The rows of each source are put in a seeded order; the row of rank r of n gets the fractional rank (2r - 1) / 2n, and the
rows sorted by it are cut into shards whose row counts differ by one at most (law `rows`). Any stretch of that order
holds each source by its share, rounded, so each shard does.

The rows of each ranking are stored, cut into ranges of the whole order, in the folder of `spark.checkpoint.dir`.

Edge cases: a null source is a source of its own; a null text has no bytes (size 1, checksum 0). Rows with one id get
neighbouring ranks, told apart by checksum and size; full copies are alike and may swap. An empty table gives no rows.
Only the columns named in the call are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pathwarden.session import cut_lineage

SHARDS = 8
SEED = "interleave-1"
#: Rows of a range, about, if there are more than the shuffle partitions take. Any value gives the same result.
BUCKET_ROWS = 1_000_000


def _ranked(rows: DataFrame, n: int, group: list[str], order: list[str], to: str) -> DataFrame:
    """Add the rank from 1 within each group of the `n` rows, without sorting a group in one task.

    The rows are cut into ranges of the whole order and stored with their range, so ties in its first columns spread over
    ranges too. Rows are numbered in their range; a window over no more rows than ranges and groups meet adds up the counts.
    """
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // BUCKET_ROWS))
    ranges = cut_lineage(rows.repartitionByRange(parts, *group, *order).withColumn("_range", F.spark_partition_id()))
    keys = [*group, "_range"]
    counts = ranges.groupBy(*keys).agg(F.count(F.lit(1)).alias("_in"))
    before = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.coalesce(F.sum("_in").over(before), F.lit(0))).drop("_in")
    starts = starts.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    match = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    numbered = ranges.withColumn(to, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered.join(starts, match, "left").withColumn(to, F.col(to) + F.col("_start")).drop("_range", "_start", *[f"_of_{k}" for k in keys])


def interleave(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """One row per document: key, source, size, text_crc32, position from 0, shard and slot in the shard from 0."""
    n = docs.count()
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    rows = docs.select(
        F.col(key).alias("_key"),
        F.col(source).alias("_source"),
        size.alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("text_crc32"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("null")))).alias("_order"),
    )
    totals = docs.groupBy(F.col(source).alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    rows = rows.join(totals, F.col("_source").eqNullSafe(F.col("_of")), "left").drop("_of")
    ties = ["_order", "_key", "text_crc32", "size"]
    rows = _ranked(rows, n, ["_source"], ties, "_rank")
    rows = rows.withColumn("_share", (2 * F.col("_rank") - 1) / (2 * F.col("_n")))
    rows = _ranked(rows, n, [], ["_share", "_source", *ties], "_place").withColumn("_all", F.lit(n))
    place = F.col("_place") - 1
    # Shard s takes the places from ceil(s n / k) to ceil((s + 1) n / k).
    shard = F.expr(f"(_place - 1) * {shards} div _all")
    start = F.expr(f"(shard * _all + {shards - 1}) div {shards}")
    rows = rows.withColumn("position", place).withColumn("shard", shard.cast("int")).withColumn("slot", place - start)
    return rows.select(F.col("_key").alias(key), F.col("_source").alias(source), "size", "text_crc32", "position", "shard", "slot")
