"""URL rules by a sort-merge range join: a rule is an interval of keys, and a sorted sweep knows the innermost open one.

The key of a url is its host with the labels reversed, cut after any label, and its path. A rule (host, path) fits a host
and its subdomains, so it is one interval on the part of the key that is its own host: from its path to its path followed
by a byte above all text. Intervals of one host nest like brackets. In the sorted sweep a rule's end brings back the rule
around it, so the last event before a url is the top of the stack of open rules.

Edge cases: a null url, or one without `://`, has an empty host and path and fits no rule. Rules without a host or path
(null) are dropped; of equal rules the larger verdict stays (`block` over `allow`). Ties in length go to the longer host.
Repeated pages are judged once and each gets the verdict. An empty table of pages or rules is fine. Only the columns
named in the call are read, so others may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Urls of one host that share a sweep, about. A host with more is cut into sweeps that each get its rules.
SWEEP_ROWS = 2_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    begin = F.instr(url, "://")
    rest = F.when(begin > 0, F.substring(url, begin + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(url)), "^[^?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def reversed_labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def nested(rules: DataFrame) -> DataFrame:
    """The rules as (site, path, rule, verdict, outer), with the rule right around each one on the same host."""
    rules = rules.where("host is not null and path is not null").select(
        F.array_join(reversed_labels(F.col("host")), ".").alias("site"), "path", F.concat("host", "path").alias("rule"), "verdict"
    )
    rules = rules.groupBy("site", "path").agg(F.max("rule").alias("rule"), F.max("verdict").alias("verdict"))
    own = F.struct("path", "rule", "verdict")
    starts = rules.select("site", "path", F.explode(F.expr("filter(transform(sequence(0, length(path)), n -> substring(path, 1, n)), p -> p != path)")).alias("start"))
    outer = starts.join(rules.select("site", F.col("path").alias("start"), own.alias("outer")), ["site", "start"])
    outer = outer.groupBy("site", "path").agg(F.max_by("outer", F.length("start")).alias("outer"))
    return rules.join(outer, ["site", "path"], "left").select("site", own.alias("own"), "outer")


def innermost(targets: DataFrame, rules: DataFrame, sweep_rows: int = SWEEP_ROWS) -> DataFrame:
    """The longest rule for each (host, path) that has one: (host, path, rule, verdict)."""
    tree = nested(rules)
    # No rule looks at more labels than the deepest has.
    depth = tree.agg(F.max(F.size(F.split("site", r"\.")))).scalar()
    points = targets.withColumn("_labels", reversed_labels(F.col("host"))).withColumn("_depth", F.coalesce(depth, F.lit(0)))
    sites = "transform(filter(sequence(1, greatest(size(_labels), 1)), i -> i <= _depth), i -> array_join(slice(_labels, 1, i), '.'))"
    points = points.select("host", "path", F.explode(F.expr(sites)).alias("site"))
    ruled = tree.groupBy("site").agg(F.count(F.lit(1)).alias("_rules"))
    loads = points.groupBy("site").agg(F.count(F.lit(1)).alias("_urls")).join(ruled, "site")
    sweeps = F.ceil(F.col("_urls") / F.greatest(F.lit(sweep_rows), F.col("_rules")))
    loads = loads.select("site", sweeps.alias("_sweeps"))

    events = tree.join(loads, "site").withColumn("_sweep", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_sweeps") - 1)))
    at = F.col("own.path").cast("binary")
    none = F.lit(None).cast("string")
    nothing = F.struct(none.alias("path"), none.alias("rule"), none.alias("verdict"))
    begins = events.select("site", "_sweep", at.alias("_at"), F.lit(0).alias("_kind"), F.col("own").alias("top"), none.alias("host"), none.alias("path"))
    closes = events.select(
        "site", "_sweep", F.concat(at, F.lit(bytearray(b"\xff"))).alias("_at"), F.lit(0).alias("_kind"), F.coalesce("outer", nothing).alias("top"), none.alias("host"), none.alias("path")
    )
    asked = points.join(loads, "site").select(
        "site", F.pmod(F.xxhash64("host", "path"), F.col("_sweeps")).alias("_sweep"), F.col("path").cast("binary").alias("_at"),
        F.lit(1).alias("_kind"), F.when(F.lit(False), nothing).alias("top"), "host", "path",
    )
    order = Window.partitionBy("site", "_sweep").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Without this the urls of a site would stay in the task that the join on the site put them in, whatever their sweep.
    dealt = begins.unionByName(closes).unionByName(asked).repartition("site", "_sweep")
    swept = dealt.withColumn("top", F.last("top", ignorenulls=True).over(order))
    hits = swept.where("_kind = 1 and top.rule is not null")
    size = F.struct(F.length("top.rule"), F.length("site"), F.col("top.rule"))
    best = hits.groupBy("host", "path").agg(F.max_by("top", size).alias("top"))
    return best.select("host", "path", "top.rule", "top.verdict")


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """One row per page: key, host, path, the longest rule that fits (else null) and its verdict, else `default`."""
    host, path = host_and_path(F.col(url))
    asked = pages.select(F.col(key).alias("_key"), host.alias("host"), path.alias("path"))
    found = innermost(asked.select("host", "path").distinct(), rules)
    rows = asked.join(found, ["host", "path"], "left")
    return rows.select(F.col("_key").alias(key), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
