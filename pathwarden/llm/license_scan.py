"""License notices by an exact set-similarity join between text blocks and templates, in built-in expressions alone.

Tokens are ordered by their frequency over all documents, rarest first. A block holds a template if it has at least
`threshold` of its distinct tokens. Such a block must have one of the template's rarest tokens (prefix filter), enough
tokens of the vocabulary (length filter), and enough of them left behind the first one met (positional filter); what
passes is verified. Blocks are windows of 2 M words that begin every M words, M being the longest template, so each
stretch of M words lies whole in a block. Phrases are templates of which all tokens must be met and then stand in a row.

Edge cases: a null or empty text has no words and no labels (empty strings, score 0). Repeated rows are scanned one by
one. An empty table gives no rows. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathwarden.session import cut_lineage

#: The phrases that label a text wherever their words stand in a row.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Words of common license notices, with the label of the license.
TEMPLATES = [
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("under the terms of the gnu general public license", "gpl"),
    ("this work is licensed under the gnu general public license", "gpl"),
    ("under the terms of the gnu lesser general public license", "lgpl"),
    ("under the terms of the gnu affero general public license", "agpl"),
    ("licensed under cc by nc", "cc-by-nc"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
]
THRESHOLD = 0.9
#: Templates are a parameter that is shipped to all tasks: at most so many distinct tokens.
MOST_TOKENS = 10_000

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def _texts(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _needs(phrases: dict[str, str], templates: list[tuple[str, str]], threshold: float) -> list[tuple]:
    """(number, kind, label, tokens, how many of them a block needs); equal token sets of one label come once."""
    sets = [("phrase", text, text.split(), 1.0) for text in phrases] + [("template", label, text.split(), threshold) for text, label in templates]
    # The small offset keeps a whole product whole.
    return [(n, kind, label, sorted(set(words)), max(1, ceil(len(set(words)) * share - 1e-9))) for n, (kind, label, words, share) in enumerate(sets)]


def prepare(docs: DataFrame, needs: list[tuple], key: str, text: str) -> DataFrame:
    """One stored row per text: its word count, the template tokens it has, and its words if they could fill a template."""
    vocabulary = sorted({t for need in needs for t in need[3]})
    if len(vocabulary) > MOST_TOKENS:
        raise ValueError(f"the templates have over {MOST_TOKENS} tokens")
    rows = docs.select(F.col(key).alias("key"), words_of(F.col(text)).alias("words"))
    rows = rows.withColumn("present", F.array_intersect(_texts(vocabulary), "words"))
    enough = F.lit(False)
    for _, _, _, tokens, need in needs:
        enough = enough | (F.size(F.array_intersect(_texts(tokens), "present")) >= need)
    return cut_lineage(
        rows.select(F.monotonically_increasing_id().alias("row"), "key", F.size("words").cast("long").alias("n_words"), "present", F.when(enough, F.col("words")).alias("words"))
    )


def by_frequency(rows: DataFrame, tokens: list[str]) -> list[str]:
    """The tokens of the templates, rarest in the documents first. No more rows come back than templates have tokens."""
    counts = {r["token"]: r["n"] for r in rows.select(F.explode("present").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()}
    return sorted(tokens, key=lambda t: (counts.get(t, 0), t))


def prefix_index(spark: SparkSession, needs: list[tuple], order: list[str]) -> DataFrame:
    """(token, number, size, need, place) for the tokens of each template of which a block must have one."""
    rank = {t: i for i, t in enumerate(order)}
    rows = []
    for number, _, _, tokens, need in needs:
        ranked = sorted(tokens, key=rank.__getitem__)
        rows += [(t, number, len(ranked), need, place) for place, t in enumerate(ranked[: len(ranked) - need + 1])]
    return spark.createDataFrame(rows, "token string, number int, size int, need int, place int")


def matches(rows: DataFrame, needs: list[tuple], width: int) -> DataFrame:
    """The templates that each row meets in some block: (row, number, score), score the largest share of its tokens."""
    spark = rows.sparkSession
    order = by_frequency(rows, sorted({t for need in needs for t in need[3]}))
    blocks = rows.where("words is not null and n_words > 0").select(
        "row", F.posexplode(F.expr(f"transform(sequence(0, size(words) - 1, {width}), i -> slice(words, i + 1, {2 * width}))")).alias("block", "piece")
    )
    # In the order of the first array: each block's tokens, rarest first.
    blocks = blocks.select("row", "block", F.array_intersect(_texts(order), "piece").alias("tokens"))
    probes = blocks.where(F.size("tokens") > 0).select("*", F.posexplode("tokens").alias("at", "token"))
    index = prefix_index(spark, needs, order)
    left = 1 + F.least(F.col("size") - F.col("place") - 1, F.size("tokens") - F.col("at") - 1)
    candidates = probes.join(F.broadcast(index), "token").where((F.size("tokens") >= F.col("need")) & (left >= F.col("need")))
    candidates = candidates.dropDuplicates(["row", "block", "number"])
    full = spark.createDataFrame([(n, tokens) for n, _, _, tokens, _ in needs], "number int, of array<string>")
    met = F.size(F.array_intersect("of", "tokens"))
    verified = candidates.join(F.broadcast(full), "number").where(met >= F.col("need"))
    return verified.groupBy("row", "number").agg(F.max(met / F.col("size")).alias("score"))


def scan(
    docs: DataFrame, key: str = "doc_id", text: str = "text", phrases: dict[str, str] = PHRASES,
    templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per text: key, n_words, places of phrases (n_base, first_word, last_word), labels and the best score."""
    needs = _needs(phrases, templates, threshold)
    rows = prepare(docs, needs, key, text)
    width = max(len(t.split()) for t in [*phrases, *[t for t, _ in templates]])
    found = matches(rows, needs, width)
    names = rows.sparkSession.createDataFrame([(n, kind, label) for n, kind, label, _, _ in needs], "number int, kind string, label string")
    found = found.join(F.broadcast(names), "number").groupBy("row").agg(
        F.collect_set(F.when(F.col("kind") == "template", F.col("label"))).alias("found"),
        F.collect_set(F.when(F.col("kind") == "phrase", F.col("label"))).alias("asked"),
        F.max(F.when(F.col("kind") == "template", F.col("score"))).alias("best"),
    )
    rows = rows.drop("present").join(found, "row", "left")
    nowhere = F.expr("cast(array() as array<int>)")
    every = []
    for phrase in phrases:
        stands = " and ".join(f"get(words, i + {i}) = '{word}'" for i, word in enumerate(phrase.split()))
        places = F.expr(f"filter(sequence(0, size(words) - 1), i -> {stands})")
        every.append(f"places{len(every)}")
        rows = rows.withColumn(every[-1], F.when(F.array_contains("asked", phrase), places))
        rows = rows.withColumn(every[-1], F.coalesce(every[-1], nowhere))
    rows = rows.withColumn("places", F.concat(nowhere, *every)).withColumn("n_base", F.size("places").cast("long"))
    labels = [F.when(F.size(p) > 0, F.lit(label)) for p, label in zip(every, phrases.values(), strict=True)]
    base = F.array_sort(F.array_distinct(F.array_compact(F.array(*labels, F.lit(None).cast("string")))))
    both = F.array_sort(F.array_union(base, F.coalesce("found", F.expr("cast(array() as array<string>)"))))
    return rows.select(
        F.col("key").alias(key), "n_words", "n_base", F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(both, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
