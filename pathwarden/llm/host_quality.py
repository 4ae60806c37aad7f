"""Quality rules by host: failures per domain, shrunk by an empirical beta prior, decide with the rules of the text.

Edge cases: a null or empty text has no words and fails the word count. A null host is a host of its own. Repeated rows
are measured one by one and count one by one. An empty table gives an empty result. Columns that the input has besides
stay as they are; only those named like the measures and verdicts are replaced.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathwarden.llm.packing import free_name

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Failures that count against the host only: symbols per word and repeated lines per line, in percent.
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 30
#: A host goes if its shrunk failure rate reaches this.
REJECT_RATE = 0.9

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def repeat_words(words: list[bytes]) -> int:
    """How many words stand in a window of three words that the text has twice or more."""
    if len(words) < 4:
        return 0
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    # Two steps of numbering keep the keys exact for any number of distinct words.
    pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
    _, place, count = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    again = count[place] > 1
    marked = np.zeros(len(words), bool)
    for shift in range(3):
        marked[shift : shift + len(again)] |= again
    return int(marked.sum())


def text_measures(text: str | None) -> tuple[int, ...]:
    if not text:
        return 0, 0, 0, 0, 0, 0
    words = text.encode().split()  # of bytes, so at ASCII white space alone
    blank = sum(map(text.count, SPACES))
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    repeated = sum(n - 1 for n in Counter(lines).values())
    return len(words), len(text) - blank, sum(map(text.count, SYMBOLS)), repeated, repeat_words(words), len(lines)


def measure(text: Column) -> Column:
    """The measures of a text as one struct."""

    @F.arrow_udf(f"struct<{', '.join(f'{m}: bigint' for m in MEASURES)}>")
    def measures(texts: pa.Array) -> pa.Array:
        rows = np.array([text_measures(t.as_py()) for t in texts], np.int64).reshape(-1, len(MEASURES))
        return pa.StructArray.from_arrays([pa.array(c) for c in rows.T], MEASURES)

    return measures(text)


def with_measures(docs: DataFrame) -> DataFrame:
    """Add the measures of `text`, `base_failed` and `rule_failed` (any rule, those for hosts included)."""
    name = free_name(docs.columns, "_measures")
    rows = docs.withColumn(name, measure(F.col("text")))
    rows = rows.withColumns({m: F.col(f"{name}.{m}") for m in MEASURES}).drop(name)
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    symbols = 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("n_words")
    lines = 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines")
    return rows.withColumn("base_failed", base).withColumn("rule_failed", F.col("base_failed") | symbols | lines)


def host_verdicts(measured: DataFrame, host: str = "source", reject_rate: float = REJECT_RATE) -> DataFrame:
    """One row per host: its documents and failures, the shrunk rate and whether its documents go.

    The prior Beta(a, b) has the mean and variance of the hosts' rates, less the variance that chance gives a host of its
    size. Without such a variance (one host, equal rates) all hosts get the mean. The rate is (failures + a) / (documents + a + b).
    """
    hosts = measured.groupBy(F.col(host).alias("_host")).agg(
        F.count(F.lit(1)).alias("host_docs"), F.sum(F.col("rule_failed").cast("long")).alias("host_failed")
    )
    rate = F.col("host_failed") / F.col("host_docs")
    moments = hosts.agg(F.avg(rate).alias("m"), F.var_samp(rate).alias("v"), F.avg(1 / F.col("host_docs")).alias("d"))
    chance = F.col("m") * (1 - F.col("m"))
    over = F.col("v") - chance * F.col("d")
    strength = F.when(F.coalesce(over, F.lit(0.0)) > 0, F.greatest(chance / over - 1, F.lit(0.0)))
    prior = moments.select(F.struct("m", strength.alias("s"))).scalar()
    rows = hosts.withColumn("_prior", prior)
    shrunk = (F.col("host_failed") + F.col("_prior.m") * F.col("_prior.s")) / (F.col("host_docs") + F.col("_prior.s"))
    rows = rows.withColumn("host_rate", F.coalesce(shrunk, F.col("_prior.m"))).drop("_prior")
    return rows.withColumn("host_rejected", F.col("host_rate") >= reject_rate)


def judge(measured: DataFrame, verdicts: DataFrame, host: str = "source") -> DataFrame:
    """Add the host's rate and `kept`: no base rule failed and the host is not rejected."""
    name = free_name(measured.columns, "_host")
    verdicts = verdicts.select(F.col("_host").alias(name), "host_rate", "host_rejected")
    joined = measured.drop("host_rate", "host_rejected", "kept").join(verdicts, F.col(host).eqNullSafe(F.col(name)), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected")).drop(name)


def keep_good(docs: DataFrame, host: str = "source", reject_rate: float = REJECT_RATE) -> DataFrame:
    """The documents that pass, with the columns they came with.

    Texts are measured twice, for the hosts and for the verdict, so that none has to be shuffled or stored.
    """
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{host}`").alias("_source"), "text")
    verdicts = host_verdicts(with_measures(docs.select(F.col(f"`{host}`").alias("_source"), "text")), "_source", reject_rate)
    return judge(with_measures(packed), verdicts, "_source").where("kept").select("_row.*")
