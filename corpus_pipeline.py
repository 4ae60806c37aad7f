"""From raw documents to token ids: quality, near duplicates, repeated passages, benchmark leaks, encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathwarden.llm import bag_minhash, byte_bpe, chunk_dedup, decontaminate, host_quality
from pathwarden.session import cut_lineage, discard


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return host_quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id stays."""
    return bag_minhash.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller id has go from the text; `n_chars` follows where the text changed."""
    freed = chunk_dedup.cut_repeats(docs, counts=("_gone", "_runs"))
    if "n_chars" in docs.columns:
        n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
        freed = freed.withColumn("n_chars", F.when(F.col("_gone") > 0, n_chars).otherwise(F.col("n_chars")))
    return freed.select(*[f"`{c}`" for c in docs.columns])


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.drop_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document that is left, their number, and digests of the ids and of what they decode to."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return byte_bpe.digest_columns(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN, with_ids=True).drop("text")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("encoded", encoded),
]

#: Signatures, rolling hashes and merges are beyond SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each reads what the one before it has written, which then is deleted."""
    docs, read = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = cut_lineage(docs)
            if read is not None:
                discard(read)
            read = docs
    return docs
