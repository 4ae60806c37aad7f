"""Sinks. None of them funnels rows into one task."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pathwarden.model import HISTORY_SCHEMA
from pathwarden.session import cut_lineage, discard
from pathwarden.sources.readers import CSV_QUOTING


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_QUOTING).csv(path)


def write_problems(problems: DataFrame, path: str) -> None:
    """One folder per PROBLEM; what an earlier run left is replaced as a whole.

    The session may have dynamic partition overwrite on, under which a problem that is
    gone would keep its folder, so the mode is named here.
    """
    (
        problems.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .options(**CSV_QUOTING)
        .partitionBy("PROBLEM")
        .csv(path)
    )


def as_file(spark: SparkSession, folder: str, file: str) -> None:
    """Give a table written as one part file a name of its own, through Spark's file system."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    source, target = jvm.org.apache.hadoop.fs.Path(folder), jvm.org.apache.hadoop.fs.Path(file)
    system = source.getFileSystem(conf)
    system.mkdirs(target.getParent())
    parts = sorted(s.getPath().toString() for s in system.listStatus(source) if s.getPath().getName().startswith("part-"))
    system.rename(jvm.org.apache.hadoop.fs.Path(parts[0]), target)


def missing_history(scores: DataFrame, history: DataFrame) -> DataFrame:
    """The (date, total_score) rows, one per minute, whose minute the history does not hold."""
    minute = F.date_trunc("minute", F.col("date"))
    fresh = (
        scores.select(minute.alias("date"), "total_score")
        .groupBy("date")
        .agg(F.max("total_score").alias("total_score"))
    )
    return fresh.join(history.select(minute.alias("date")).distinct(), "date", "left_anti")


def _history_rows(spark: SparkSession, path: str) -> DataFrame:
    """All rows at `path` with the day and the run they were written by, none where there is no history yet."""
    schema = T.StructType([*HISTORY_SCHEMA.fields, T.StructField("day", T.DateType()), T.StructField("run", T.StringType())])
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The history at `path`, empty where there is none yet: of each minute the row of the first run that wrote it."""
    rows = _history_rows(spark, path)
    return rows.groupBy("date").agg(F.min_by("total_score", "run").alias("total_score"))


def append_history_if_absent(spark: SparkSession, scores: DataFrame, path: str) -> None:
    """Append to the parquet history at `path`, once per minute.

    The history has a folder per day, and only the days of the new scores are read. A run writes to folders of its own,
    which appear as a whole at its end, so runs at the same time neither lose nor mix files; of two that both found a
    minute absent, `read_history` takes the first. The new rows are stored before they are appended, so nothing reads the
    history while it is written.
    """
    run = f"{datetime.now(UTC):%Y%m%dT%H%M%S.%f}-{uuid.uuid4().hex}"
    days = scores.select(F.to_date("date").alias("day")).distinct()
    known = _history_rows(spark, path).join(days, "day", "left_semi").select("date")
    fresh = cut_lineage(missing_history(scores, known))
    (
        fresh.withColumn("day", F.to_date("date"))
        .withColumn("run", F.lit(run))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day", "run")
        .parquet(path)
    )
    discard(fresh)
