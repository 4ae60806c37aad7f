"""Session settings for local runs, and the one place that knows where to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark; on a cluster bring your own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("pathwarden")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # A join splits its hot keys even where that costs a shuffle after it.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder on shared storage that `spark.checkpoint.dir` names.

    Loops must survive lost executors, so intermediate tables go there. Only a local
    session without that setting gets a folder made for it.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            folder = tempfile.mkdtemp(prefix="pathwarden-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame, by: str | None = None) -> DataFrame:
    """Write `df` once to the checkpoint folder and read it back, as a table with its own statistics.

    Readers prune its columns, and the values of the column `by`; its size lets Spark choose joins.
    """
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/table-{uuid.uuid4().hex}"
    (df.write if by is None else df.write.partitionBy(by)).parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def discard(stored: DataFrame) -> None:
    """Delete a table that `cut_lineage` wrote. Nothing may read it any more."""
    jvm = stored.sparkSession.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(stored.stored_at)
    path.getFileSystem(stored.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fix_layout(df: DataFrame) -> DataFrame:
    """Checkpoint `df` with its partitions and their row order as they are."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)
