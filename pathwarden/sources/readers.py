"""Readers for location files, the level reference and folders of problem files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pathwarden.model import LEVEL_REFERENCE_SCHEMA, PROCESSED_SCHEMA

# Quote and escape are the same character on both sides, so a value with quotes
# or line breaks reads back as it was written.
CSV_QUOTING = {"header": "true", "quote": '"', "escape": '"'}
CORRUPT = "_corrupt_record"


def read_locations(
    spark: SparkSession, path: str, schema: T.StructType = PROCESSED_SCHEMA, keep_corrupt: bool = False
) -> DataFrame:
    """A location CSV whose cells may span lines. Rows that do not parse keep their text if asked.

    A multi-line CSV file cannot be split, so large tables should come as many files.
    """
    reader = spark.read.options(**CSV_QUOTING).option("multiLine", True).option("mode", "PERMISSIVE")
    if keep_corrupt:
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).csv(path)


def read_csv_simple(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A CSV with a header, every column a string. Naming the columns spares a look at the file."""
    reader = spark.read.options(**CSV_QUOTING)
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.csv(path)


def read_level_reference(spark: SparkSession, path: str) -> DataFrame:
    """The JSON array of countries with their continent and official level names."""
    return spark.read.schema(LEVEL_REFERENCE_SCHEMA).option("multiLine", True).json(path)


def read_table(spark: SparkSession, name: str, columns: list[str] | None = None) -> DataFrame:
    """A catalog table or view, projected to `columns` so that the scan reads no others."""
    table = spark.table(name)
    return table.select(*columns) if columns else table


def read_problem_dir(spark: SparkSession, path: str, schema: T.StructType = PROCESSED_SCHEMA) -> DataFrame:
    """Every CSV of a folder as one table; PROBLEM is the file's name without its ending."""
    rows = spark.read.options(**CSV_QUOTING).option("multiLine", True).schema(schema)
    rows = rows.option("pathGlobFilter", "*.csv").csv(path)
    stem = F.regexp_replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), r"\.csv$", "")
    # The path is percent-encoded, but a plus sign in it is a plus sign.
    decoded = F.url_decode(F.replace(stem, F.lit("+"), F.lit("%2B")))
    return rows.select("*", decoded.alias("PROBLEM"))
