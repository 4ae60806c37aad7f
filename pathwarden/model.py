"""Schemas, column lists and the fixed vocabulary of the location table."""

from pyspark.sql import types as T

RAW_COLUMNS = ["NAME", "CODE", "HIERARCHY", "IS_GROUP", "CHILDREN", "LEVEL_NAME"]
PROCESSED_COLUMNS = RAW_COLUMNS + ["PARENT", "LEVEL_NUMBER", "OFFICIAL_LEVEL_NAME"]

RAW_SCHEMA = T.StructType(
    [
        T.StructField("NAME", T.StringType()),
        T.StructField("CODE", T.StringType()),
        T.StructField("HIERARCHY", T.StringType()),
        T.StructField("IS_GROUP", T.BooleanType()),
        T.StructField("CHILDREN", T.StringType()),
        T.StructField("LEVEL_NAME", T.StringType()),
    ]
)
PROCESSED_SCHEMA = T.StructType(
    RAW_SCHEMA.fields
    + [
        T.StructField("PARENT", T.StringType()),
        T.StructField("LEVEL_NUMBER", T.IntegerType()),
        T.StructField("OFFICIAL_LEVEL_NAME", T.StringType()),
    ]
)
LEVEL_REFERENCE_SCHEMA = T.StructType(
    [
        T.StructField("code", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("continent_name", T.StringType()),
        T.StructField("level_1", T.ArrayType(T.StringType())),
        T.StructField("level_2", T.StringType()),
        T.StructField("level_3", T.StringType()),
    ]
)
HISTORY_SCHEMA = T.StructType(
    [T.StructField("date", T.TimestampType()), T.StructField("total_score", T.DoubleType())]
)

# They decide results and must stay as they are.
SEPARATOR = "#"
ROOT_CODES = ["ALL", "WORLD"]
KEPT_LEVELS = ["COUNTRY", "CITY", "PORT_TERMINAL"]
CONTINENTS = ["Africa", "Antarctica", "Asia", "Europe", "North America", "Oceania", "South America"]
ATTRIBUTE_ORDER = [
    "NAME",
    "CODE",
    "HIERARCHY",
    "IS_GROUP",
    "CHILDREN",
    "LEVEL_NAME",
    "PARENT",
    "LEVEL_NUMBER",
    "OFFICIAL_LEVEL_NAME",
]
