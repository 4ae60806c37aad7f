"""The repair of a small invented table, step by step and as a whole."""

from pyspark.sql import functions as F

from pathwarden.operators import hierarchy as H
from pathwarden.operators import report
from pathwarden.plans import flows

RAW = [
    (0, "ALL", "ALL", "ALL", False, None, None),
    (1, "WORLD", "WORLD", "ALL#WORLD", False, None, None),
    (2, "EUROPE", "EUR", "ALL#WORLD#EUR", False, None, "REGION"),
    (3, "north_america ", "NAM", "ALL#WORLD#NAM", False, None, "REGION"),
    (4, "south america", "SOAME", "ALL#WORLD#AME#SOAME", False, None, "REGION"),
    (5, "antarctica", "ATA", "ALL#WORLD#ATA#ATA", False, None, "COUNTRY"),
    (6, "Freedonia", "FRE", "ALL#WORLD#OLD#FRE", False, None, "COUNTRY"),
    (7, "Sylvanya", "SYL", "ALL#WORLD#SYL", False, None, "COUNTRY"),
    (8, "Nowhere at all", "NOW", "ALL#WORLD#NOW", False, None, "COUNTRY"),
    (9, None, "NUL", "ALL#WORLD#NUL", False, None, "COUNTRY"),
    (10, "North Province", "FRE_N", "ALL#WORLD#OLD#FRE#FRE_N", False, None, "REGION"),
    (11, "Fredville", "FRE_1", "ALL#WORLD#OLD#FRE#FRE_N#FRE_1", False, None, "CITY"),
    (12, "Deep port", "FREPT", "ALL#WORLD#OLD#FRE#FRE_N#FREPT", False, None, "PORT_TERMINAL"),
    (13, "Sylvan port", "SYLPT", "ALL#WORLD#SYL#SYLPT", False, None, "PORT_TERMINAL"),
    (14, "Lost city", "LOST", "ALL#WORLD#NOW#LOST", False, None, "CITY"),
    (15, "Port group", "GRP", "ALL#WORLD#OLD#FRE#GRP", True, '["FREPT"]', "REGION"),
    (16, "No path", "NOP", None, False, None, "CITY"),
]
SCHEMA = "row_id bigint, NAME string, CODE string, HIERARCHY string, IS_GROUP boolean, CHILDREN string, LEVEL_NAME string"
REFERENCE = [
    ("FRE", "Freedonia", "Europe", ["Province", "Territory"], "Town", None, 0),
    ("SY", "Sylvania", "North America", ["Oblast"], None, None, 1),
]
REFERENCE_SCHEMA = (
    "code string, country string, continent_name string, level_1 array<string>, level_2 string, level_3 string, ordinal bigint"
)


def run(spark):
    raw = spark.createDataFrame(RAW, SCHEMA).repartition(3)
    reference = spark.createDataFrame(REFERENCE, REFERENCE_SCHEMA)
    known = spark.createDataFrame([("Freedonia", "Europe")], "country string, continent string")
    return flows.process_locations(raw, reference, known)


def test_whole_repair(spark):
    done = run(spark)
    rows = {r["CODE"]: r for r in done.processed.collect()}
    short = {c: (r["HIERARCHY"], r["PARENT"], r["LEVEL_NUMBER"], r["OFFICIAL_LEVEL_NAME"]) for c, r in rows.items()}
    assert short == {
        "ALL": ("ALL", None, None, None),
        "WORLD": ("ALL#WORLD", None, None, None),
        "EUR": ("ALL#WORLD#EUR", "WORLD", -1, "CONTINENT"),
        "NAM": ("ALL#WORLD#NAM", "WORLD", -1, "CONTINENT"),
        "SOAME": ("ALL#WORLD#SOAME", "WORLD", -1, "CONTINENT"),
        "OCE": ("ALL#WORLD#OCE", "WORLD", -1, "CONTINENT"),
        "ATA": ("ALL#WORLD#ATA#ATA", "WORLD", -1, "CONTINENT"),
        "FRE": ("ALL#WORLD#EUR#FRE", "Europe", 0, "COUNTRY"),
        "SYL": ("ALL#WORLD#NAM#SYL", "North America", 0, "COUNTRY"),
        "FRE_N": ("ALL#WORLD#EUR#FRE#FRE_N", "FRE", 1, "PROVINCE"),
        "FRE_1": ("ALL#WORLD#EUR#FRE#FRE_N#FRE_1", "FRE", 2, "TOWN"),
        "FREPT": ("ALL#WORLD#EUR#FRE#FREPT", "FRE", 1, "PROVINCE"),
        "SYLPT": ("ALL#WORLD#NAM#SYL#SYLPT", "SYL", 1, "PORT_TERMINAL"),
    }
    assert rows["NAM"]["NAME"] == "North America"
    assert {r["CODE"] for r in done.countries_without_continent.collect()} == {"NOW", "NUL"}
    assert {r["CODE"] for r in done.outliers.collect()} == {"NOW", "NUL", "LOST", "GRP", "NOP"}


def test_problem_rows_of_a_run(spark):
    done = run(spark)
    merged = flows.problem_rows(done.processed, done.outliers)
    counts = {r["PROBLEM"]: r["count"] for r in merged.groupBy("PROBLEM").count().collect()}
    assert counts[report.OUTLIER] == 5
    assert set(merged.columns) >= {"PROBLEM", "COLUMN_PROBLEM", "CODE"}


def test_ratio_finds_a_country_by_a_misspelt_code(spark):
    df = spark.createDataFrame([("Sylvanie", "oblasts", 1), ("Zzz", "oblasts", 1), ("FRE", None, 2), ("FRE", "x", 4)], "PARENT string, LEVEL_NAME string, LEVEL_NUMBER int")
    reference = spark.createDataFrame(REFERENCE, REFERENCE_SCHEMA)
    got = {(r["PARENT"], r["LEVEL_NUMBER"]): r["OFFICIAL_LEVEL_NAME"] for r in H.official_level_name(df, reference).collect()}
    assert got == {("Sylvanie", 1): "OBLAST", ("Zzz", 1): "oblasts", ("FRE", 2): "TOWN", ("FRE", 4): "x"}


def test_rebase_rules(spark):
    countries = spark.createDataFrame([(1, "FR", "NEW#FR"), (2, "FRA", "NEW#FRA")], "row_id int, CODE string, HIERARCHY string")
    df = spark.createDataFrame(
        [("a", "X#FR#FRA", "FR", "CITY"), ("b", None, "FR", None), ("c", "X#Y", "FR", "CITY"), ("d", "X#FR", "FR", "Country"), ("e", "X#FRA#Z", "FRA", "CITY")],
        "CODE string, HIERARCHY string, PARENT string, LEVEL_NAME string",
    )
    got = {r["CODE"]: r["HIERARCHY"] for r in H.rebase_path(df, countries, F.col("row_id")).collect()}
    assert got == {"a": "NEW#FR#FRA", "b": "NEW#FR", "c": "X#Y", "d": "X#FR", "e": "NEW#FRA#Z"}


def test_correction_pairs(spark):
    rows = [(0, "A", "True"), (1, "B", "False"), (2, "C", "no"), (3, "D", " true "), (4, "E", "False"), (5, "F", None), (6, "G", "True"), (7, "H", "True")]
    df = spark.createDataFrame(rows, "n int, CODE string, Valid string").repartition(3)
    got = {(r["Old"], r["Corrected"]) for r in report.correction_pairs(df, ["n"]).collect()}
    assert got == {("B", "A"), ("C", "D"), ("H", "G")}
