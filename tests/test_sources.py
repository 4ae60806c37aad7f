"""Readers and writers: what is written reads back as it was."""

import datetime
import json
import threading

from pyspark.sql import functions as F

from pathwarden.model import HISTORY_SCHEMA, PROCESSED_SCHEMA, RAW_SCHEMA
from pathwarden.sources import readers, writers

ROWS = [
    ("Le Havre", "FR1", "ALL#WORLD#EUR#FRA#FR1", False, "[]", "CITY", "FRA", 2, "CITY"),
    ('Quote " and, comma', "FR2", "ALL#X", True, '[\n"PRI",\n"VIR"]', None, None, None, None),
    ("back\\slash", "FR3", None, None, '["a\\"b"]', "", "FRA", -1, "x"),
]


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame(ROWS, PROCESSED_SCHEMA)
    writers.write_csv(df, f"{tmp_path}/out")
    back = readers.read_locations(spark, f"{tmp_path}/out").collect()
    expected = [tuple(None if v == "" else v for v in row) for row in ROWS]
    # An empty text reads back as null unless it was quoted as one.
    assert sorted((tuple(None if v == "" else v for v in r) for r in back), key=repr) == sorted(expected, key=repr)


def test_corrupt_rows_are_kept(spark, tmp_path):
    (tmp_path / "in.csv").write_text("NAME,CODE,HIERARCHY,IS_GROUP,CHILDREN,LEVEL_NAME\na,b,c,maybe,e,f\n")
    row = readers.read_locations(spark, str(tmp_path / "in.csv"), RAW_SCHEMA, keep_corrupt=True).first()
    assert row["IS_GROUP"] is None and "maybe" in row["_corrupt_record"]


def test_simple_csv_is_all_text(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a,b\n1,true\n")
    df = readers.read_csv_simple(spark, str(tmp_path / "in.csv"))
    assert df.dtypes == [("a", "string"), ("b", "string")]


def test_level_reference(spark, tmp_path):
    entries = [{"code": "FRA", "country": "France", "continent_name": "Europe", "level_1": ["Region"], "level_2": "Dept", "level_3": None}]
    (tmp_path / "ref.json").write_text(json.dumps(entries, indent=1))
    assert [r.asDict() for r in readers.read_level_reference(spark, str(tmp_path / "ref.json")).collect()] == entries


def test_problem_folder(spark, tmp_path):
    header = ",".join(f.name for f in PROCESSED_SCHEMA.fields)
    for stem in ("Null values in NAME", "Orphan hierarchy (parent missing)", "50% + more"):
        (tmp_path / f"{stem}.csv").write_text(f'{header}\nx,C1,ALL,false,"[\n""P""]",CITY,,1,CITY\n')
    (tmp_path / "notes.txt").write_text("no table")
    got = readers.read_problem_dir(spark, str(tmp_path)).collect()
    assert {r["PROBLEM"] for r in got} == {"Null values in NAME", "Orphan hierarchy (parent missing)", "50% + more"}
    assert {r["CHILDREN"] for r in got} == {'[\n"P"]'}


def test_problems_replace_earlier_ones(spark, tmp_path):
    df = spark.createDataFrame(ROWS, PROCESSED_SCHEMA)
    for problem in ("first (a)", "second: b"):
        writers.write_problems(df.withColumn("PROBLEM", F.lit(problem)), f"{tmp_path}/out")
    back = spark.read.options(**readers.CSV_QUOTING).option("multiLine", True).csv(f"{tmp_path}/out")
    assert {r["PROBLEM"] for r in back.collect()} == {"second: b"} and back.count() == 3


def test_history_is_appended_once_per_minute(spark, tmp_path):
    path = f"{tmp_path}/history"
    at = datetime.datetime(2025, 5, 20, 10, 59, 30)
    scores = spark.createDataFrame([(at, 80.0)], HISTORY_SCHEMA)
    writers.append_history_if_absent(spark, scores, path)
    writers.append_history_if_absent(spark, scores, path)
    later = spark.createDataFrame([(at, 81.0), (at + datetime.timedelta(minutes=1), 82.0)], HISTORY_SCHEMA)
    writers.append_history_if_absent(spark, later, path)
    assert [r["total_score"] for r in spark.read.parquet(path).orderBy("date").collect()] == [80.0, 82.0]


def test_racing_writers_leave_one_row(spark, tmp_path, monkeypatch):
    """Both find the minute absent before either writes."""
    path = f"{tmp_path}/history"
    at = datetime.datetime(2025, 5, 20, 10, 59, 30)
    writers.append_history_if_absent(spark, spark.createDataFrame([(at - datetime.timedelta(hours=1), 70.0)], HISTORY_SCHEMA), path)
    both, store, failed = threading.Barrier(2, timeout=120), writers.cut_lineage, []

    def stored_by_both(rows):
        result = store(rows)
        both.wait()
        return result

    def write(score):
        try:
            writers.append_history_if_absent(spark, spark.createDataFrame([(at, score)], HISTORY_SCHEMA), path)
        except Exception as problem:
            failed.append(problem)

    monkeypatch.setattr(writers, "cut_lineage", stored_by_both)
    threads = [threading.Thread(target=write, args=(score,)) for score in (80.0, 81.0)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert not failed
    rows = [r["total_score"] for r in writers.read_history(spark, path).orderBy("date").collect()]
    runs = sorted((r["run"], r["total_score"]) for r in writers._history_rows(spark, path).where(F.col("total_score") >= 80).collect())
    assert rows == [70.0, runs[0][1]] and len(runs) == 2
    monkeypatch.undo()
    writers.append_history_if_absent(spark, spark.createDataFrame([(at, 99.0)], HISTORY_SCHEMA), path)
    assert writers.read_history(spark, path).count() == 2


def test_history_without_new_rows(spark, tmp_path):
    path = f"{tmp_path}/history"
    writers.append_history_if_absent(spark, spark.createDataFrame([], HISTORY_SCHEMA), path)
    assert writers.read_history(spark, path).count() == 0
