"""Sources, projections, filters, metrics, checks and violating rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pathwarden.functions import text as X
from pathwarden.functions.paths import parent_path
from pathwarden.model import ATTRIBUTE_ORDER, PROCESSED_COLUMNS, PROCESSED_SCHEMA
from pathwarden.operators import analyzers as A
from pathwarden.operators import checks as C
from pathwarden.operators import report, rows
from pathwarden.operators import rules as R
from pathwarden.operators import violations as V
from pathwarden.plans.registry import query
from pathwarden.session import checkpoint_folder, cut_lineage
from pathwarden.sources import readers, writers
from pathwarden.sources.location_view import level_reference, location_view, raw_view, table

NINE = ", ".join(PROCESSED_COLUMNS)


def scratch(spark, name):
    """A new folder next to the checkpoints, on storage all executors share."""
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored_view(spark, d):
    """The location table written once, for runs that read it several times."""
    return cut_lineage(location_view(spark, d))


# Sources and sinks


@query("s1_read_locations", f"SELECT {NINE} FROM loc")
def s1(spark, d):
    path = scratch(spark, "locations")
    writers.write_csv(location_view(spark, d).select(*PROCESSED_COLUMNS), path)
    return readers.read_locations(spark, path)


@query("s2_read_csv_simple", "SELECT CAST(row_id AS VARCHAR) AS row_id, NAME, CODE, CAST(LEVEL_NUMBER AS VARCHAR) AS LEVEL_NUMBER FROM loc")
def s2(spark, d):
    path = scratch(spark, "simple")
    columns = ["row_id", "NAME", "CODE", "LEVEL_NUMBER"]
    writers.write_csv(location_view(spark, d).select(*columns), path)
    return readers.read_csv_simple(spark, path, columns)


@query("s4_read_table", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer", loc=False)
def s4(spark, d):
    table(spark, d, "customer").createOrReplaceTempView("pathwarden_customer")
    return readers.read_table(spark, "pathwarden_customer", ["c_custkey", "c_nationkey", "c_mktsegment"])


@query("s6_write_csv", "SELECT doc_id, text, lang, source FROM documents", loc=False)
def s6(spark, d):
    path = scratch(spark, "documents")
    documents = table(spark, d, "documents").select("doc_id", "text", "lang", "source")
    writers.write_csv(documents, path)
    return readers.read_locations(spark, path, documents.schema)


@query(
    "s7_write_problems",
    """
    SELECT 'null PARENT' AS PROBLEM, CODE, NAME FROM loc WHERE PARENT IS NULL
    UNION ALL SELECT 'bad pattern', CODE, NAME FROM loc WHERE NOT regexp_matches(HIERARCHY, '^ALL#.*#.*')
    """,
)
def s7(spark, d):
    path = scratch(spark, "problems")
    tagged = V.tag_rows(location_view(spark, d), {"null PARENT": V.null_in("PARENT"), "bad pattern": V.bad_pattern()})
    writers.write_problems(tagged.select(*PROCESSED_COLUMNS, "PROBLEM"), path)
    return readers.read_locations(spark, path, PROCESSED_SCHEMA).select("PROBLEM", "CODE", "NAME")


@query(
    "s3_read_level_reference",
    """
    SELECT 'N' || n_nationkey AS code, n_name AS country, r_name AS continent_name, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS level_1, 'CITY' AS level_2
    FROM nation JOIN region ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL
    """,
    loc=False,
)
def s3(spark, d):
    """The level reference written as a JSON array and read back."""
    path = scratch(spark, "reference")
    entry = F.to_json(F.collect_list(F.struct("code", "country", "continent_name", "level_1", "level_2", "level_3")))
    level_reference(spark, d).where("level_1 is not null").agg(entry.alias("value")).write.text(path)
    return readers.read_level_reference(spark, path).withColumn("level_1", F.array_join("level_1", ",")).drop("level_3")


@query(
    "s5_read_problem_dir",
    """
    SELECT CASE LEVEL_NAME WHEN 'CITY' THEN 'cities, 50% + more' ELSE 'other levels (all)' END AS PROBLEM, CODE, NAME, LEVEL_NUMBER
    FROM loc WHERE PARENT IS NULL
    """,
)
def s5(spark, d):
    """Problem files of a folder, named by their problem, and read as one table."""
    folder = scratch(spark, "problem-files")
    names = {"cities, 50% + more": F.col("LEVEL_NAME") == "CITY", "other levels (all)": ~F.col("LEVEL_NAME").eqNullSafe("CITY")}
    for name, chosen in names.items():
        rows = V.null_rows(location_view(spark, d), "PARENT").where(chosen)
        writers.write_csv(rows.select(*PROCESSED_COLUMNS).coalesce(1), f"{folder}/parts/{name}")
        writers.as_file(spark, f"{folder}/parts/{name}", f"{folder}/files/{name}.csv")
    return readers.read_problem_dir(spark, f"{folder}/files").select("PROBLEM", "CODE", "NAME", "LEVEL_NUMBER")


@query(
    "s8_append_history_if_absent",
    """
    WITH minutes AS (SELECT date_trunc('minute', ts) AS m, value, event_type = 'view' AS old FROM events),
    first AS (SELECT m, max(value) AS total_score FROM minutes WHERE old GROUP BY m),
    second AS (SELECT m, max(value) AS total_score FROM minutes WHERE m NOT IN (SELECT m FROM first) GROUP BY m)
    SELECT strftime(m, '%Y-%m-%d %H:%M:00') AS date, total_score FROM (SELECT * FROM first UNION ALL SELECT * FROM second)
    """,
    loc=False,
)
def s8(spark, d):
    """The views' scores go to a new history, then all scores; minutes that are there stay as they are."""
    path = scratch(spark, "history")
    scores = table(spark, d, "events").select(F.col("ts").alias("date"), F.col("value").alias("total_score"), "event_type")
    writers.append_history_if_absent(spark, scores.where(F.col("event_type") == "view"), path)
    writers.append_history_if_absent(spark, scores, path)
    history = writers.read_history(spark, path)
    return history.select(F.date_format("date", "yyyy-MM-dd HH:mm:00").alias("date"), "total_score")


# Projections, filters and predicates


@query("p1_select_columns", f"SELECT {NINE} FROM loc")
def p1(spark, d):
    return location_view(spark, d).select(*PROCESSED_COLUMNS)


@query("p2_drop_roots", "SELECT row_id, CODE FROM loc WHERE CODE NOT IN ('ALL', 'WORLD')")
def p2(spark, d):
    return rows.drop_roots(location_view(spark, d)).select("row_id", "CODE")


@query("p3_drop_groups", "SELECT row_id, CODE FROM loc WHERE IS_GROUP = false")
def p3(spark, d):
    return rows.drop_groups(location_view(spark, d)).select("row_id", "CODE")


@query(
    "p4_bucket_level_name",
    "SELECT row_id, CASE WHEN LEVEL_NAME IN ('COUNTRY', 'CITY', 'PORT_TERMINAL') THEN LEVEL_NAME ELSE 'REGION' END AS LEVEL_NAME FROM loc",
)
def p4(spark, d):
    return location_view(spark, d).select("row_id", X.bucket_level_name(F.col("LEVEL_NAME")).alias("LEVEL_NAME"))


@query(
    "p5_continent_candidates",
    """
    SELECT row_id, NAME, CODE FROM raw WHERE HIERARCHY LIKE 'ALL#WORLD%' AND LEVEL_NAME = 'REGION'
    AND length(HIERARCHY) - length(replace(HIERARCHY, '#', '')) = 2
    """,
)
def p5(spark, d):
    return rows.continent_candidates(raw_view(spark, d)).select("row_id", "NAME", "CODE")


@query("p6_filter_by_level", "SELECT row_id, CODE FROM loc WHERE LEVEL_NAME = 'PORT_TERMINAL'")
def p6(spark, d):
    return rows.filter_by_level(location_view(spark, d), "PORT_TERMINAL").select("row_id", "CODE")


@query("p7_outside_root", "SELECT row_id, HIERARCHY FROM loc WHERE HIERARCHY IS NULL OR NOT starts_with(HIERARCHY, 'ALL')")
def p7(spark, d):
    return rows.outside_root(location_view(spark, d)).select("row_id", "HIERARCHY")


@query("p8_tag_constant", "SELECT row_id, 'orphan' AS PROBLEM, 0 AS LEVEL_NUMBER, 'WORLD' AS PARENT FROM loc")
def p8(spark, d):
    tagged = rows.tag_constant(location_view(spark, d), PROBLEM="orphan", LEVEL_NUMBER=0, PARENT="WORLD")
    return tagged.select("row_id", "PROBLEM", "LEVEL_NUMBER", "PARENT")


@query(
    "p9_compose_text",
    """
    SELECT row_id, NAME || ' ' || coalesce(HIERARCHY, 'nan') || ' ' || coalesce(LEVEL_NAME, 'nan') AS short_text,
           NAME || ' - ' || coalesce(OFFICIAL_LEVEL_NAME, 'nan') || ' - ' || coalesce(PARENT, 'nan') || ' - '
           || coalesce(CAST(LEVEL_NUMBER AS VARCHAR), 'nan') AS long_text FROM loc
    """,
)
def p9(spark, d):
    short = [F.col(c) for c in ("NAME", "HIERARCHY", "LEVEL_NAME")]
    long = [F.col(c) for c in ("NAME", "OFFICIAL_LEVEL_NAME", "PARENT", "LEVEL_NUMBER")]
    return location_view(spark, d).select(
        "row_id", X.compose_text(short).alias("short_text"), X.compose_text(long, " - ").alias("long_text")
    )


@query(
    "p10_normalize_bool_text",
    """
    SELECT doc_id, coalesce(quality = 1 AND toxic = 0, false) AS valid
    FROM documents LEFT JOIN labels USING (doc_id)
    """,
    loc=False,
)
def p10(spark, d):
    quality = table(spark, d, "labels").withColumn(
        "Valid",
        F.when((F.col("quality") == 1) & (F.col("toxic") == 0), " TRUE ")
        .when(F.col("quality") == 1, "True --- ask about this")
        .otherwise("false"),
    )
    joined = table(spark, d, "documents").join(quality, "doc_id", "left")
    return joined.select("doc_id", X.normalize_bool_text(F.col("Valid")).alias("valid"))


@query(
    "p11_code_suffix_valid",
    """
    SELECT row_id, coalesce(
        CASE WHEN path IS NULL OR code IS NULL THEN false
             WHEN starts_with(code, last) THEN regexp_matches(substr(code, length(last) + 1), '^[0-9]+$')
             WHEN starts_with(code, last[1:2]) THEN regexp_matches(substr(code, 3), '^[0-9]+$')
             ELSE false END, false) AS valid
    FROM (SELECT row_id, path, code, string_split(path, '#')[-1] AS last FROM (
        SELECT row_id, regexp_replace(HIERARCHY, '#[^#]+$', '') AS path, PARENT || row_id AS code FROM loc))
    """,
)
def p11(spark, d):
    path = parent_path(F.col("HIERARCHY"))
    code = F.concat(F.col("PARENT"), F.col("row_id").cast("string"))
    return location_view(spark, d).select("row_id", X.code_suffix_valid(path, code).alias("valid"))


_ATTRIBUTES_SQL = "[" + ", ".join(f"'{a}'" for a in ATTRIBUTE_ORDER) + "]"


def _attribute_sql(text, flag):
    return " ".join(f"WHEN regexp_matches({text}, '{flag}\\b{a}\\b') THEN '{a}'" for a in ATTRIBUTE_ORDER)


@query(
    "p12_attribute_column",
    f"""
    SELECT row_id, CASE {_attribute_sql('t', '')} END AS exact_column,
           CASE WHEN starts_with(t, 'UniquenessConstraint') THEN 'NAME' {_attribute_sql('t', '(?i)')} END AS problem_column
    FROM (SELECT row_id, CASE WHEN LEVEL_NAME = 'REGION' THEN 'UniquenessConstraint - ' ELSE 'check of ' END
          || CASE WHEN IS_GROUP OR LEVEL_NAME = 'PORT_TERMINAL' THEN lower({_ATTRIBUTES_SQL}[row_id % 9 + 1])
                  ELSE {_ATTRIBUTES_SQL}[row_id % 9 + 1] END
          || CASE WHEN LEVEL_NAME = 'COUNTRY' THEN ' and HIERARCHY' ELSE '' END AS t FROM loc)
    """,
)
def p12(spark, d):
    attribute = F.element_at(F.array(*[F.lit(a) for a in ATTRIBUTE_ORDER]), (F.col("row_id") % 9 + 1).cast("int"))
    level = F.coalesce("LEVEL_NAME", F.lit(""))
    text = F.concat(
        F.when(level == "REGION", "UniquenessConstraint - ").otherwise("check of "),
        F.when(F.col("IS_GROUP") | (level == "PORT_TERMINAL"), F.lower(attribute)).otherwise(attribute),
        F.when(level == "COUNTRY", " and HIERARCHY").otherwise(""),
    )
    return location_view(spark, d).select(
        "row_id",
        X.attribute_column(text).alias("exact_column"),
        X.attribute_column(text, ignore_case=True).alias("problem_column"),
    )


@query("p13_sample_limit", "SELECT row_id, CODE FROM loc ORDER BY row_id LIMIT 1500")
def p13(spark, d):
    return rows.first_rows(location_view(spark, d), 1500, ["row_id"]).select("row_id", "CODE")


@query("p14_rename_drop_column", "SELECT row_id, CODE, PARENT AS CONTINENT FROM loc")
def p14(spark, d):
    view = location_view(spark, d).select("row_id", "CODE", "PARENT", "CHILDREN")
    return view.withColumnRenamed("PARENT", "CONTINENT").drop("CHILDREN")


# Metrics

_SHARE = "avg(CASE WHEN {} THEN 1.0 ELSE 0.0 END)"


def _completeness_sql(column):
    return f"(SELECT {_SHARE.format(column + ' IS NOT NULL')} FROM loc)"


def _distinctness_sql(column):
    return f"(SELECT count(*) / sum(n) FROM (SELECT count(*) AS n FROM loc WHERE {column} IS NOT NULL GROUP BY {column}))"


def _uniqueness_sql(column):
    return (
        f"(SELECT count(*) FILTER (n = 1) / sum(n) FROM"
        f" (SELECT count(*) AS n FROM loc WHERE {column} IS NOT NULL GROUP BY {column}))"
    )


def _pattern_sql(pattern):
    return f"(SELECT {_SHARE.format(f'''coalesce(regexp_extract(HIERARCHY, '{pattern}') <> '', false)''')} FROM loc)"


def _datatype_sql(column, kinds, source="loc"):
    t = f"CAST({column} AS VARCHAR)"
    kind = (
        f"CASE WHEN regexp_full_match({t}, '(-|\\+)? ?\\d*\\.\\d*') THEN 'Fractional'"
        f" WHEN regexp_full_match({t}, '(-|\\+)? ?\\d*') THEN 'Integral'"
        f" WHEN {t} IN ('true', 'false') THEN 'Boolean' ELSE 'String' END"
    )
    wanted = ", ".join(f"'{k}'" for k in kinds)
    return f"(SELECT count(*) FILTER ({column} IS NOT NULL AND {kind} IN ({wanted})) / nullif(count({column}), 0) FROM {source})"


def _compliance_sql(predicate):
    return f"(SELECT {_SHARE.format(f'coalesce({predicate}, false)')} FROM loc)"


@query(
    "a1_completeness",
    "SELECT "
    + ", ".join(f"round({_completeness_sql(c)}, 9) AS {c}" for c in PROCESSED_COLUMNS),
)
def a1(spark, d):
    return location_view(spark, d).agg(
        *[F.round(A.completeness(F.col(c)), 9).alias(c) for c in PROCESSED_COLUMNS]
    )


@query(
    "a2_distinctness",
    f"""
    SELECT round({_distinctness_sql('NAME')}, 9) AS by_name,
           round((SELECT count(*) / sum(n) FROM (SELECT count(*) AS n FROM loc
                  WHERE PARENT IS NOT NULL OR LEVEL_NAME IS NOT NULL GROUP BY PARENT, LEVEL_NAME)), 9) AS by_two
    """,
)
def a2(spark, d):
    view = location_view(spark, d)
    two = A.key_counts(view, ["PARENT", "LEVEL_NAME"]).agg(A.distinctness().alias("x"))
    one = A.key_counts(view, ["NAME"]).agg(F.round(A.distinctness(), 9).alias("by_name"))
    return one.withColumn("by_two", F.round(two.scalar(), 9))


@query(
    "a3_uniqueness",
    f"SELECT round({_uniqueness_sql('CODE')}, 9) AS code, round({_uniqueness_sql('NAME')}, 9) AS name",
)
def a3(spark, d):
    view = location_view(spark, d)
    name = A.key_counts(view, ["NAME"]).agg(A.uniqueness().alias("x"))
    code = A.key_counts(view, ["CODE"]).agg(F.round(A.uniqueness(), 9).alias("code"))
    return code.withColumn("name", F.round(name.scalar(), 9))


@query(
    "a4_approx_count_distinct",
    "SELECT count(DISTINCT l_orderkey) AS orders, true AS orders_close, count(DISTINCT l_partkey) AS parts, true AS parts_close FROM lineitem",
    loc=False,
)
def a4(spark, d):
    """The exact counts, and whether the estimates are within 15 % of them."""
    columns = {"orders": F.col("l_orderkey"), "parts": F.col("l_partkey")}
    counted = table(spark, d, "lineitem").agg(
        *[F.count_distinct(c).alias(n) for n, c in columns.items()],
        *[A.approx_count_distinct(c).alias(f"{n}_guess") for n, c in columns.items()],
    )
    close = lambda n: (F.abs(F.col(f"{n}_guess") / F.col(n) - 1) <= 0.15).alias(f"{n}_close")
    return counted.select("orders", close("orders"), "parts", close("parts"))


@query(
    "a5_pattern_match",
    f"SELECT round({_pattern_sql('ALL#.*#.*')}, 9) AS loose, round({_pattern_sql('^ALL#WORLD#([A-Z]+#)*[A-Z]+$')}, 9) AS strict",
)
def a5(spark, d):
    path = F.col("HIERARCHY")
    return location_view(spark, d).agg(
        F.round(A.pattern_match(path, "ALL#.*#.*"), 9).alias("loose"),
        F.round(A.pattern_match(path, "^ALL#WORLD#([A-Z]+#)*[A-Z]+$"), 9).alias("strict"),
    )


@query(
    "a6_datatype_ratio",
    f"""
    SELECT round({_datatype_sql('event_id', ['Fractional', 'Integral'], 'events')}, 9) AS id_numeric,
           round({_datatype_sql('event_type', ['String'], 'events')}, 9) AS type_string,
           round({_datatype_sql('props', ['Boolean'], 'events')}, 9) AS props_boolean
    """,
    loc=False,
)
def a6(spark, d):
    return table(spark, d, "events").agg(
        F.round(A.datatype_ratio(F.col("event_id"), "Numeric"), 9).alias("id_numeric"),
        F.round(A.datatype_ratio(F.col("event_type"), "String"), 9).alias("type_string"),
        F.round(A.datatype_ratio(F.col("props"), "Boolean"), 9).alias("props_boolean"),
    )


@query(
    "a7_compliance",
    """
    SELECT round(avg(CASE WHEN l_discount <= 0.05 AND l_quantity < 40 THEN 1.0 ELSE 0.0 END), 9) AS share FROM lineitem
    """,
    loc=False,
)
def a7(spark, d):
    predicate = "l_discount <= 0.05 AND l_quantity < 40"
    return table(spark, d, "lineitem").agg(F.round(A.compliance(predicate), 9).alias("share"))


@query(
    "a8_metrics_table",
    f"""
    SELECT 'Column' AS entity, 'NAME' AS instance, 'Completeness' AS name, round({_completeness_sql('NAME')}, 9) AS value
    UNION ALL SELECT 'Column', 'LEVEL_NAME', 'Completeness', round({_completeness_sql('LEVEL_NAME')}, 9)
    UNION ALL SELECT 'Column', 'NAME', 'Distinctness', round({_distinctness_sql('NAME')}, 9)
    UNION ALL SELECT 'Column', 'HIERARCHY', 'Completeness', round({_completeness_sql('HIERARCHY')}, 9)
    UNION ALL SELECT 'Column', 'HIERARCHY', 'PatternMatch', round({_pattern_sql('^ALL#WORLD#.*')}, 9)
    """,
)
def a8(spark, d):
    exact = [m for m in A.profile_metrics() if m.name != "ApproxCountDistinct"]
    return A.metrics_table(location_view(spark, d), exact).withColumn("value", F.round("value", 9))


@query("a8_metrics_table_full")
def a8_full(spark, d):
    return A.metrics_table(raw_view(spark, d), A.profile_metrics())


@query("a9_group_count_having", "SELECT CODE, count(*) AS count FROM loc GROUP BY CODE HAVING count(*) > 1")
def a9(spark, d):
    return A.group_count_having(location_view(spark, d), ["CODE"])


@query(
    "a11_row_counts",
    """
    , a AS (SELECT CODE FROM loc WHERE LEVEL_NAME = 'CITY'), b AS (SELECT CODE FROM loc WHERE PARENT = 'N3')
    SELECT 'common' AS side, count(*) AS n FROM a JOIN b USING (CODE)
    UNION ALL SELECT 'a_only', count(*) FROM a WHERE CODE NOT IN (SELECT CODE FROM b)
    UNION ALL SELECT 'b_only', count(*) FROM b WHERE CODE NOT IN (SELECT CODE FROM a)
    """,
)
def a11(spark, d):
    view = location_view(spark, d).select("CODE", "LEVEL_NAME", "PARENT")
    parts = report.compare_detections(view.where("LEVEL_NAME = 'CITY'"), view.where("PARENT = 'N3'"))
    return report.side_counts(parts)


@query("a12_distinct_values", "SELECT DISTINCT LEVEL_NAME FROM loc WHERE LEVEL_NAME IS NOT NULL")
def a12(spark, d):
    return rows.distinct_values(location_view(spark, d), ["LEVEL_NAME"])


# Checks

_SEGMENTS = "coalesce(len(string_split(HIERARCHY, '#')), -1)"
_PLACE = "CASE WHEN HIERARCHY IS NOT NULL AND PARENT IS NOT NULL THEN coalesce(list_position(string_split(HIERARCHY, '#'), PARENT), 0) END"
_AFTER = f"greatest(len(string_split(HIERARCHY, '#')) - {_PLACE}, 0)"
_ORPHAN_SQL = """
    LEVEL_NUMBER >= 0 AND NOT EXISTS (SELECT 1 FROM loc AS p WHERE p.HIERARCHY = regexp_replace(l.HIERARCHY, '#[^#]+$', ''))
"""
_RULE_SQL = {
    R.COUNTRY_DEPTH: f"((LEVEL_NAME <> 'COUNTRY') OR ({_SEGMENTS} = 4))",
    R.LEVEL_MATCHES: f"(({_PLACE}) IS NULL OR (len(string_split(HIERARCHY, '#')) - ({_PLACE}) = LEVEL_NUMBER) AND (LEVEL_NAME <> 'CONTINENT'))",
    R.UNDER_WORLD: f"(NOT (HIERARCHY LIKE 'ALL#WORLD#%' AND {_SEGMENTS} = 3) OR LEVEL_NAME = 'CONTINENT')",
    R.GROUP_HAS_CHILDREN: "(NOT (IS_GROUP = true AND CHILDREN IS NULL))",
    R.CHILDREN_PRESENT: "(NOT (CHILDREN IS NULL))",
}


def _rule_sql(rule):
    if rule == R.MISSING_PARENT:
        return f"(SELECT 1 - (SELECT count(*) FROM loc AS l WHERE {_ORPHAN_SQL}) / count(*) FROM loc)"
    return _compliance_sql(_RULE_SQL[rule])


def _constraint_sql(c):
    """The SQL of a constraint's value, from its kind, column and rule."""
    if c.kind == "DataType":
        kinds = {"IS_GROUP": ["Boolean"], "LEVEL_NUMBER": ["Fractional", "Integral"]}.get(c.column, ["String"])
        return _datatype_sql(c.column, kinds)
    if c.kind == "PatternMatch":
        return _pattern_sql(c.text.split(", ", 1)[1][:-1])
    makers = {"Completeness": _completeness_sql, "Uniqueness": _uniqueness_sql, "Distinctness": _distinctness_sql}
    return makers[c.kind](c.column) if c.kind in makers else _rule_sql(c.name)


# Thresholds by severity of the distinctness rule; every other rule asks for 1.
_DISTINCTNESS = {"Data Quality Checks Errors": 0.9, "Data Quality Checks Warning": 0.96, "Data Quality Checks": 0.85}


def _suite_sql(checks):
    """(position, chk, lvl, txt, kind, col, rule, value, passed) of every constraint."""
    rows_sql = []
    listed = [(check, c) for check in checks for c in check.constraints]
    for i, (check, c) in enumerate(listed):
        least = 1.0
        if c.kind == "Distinctness":
            least = _DISTINCTNESS[check.description]
        elif c.kind == "PatternMatch" and check.description == "Data Quality Checks":
            least = 0.95
        text = c.text.replace("'", "''")
        rule = c.name.replace("'", "''")
        rows_sql.append(
            f"SELECT {i} AS position, '{check.description}' AS chk, '{check.level}' AS lvl, '{text}' AS txt,"
            f" '{c.kind}' AS kind, '{c.column}' AS col, '{rule}' AS rule, {_constraint_sql(c)} AS value, {least} AS least"
        )
    return f", suite AS (SELECT *, value >= least AS passed FROM ({' UNION ALL '.join(rows_sql)}))"


_SHORT = """
SELECT position, CASE WHEN passed THEN 'Success' ELSE 'Failure' END AS constraint_status, round(value, 9) AS value FROM suite
"""


def _short(results):
    return results.select("position", "constraint_status", F.round("value", 9).alias("value"))


def _register_check(name, checks):
    """A query that runs some checks, and its SQL."""

    @query(name, _suite_sql(checks) + _SHORT)
    def run(spark, d):
        # A whole suite reads the table several times.
        view = stored_view(spark, d) if len(checks[0].constraints) > 10 else location_view(spark, d)
        return _short(C.run_suite(view, checks))


_EXACT = [C.error_check(approximate=False), C.warning_check(approximate=False)]


def _only(kind=None, rule=None):
    chosen = [c for c in _EXACT[0].constraints if (kind is None or c.kind == kind) and (rule is None or c.name == rule)]
    return C.Check("Error", "Data Quality Checks Errors", chosen)


_register_check("c1_has_data_type", [_only("DataType")])
_register_check("c2_is_complete", [_only("Completeness")])
_register_check("c3_is_unique", [_only("Uniqueness")])
_register_check("c4_has_distinctness", [_only("Distinctness"), C.warning_check(False), C.legacy_check(False)])
_register_check("c6_has_pattern", [_only("PatternMatch"), C.legacy_check(False)])
_register_check("c7_country_depth", [_only("Compliance", R.COUNTRY_DEPTH)])
_register_check("c8_level_matches_path", [_only("Compliance", R.LEVEL_MATCHES)])
_register_check("c9_missing_parent", [_only("Compliance", R.MISSING_PARENT)])
_register_check("c10_under_world", [_only("Compliance", R.UNDER_WORLD)])
_register_check("c11_group_has_children", [_only("Compliance", R.GROUP_HAS_CHILDREN)])
_register_check("c12_children_present", [_only("Compliance", R.CHILDREN_PRESENT)])
_register_check("c13_run_suite", _EXACT)


@query(
    "c5_has_approx_count_distinct",
    """
    SELECT i AS position, CASE WHEN i = 0 THEN 'Success' ELSE 'Failure' END AS constraint_status FROM (SELECT unnest([0, 1]) AS i)
    """,
    loc=False,
)
def c5(spark, d):
    """Two constraints, one that any estimate within 15 % meets and one that none meets."""
    view = location_view(spark, d)
    exact = view.agg(F.count_distinct("NAME")).scalar()
    check = C.Check("Error", "distinct").has_approx_count_distinct("NAME", lambda x: F.abs(x / exact - 1) <= 0.15)
    check = check.has_approx_count_distinct("NAME", lambda x: x > 2 * exact)
    return C.run_suite(view, [check]).select("position", "constraint_status")


@query("c13_run_suite_full")
def c13_full(spark, d):
    return C.results_table(C.run_suite(stored_view(spark, d), [C.error_check(), C.warning_check(), C.legacy_check()]))


@query(
    "c14_results_table",
    _suite_sql(_EXACT)
    + """
    SELECT chk AS "check", lvl AS check_level,
           CASE WHEN bool_and(passed) OVER (PARTITION BY chk) THEN 'Success' ELSE lvl END AS check_status,
           txt AS "constraint", CASE WHEN passed THEN 'Success' ELSE 'Failure' END AS constraint_status,
           CASE WHEN passed THEN '' ELSE 'Value: ' || CAST(CAST(value AS DOUBLE) AS VARCHAR)
                || ' does not meet the constraint requirement!' END AS constraint_message
    FROM suite
    """,
)
def c14(spark, d):
    return C.results_table(C.run_suite(stored_view(spark, d), _EXACT))


@query("p15_failed_constraints", _suite_sql(_EXACT) + "SELECT txt AS \"constraint\" FROM suite WHERE NOT passed")
def p15(spark, d):
    return C.failed_constraints(C.run_suite(stored_view(spark, d), _EXACT))


@query("a10_quality_score", _suite_sql(_EXACT) + "SELECT round(avg(CASE WHEN passed THEN 100.0 ELSE 0.0 END), 6) AS total_score FROM suite")
def a10(spark, d):
    score = report.quality_score(C.run_suite(stored_view(spark, d), _EXACT))
    return score.select(F.round("total_score", 6).alias("total_score"))


@query(
    "p12_results_with_column",
    _suite_sql(_EXACT)
    + f"""SELECT position, CASE {_attribute_sql('txt', '')} END AS column_name FROM suite""",
)
def p12_results(spark, d):
    results = report.with_column_name(C.run_suite(stored_view(spark, d), _EXACT))
    return results.select("position", "column_name")


# Violating rows

_E_SQL = {
    "e1_null_rows": ("row_id", "PARENT IS NULL", lambda v: V.null_rows(v, "PARENT")),
    "e5_bad_string_rows": ("row_id", "LEVEL_NAME IS NULL", lambda v: V.bad_string_rows(v, "LEVEL_NAME")),
    "e7_pattern_rows": ("row_id, HIERARCHY", "NOT regexp_matches(HIERARCHY, '^ALL#.*#.*')", V.pattern_rows),
    "e8_country_depth_rows": ("row_id, HIERARCHY", f"LEVEL_NAME = 'COUNTRY' AND {_SEGMENTS} <> 4", V.country_depth_rows),
    "e9_level_mismatch_rows": (
        f"row_id, LEVEL_NUMBER, {_AFTER} AS count_after_parent",
        f"{_PLACE} > 0 AND LEVEL_NUMBER <> {_AFTER} AND LEVEL_NAME <> 'CONTINENT'",
        V.level_mismatch_rows,
    ),
    "e10_orphan_rows": ("row_id, CODE", _ORPHAN_SQL, V.orphan_rows),
    "e11_under_world_rows": (
        "row_id, CODE",
        f"starts_with(HIERARCHY, 'ALL#WORLD#') AND {_SEGMENTS} = 3 AND LEVEL_NAME <> 'CONTINENT'",
        V.under_world_rows,
    ),
    "e12_group_children_rows": (
        "row_id, CHILDREN",
        "IS_GROUP AND (CHILDREN IS NULL OR trim(CHILDREN) = '' OR CHILDREN = '[]')",
        V.group_children_rows,
    ),
}


def _register_violation(name, columns, predicate, extract):
    shown = ["count_after_parent" if "count_after_parent" in c else c for c in columns.split(", ", 2)]

    @query(name, f"SELECT {columns} FROM loc AS l WHERE {predicate}")
    def run(spark, d):
        return extract(location_view(spark, d)).select(*shown)


for _name, (_columns, _predicate, _extract) in _E_SQL.items():
    _register_violation(_name, _columns, _predicate, _extract)


@query(
    "e2_bad_number_rows",
    "SELECT event_id, t FROM (SELECT event_id, CASE WHEN event_type = 'view' THEN CAST(user_id AS VARCHAR) ELSE event_type END AS t FROM events) WHERE TRY_CAST(t AS INTEGER) IS NULL",
    loc=False,
)
def e2(spark, d):
    t = F.when(F.col("event_type") == "view", F.col("user_id").cast("string")).otherwise(F.col("event_type"))
    return V.bad_number_rows(table(spark, d, "events").select("event_id", t.alias("t")), "t")


@query(
    "e3_bad_boolean_rows",
    "SELECT event_id, t FROM (SELECT event_id, CASE WHEN event_type = 'view' THEN 'true' WHEN event_type = 'click' THEN 'false' ELSE event_type END AS t FROM events) WHERE t NOT IN ('true', 'false')",
    loc=False,
)
def e3(spark, d):
    kind = F.col("event_type")
    t = F.when(kind == "view", "true").when(kind == "click", "false").otherwise(kind)
    return V.bad_boolean_rows(table(spark, d, "events").select("event_id", t.alias("t")), "t")


@query(
    "e4_bad_array_rows",
    "SELECT event_id, t FROM (SELECT event_id, CASE WHEN event_type = 'view' THEN '[\"' || user_id || '\"]' WHEN event_type = 'click' THEN NULL ELSE 'not ' || event_type END AS t FROM events) WHERE starts_with(t, 'not ')",
    loc=False,
)
def e4(spark, d):
    kind = F.col("event_type")
    t = F.when(kind == "view", F.concat(F.lit('["'), F.col("user_id").cast("string"), F.lit('"]')))
    t = t.when(kind != "click", F.concat(F.lit("not "), kind))
    return V.bad_array_rows(table(spark, d, "events").select("event_id", t.alias("t")), "t")


@query(
    "e6_duplicate_key_rows",
    "SELECT row_id, CODE, count FROM (SELECT row_id, CODE, count(*) OVER (PARTITION BY CODE) AS count FROM loc) WHERE count > 1 AND CODE IS NOT NULL",
)
def e6(spark, d):
    return V.duplicate_key_rows(location_view(spark, d)).select("row_id", "CODE", "count")


ALL_PROBLEMS_SQL = f"""
SELECT row_id, 'CompletenessConstraint - Null values in HIERARCHY' AS PROBLEM FROM loc WHERE HIERARCHY IS NULL
UNION ALL SELECT row_id, 'CompletenessConstraint - Null values in LEVEL_NAME' FROM loc WHERE LEVEL_NAME IS NULL
UNION ALL SELECT row_id, 'CompletenessConstraint - Null values in OFFICIAL_LEVEL_NAME' FROM loc WHERE OFFICIAL_LEVEL_NAME IS NULL
UNION ALL SELECT row_id, 'CompletenessConstraint - Null values in PARENT' FROM loc WHERE PARENT IS NULL
UNION ALL SELECT row_id, 'CompletenessConstraint - Null values in LEVEL_NUMBER' FROM loc WHERE LEVEL_NUMBER IS NULL
UNION ALL SELECT row_id, '{V.BAD_PATTERN}' FROM loc WHERE {_E_SQL['e7_pattern_rows'][1]}
UNION ALL SELECT row_id, '{V.BAD_COUNTRY_DEPTH}' FROM loc WHERE {_E_SQL['e8_country_depth_rows'][1]}
UNION ALL SELECT row_id, '{V.BAD_LEVEL_NUMBER}' FROM loc WHERE {_E_SQL['e9_level_mismatch_rows'][1]}
UNION ALL SELECT row_id, '{V.ORPHAN}' FROM loc AS l WHERE {_ORPHAN_SQL}
UNION ALL SELECT row_id, '{V.BAD_UNDER_WORLD}' FROM loc WHERE {_E_SQL['e11_under_world_rows'][1]}
UNION ALL SELECT row_id, '{V.NO_CHILDREN}' FROM loc WHERE {_E_SQL['e12_group_children_rows'][1]}
UNION ALL SELECT row_id, '{V.duplicate_problem('CODE')}' FROM (SELECT row_id, count(*) OVER (PARTITION BY CODE) AS n FROM loc) WHERE n > 1
"""


@query("e13_extract_all", ALL_PROBLEMS_SQL)
def e13(spark, d):
    view = stored_view(spark, d)
    return V.extract_all(view, C.run_suite(view, _EXACT)).select("row_id", "PROBLEM")


@query(
    "e13_extract_user_constraints",
    """
    SELECT row_id, 'UniquenessConstraint - Duplicate NAME entries' AS PROBLEM
    FROM (SELECT row_id, NAME, count(*) OVER (PARTITION BY NAME) AS n FROM loc) WHERE n > 1 AND NAME IS NOT NULL
    UNION ALL SELECT row_id, 'ComplianceConstraint - shallow' FROM loc WHERE NOT coalesce(LEVEL_NUMBER < 2, false)
    UNION ALL SELECT row_id, 'PatternMatchConstraint - Incorrect NAME pattern' FROM loc WHERE NOT coalesce(regexp_matches(NAME, '^[a-m]'), false)
    UNION ALL SELECT row_id, 'AnalysisBasedConstraint - LEVEL_NUMBER has incorrect datatype' FROM loc WHERE LEVEL_NUMBER IS NULL
    UNION ALL SELECT row_id, 'ComplianceConstraint - known parent' FROM loc WHERE PARENT IS NULL
    """,
)
def e13_user(spark, d):
    """The rows behind constraints that are none of the suite's."""
    view = stored_view(spark, d)
    check = C.Check("Error", "own").is_unique("NAME").satisfies("LEVEL_NUMBER < 2", "shallow").has_pattern("NAME", "^[a-m]")
    check = check.has_data_type("LEVEL_NUMBER", "Boolean").has_no_rows(lambda df: V.null_rows(df, "PARENT"), "known parent")
    return V.extract_all(view, C.run_suite(view, [check]), [check]).select("row_id", "PROBLEM")
