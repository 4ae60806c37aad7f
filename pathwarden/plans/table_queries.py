"""Joins, hierarchy repair, windows, sets and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from pathwarden.functions import paths as P
from pathwarden.model import CONTINENTS, PROCESSED_COLUMNS
from pathwarden.operators import hierarchy as H
from pathwarden.operators import joins as J
from pathwarden.operators import report, rows
from pathwarden.operators import violations as V
from pathwarden.plans.basic_queries import ALL_PROBLEMS_SQL, _EXACT, stored_view
from pathwarden.operators import checks as C
from pathwarden.plans.registry import query
from pathwarden.sources.location_view import level_reference, location_view, raw_view, table

ORDER = "row_id"


def countries_of(view):
    return view.where((F.col("LEVEL_NAME") == "COUNTRY") & (F.col("LEVEL_NUMBER") == 0))


# Joins


@query(
    "j1_inner_on_key",
    """
    , a AS (SELECT * FROM loc WHERE LEVEL_NAME = 'CITY'), b AS (SELECT * FROM loc WHERE PARENT = 'N3')
    SELECT a.CODE, a.row_id AS row_id_x, b.row_id AS row_id_y, a.NAME AS NAME_x, b.NAME AS NAME_y FROM a JOIN b ON a.CODE = b.CODE
    """,
)
def j1(spark, d):
    view = location_view(spark, d).select("row_id", "CODE", "NAME", "LEVEL_NAME", "PARENT")
    a = view.where("LEVEL_NAME = 'CITY'").select("row_id", "CODE", "NAME")
    return J.inner_on_key(a, view.where("PARENT = 'N3'").select("row_id", "CODE", "NAME"), "CODE")


@query("j1_orders_of_customers", "SELECT o_orderkey, c_custkey AS custkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey", loc=False)
def j1_orders(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"))
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("custkey"), "c_mktsegment")
    return orders.join(customers, ["custkey"]).select("o_orderkey", "custkey", "c_mktsegment")


@query(
    "j2_left_anti",
    "SELECT c_custkey AS custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')",
    loc=False,
)
def j2(spark, d):
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("custkey"))
    urgent = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'")
    orders = urgent.select(F.col("o_custkey").alias("custkey")).distinct()
    return customers.join(orders, ["custkey"], "left_anti")


@query(
    "j3_anti_by_key",
    """
    SELECT row_id, HIERARCHY FROM loc AS l WHERE LEVEL_NAME = 'CITY'
    AND NOT EXISTS (SELECT 1 FROM loc AS o WHERE o.PARENT IS NULL AND o.HIERARCHY IS NOT DISTINCT FROM l.HIERARCHY)
    """,
)
def j3(spark, d):
    view = location_view(spark, d)
    cities = view.where("LEVEL_NAME = 'CITY'").select("row_id", "HIERARCHY")
    return J.anti_by_key(cities, view.where("PARENT IS NULL").select("HIERARCHY"), "HIERARCHY")


@query(
    "j4_semi_by_key",
    "SELECT row_id, NAME FROM loc WHERE LEVEL_NAME = 'CITY' AND NAME IN (SELECT NAME FROM loc WHERE LEVEL_NAME = 'PORT_TERMINAL')",
)
def j4(spark, d):
    view = location_view(spark, d).select("row_id", "NAME", "LEVEL_NAME")
    ports = view.where("LEVEL_NAME = 'PORT_TERMINAL'")
    return J.semi_by_key(view.where("LEVEL_NAME = 'CITY'").select("row_id", "NAME"), ports, "NAME")


@query(
    "j5_lookup_default",
    """
    SELECT l.row_id, l.PARENT, coalesce(c.continent_name, 'NONE') AS continent_name
    FROM loc AS l LEFT JOIN (SELECT n_code AS code, r_name AS continent_name FROM country) AS c ON l.PARENT = c.code
    """,
)
def j5(spark, d):
    reference = level_reference(spark, d)
    known = J.dimension(
        reference, F.col("code"), "PARENT", {"continent_name": F.col("continent_name")}, F.col("ordinal")
    )
    view = location_view(spark, d).select("row_id", "PARENT")
    return J.lookup_default(view, "PARENT", known, "continent_name", F.lit("NONE"))


_LEV = "(200 * (greatest(length({a}), length({b})) - levenshtein({a}, {b})) + greatest(length({a}), length({b}))) // (2 * greatest(length({a}), length({b})))"


def score_sql(a, b):
    """The Levenshtein score of similarity.py in SQL; for non-empty texts."""
    return _LEV.format(a=a, b=b)


@query(
    "j6_best_match",
    f"""
    , choices AS (SELECT p_name AS choice, min(p_partkey) AS ordinal FROM part GROUP BY p_name),
    names AS (SELECT DISTINCT p_type || ' ' || p_brand AS name FROM part),
    scored AS (SELECT name, choice, ordinal, {score_sql('name', 'choice')} AS score FROM names, choices),
    best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY name ORDER BY score DESC, ordinal) = 1)
    SELECT p_partkey, best.name, CASE WHEN score >= 30 THEN choice END AS match, score
    FROM part JOIN best ON best.name = p_type || ' ' || p_brand
    """,
)
def j6(spark, d):
    part = table(spark, d, "part")
    choices = part.groupBy(F.col("p_name").alias("choice")).agg(F.min("p_partkey").alias("ordinal"))
    named = part.select("p_partkey", F.concat_ws(" ", "p_type", "p_brand").alias("name"))
    return J.best_match(named, "name", choices, "levenshtein", 30)


@query("j6_best_match_weighted")
def j6_weighted(spark, d):
    part = table(spark, d, "part")
    choices = part.groupBy(F.col("p_name").alias("choice")).agg(F.min("p_partkey").alias("ordinal"))
    named = part.select("p_partkey", F.concat_ws(" ", "p_type", "p_name").alias("name"))
    return J.best_match(named, "name", choices, "weighted", 80, strict=True)


_PREFIX_SQL = """
, bases AS (SELECT DISTINCT HIERARCHY AS prefix, CODE AS country FROM loc WHERE LEVEL_NAME = 'COUNTRY' AND LEVEL_NUMBER = 0),
hit AS (SELECT row_id, country, length(prefix) - length(replace(prefix, '#', '')) AS depth
        FROM loc JOIN bases ON HIERARCHY = prefix OR starts_with(HIERARCHY, prefix || '#')
        QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY length(prefix) DESC) = 1)
"""


@query("j7_under_prefix", _PREFIX_SQL + "SELECT row_id, HIERARCHY, country FROM loc LEFT JOIN hit USING (row_id)")
def j7(spark, d):
    view = location_view(spark, d)
    bases = countries_of(view).select(F.col("HIERARCHY").alias("prefix"), F.col("CODE").alias("country"))
    return J.under_prefix(view.select("row_id", "HIERARCHY"), "HIERARCHY", bases, "prefix", ["country"])


@query(
    "j10_keyed_update",
    """
    SELECT c_custkey AS custkey, coalesce(CASE WHEN n > 10 THEN 'BUSY' END, c_mktsegment) AS segment,
           coalesce(spent, c_acctbal) AS balance
    FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, round(max(o_totalprice), 2) AS spent FROM orders GROUP BY 1) ON o_custkey = c_custkey
    """,
    loc=False,
)
def j10(spark, d):
    customers = table(spark, d, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")
    )
    changes = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("custkey")).agg(
        F.when(F.count("*") > 10, "BUSY").alias("segment"), F.round(F.max("o_totalprice"), 2).alias("balance")
    )
    return J.keyed_update(customers, changes, "custkey")


# Hierarchy


@query("h1_path_depth", "SELECT row_id, length(HIERARCHY) - length(replace(HIERARCHY, '#', '')) AS depth FROM loc")
def h1(spark, d):
    return location_view(spark, d).select("row_id", P.path_depth(F.col("HIERARCHY")).alias("depth"))


@query("h2_parent_path", "SELECT row_id, regexp_replace(HIERARCHY, '#[^#]+$', '') AS short FROM loc")
def h2(spark, d):
    return location_view(spark, d).select("row_id", P.parent_path(F.col("HIERARCHY")).alias("short"))


@query(
    "h3_strip_levels",
    """
    SELECT row_id, k, CASE WHEN k <= 0 THEN HIERARCHY ELSE array_to_string(
           list_slice(string_split(HIERARCHY, '#'), 1, greatest(len(string_split(HIERARCHY, '#')) - k, 0)), '#') END AS stripped
    FROM loc, (SELECT unnest([0, 1, 2, 3, 6]) AS k)
    """,
)
def h3(spark, d):
    numbers = F.explode(F.array(*[F.lit(k) for k in (0, 1, 2, 3, 6)]))
    view = location_view(spark, d).withColumn("k", numbers)
    return view.select("row_id", "k", P.strip_levels(F.col("HIERARCHY"), F.col("k")).alias("stripped"))


@query(
    "h4_strip_own_code",
    "SELECT row_id, CASE WHEN ends_with(HIERARCHY, '#' || CODE) THEN regexp_replace(HIERARCHY, '#[^#]*$', '') ELSE HIERARCHY END AS stripped FROM loc",
)
def h4(spark, d):
    stripped = P.strip_own_code(F.col("HIERARCHY"), F.col("CODE"))
    return location_view(spark, d).select("row_id", stripped.alias("stripped"))


@query(
    "h5_segments_after",
    """
    SELECT row_id, CASE WHEN list_contains(string_split(HIERARCHY, '#'), PARENT)
           THEN len(string_split(HIERARCHY, '#')) - list_position(string_split(HIERARCHY, '#'), PARENT) END AS after FROM loc
    """,
)
def h5(spark, d):
    after = P.segments_after(F.col("HIERARCHY"), F.col("PARENT"))
    return location_view(spark, d).select("row_id", after.alias("after"))


_ANCESTOR_SQL = """
, codes AS (SELECT DISTINCT CODE FROM loc WHERE LEVEL_NAME = 'COUNTRY'),
steps AS (SELECT row_id, unnest(string_split(HIERARCHY, '#')) AS part, generate_subscripts(string_split(HIERARCHY, '#'), 1) AS place FROM loc),
ancestor AS (SELECT row_id, arg_min(part, place) AS found FROM steps WHERE part IN (SELECT CODE FROM codes) GROUP BY row_id)
"""


@query("h6_first_ancestor_in", _ANCESTOR_SQL + "SELECT row_id, found AS PARENT FROM loc LEFT JOIN ancestor USING (row_id)")
def h6(spark, d):
    view = location_view(spark, d)
    codes = view.where(F.col("LEVEL_NAME") == "COUNTRY").select("CODE")
    return H.first_ancestor_in(view.select("row_id", "HIERARCHY"), codes).select("row_id", "PARENT")


@query("h7_drop_unparented", "SELECT row_id, CODE FROM loc WHERE PARENT IS NOT NULL OR CODE IN ('ALL', 'WORLD')")
def h7(spark, d):
    return H.drop_unparented(location_view(spark, d)).select("row_id", "CODE")


def _moved_countries(view):
    """Nations with a corrected path below their continent's name."""
    path = F.concat(F.lit("ALL#WORLD#"), F.col("PARENT"), F.lit("#"), F.col("CODE"))
    return countries_of(view).withColumn("HIERARCHY", path)


@query(
    "h8_rebase_path",
    """
    , moved AS (SELECT CODE AS country, 'ALL#WORLD#' || PARENT || '#' || CODE AS base FROM loc WHERE LEVEL_NAME = 'COUNTRY' AND LEVEL_NUMBER = 0)
    SELECT row_id, CASE WHEN base IS NULL OR upper(coalesce(LEVEL_NAME, '')) = 'COUNTRY' THEN HIERARCHY
           WHEN HIERARCHY IS NULL THEN base
           WHEN list_contains(string_split(HIERARCHY, '#'), PARENT) THEN array_to_string(list_concat([base],
                list_slice(string_split(HIERARCHY, '#'), list_position(string_split(HIERARCHY, '#'), PARENT) + 1, 1000)), '#')
           ELSE HIERARCHY END AS HIERARCHY
    FROM loc LEFT JOIN moved ON PARENT = country
    """,
)
def h8(spark, d):
    view = location_view(spark, d)
    return H.rebase_path(view, _moved_countries(view), F.col(ORDER)).select("row_id", "HIERARCHY")


@query(
    "h9_build_country_path",
    """
    SELECT l.row_id, coalesce(c.HIERARCHY, '') || '#' || l.CODE AS HIERARCHY
    FROM loc AS l LEFT JOIN loc AS c ON c.LEVEL_NAME = 'CONTINENT' AND c.NAME = l.PARENT AND c.NAME <> 'ASIA'
    WHERE l.LEVEL_NAME = 'COUNTRY' AND l.LEVEL_NUMBER = 0
    """,
)
def h9(spark, d):
    view = location_view(spark, d)
    continents = view.where("LEVEL_NAME = 'CONTINENT' AND NAME <> 'ASIA'")
    countries = countries_of(view).withColumnRenamed("PARENT", "CONTINENT")
    return H.build_country_path(countries, continents, F.col(ORDER)).select("row_id", "HIERARCHY")


@query(
    "h10_assign_level_number",
    _PREFIX_SQL
    + """
    SELECT row_id, length(HIERARCHY) - length(replace(HIERARCHY, '#', '')) - depth AS LEVEL_NUMBER
    FROM loc LEFT JOIN hit USING (row_id) WHERE NOT IS_GROUP
    """,
)
def h10(spark, d):
    view = location_view(spark, d)
    return H.assign_level_number(view, countries_of(view)).select("row_id", "LEVEL_NUMBER")


@query(
    "h11_fix_port_paths",
    """
    , shifted AS (SELECT * REPLACE (CASE WHEN LEVEL_NAME = 'PORT_TERMINAL' THEN CAST(nullif(row_id % 4, 3) AS INTEGER) ELSE LEVEL_NUMBER END AS LEVEL_NUMBER) FROM loc),
    base AS (SELECT CODE AS country, arg_max(HIERARCHY, row_id) AS base FROM (
             SELECT * FROM shifted WHERE LEVEL_NAME = 'COUNTRY') GROUP BY CODE)
    SELECT row_id, CASE WHEN LEVEL_NAME = 'PORT_TERMINAL' AND LEVEL_NUMBER <> 1 THEN coalesce(base, '') || '#' || CODE ELSE HIERARCHY END AS HIERARCHY,
           CASE WHEN LEVEL_NAME = 'PORT_TERMINAL' AND LEVEL_NUMBER <> 1 THEN 1 ELSE LEVEL_NUMBER END AS LEVEL_NUMBER
    FROM shifted LEFT JOIN base ON PARENT = country
    """.replace("base AS (SELECT CODE", "cbase AS (SELECT CODE").replace("JOIN base", "JOIN cbase"),
)
def h11(spark, d):
    level = F.when(F.col("LEVEL_NAME") == "PORT_TERMINAL", F.nullif(F.col("row_id") % 4, F.lit(3)).cast("int"))
    shifted = location_view(spark, d).withColumn("LEVEL_NUMBER", level.when(F.col("LEVEL_NAME") != "PORT_TERMINAL", F.col("LEVEL_NUMBER")))
    return H.fix_port_paths(shifted, F.col(ORDER)).select("row_id", "HIERARCHY", "LEVEL_NUMBER")


_CONTINENT_LIST = "[" + ", ".join(f"'{c}'" for c in CONTINENTS) + "]"


@query(
    "h12_build_continents",
    f"""
    , names AS (SELECT unnest({_CONTINENT_LIST}) AS continent),
    picked AS (SELECT raw.NAME, CODE, HIERARCHY FROM raw, names WHERE NOT IS_GROUP AND LEVEL_NAME = 'REGION'
       AND HIERARCHY LIKE 'ALL#WORLD%' AND length(HIERARCHY) - length(replace(HIERARCHY, '#', '')) = 2
       AND {score_sql('upper(continent)', 'NAME')} > 40)
    SELECT upper(NAME[1]) || lower(NAME[2:]) AS NAME, CODE, HIERARCHY, 'CONTINENT' AS LEVEL_NAME FROM picked WHERE NAME NOT LIKE '% %'
    UNION ALL SELECT 'Middle East', CODE, HIERARCHY, 'CONTINENT' FROM picked WHERE NAME LIKE '% %'
    UNION ALL SELECT 'Oceania', 'OCE', 'ALL#WORLD#OCE', 'CONTINENT'
    """,
)
def h12(spark, d):
    names = [c.upper() for c in CONTINENTS]
    continents, _ = H.build_continents(raw_view(spark, d), names, "levenshtein", 40)
    return continents.select("NAME", "CODE", "HIERARCHY", "LEVEL_NAME")


@query("h12_build_continents_weighted")
def h12_weighted(spark, d):
    continents, rest = H.build_continents(raw_view(spark, d))
    return rows.union_ragged(continents, rest)


@query(
    "h13_assign_continent",
    f"""
    , rows_in AS (SELECT row_id, NAME FROM loc WHERE LEVEL_NAME = 'COUNTRY'),
    known AS (SELECT n_name AS country, r_name AS continent FROM country WHERE r_name IN ('AFRICA', 'ASIA')),
    ref AS (SELECT replace(n_name, '_', '-') AS country, r_name AS continent, n_nationkey AS ordinal FROM country),
    scored AS (SELECT NAME, ref.continent, ordinal, {score_sql('NAME', 'ref.country')} AS score FROM (SELECT DISTINCT NAME FROM rows_in), ref),
    similar_ref AS (SELECT NAME, continent FROM scored QUALIFY row_number() OVER (PARTITION BY NAME ORDER BY score DESC, ordinal) = 1 AND score > 80)
    SELECT row_id, rows_in.NAME, coalesce(known.continent, s.continent, 'NOT FOUND') AS CONTINENT
    FROM rows_in LEFT JOIN known ON known.country = rows_in.NAME LEFT JOIN similar_ref AS s ON s.NAME = rows_in.NAME
    """,
)
def h13(spark, d):
    reference = level_reference(spark, d)
    countries = location_view(spark, d).where("LEVEL_NAME = 'COUNTRY'").select("row_id", "NAME")
    known = reference.where(F.col("continent_name").isin("AFRICA", "ASIA")).select(
        "country", F.col("continent_name").alias("continent")
    )
    similar = reference.withColumn("country", F.replace("country", F.lit("_"), F.lit("-")))
    return H.assign_continent(countries, known, similar, ["AFRICA", "ASIA"], "levenshtein")


@query("h13_split_found_weighted")
def h13_weighted(spark, d):
    reference = level_reference(spark, d)
    regions = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
    countries = location_view(spark, d).where("LEVEL_NAME = 'COUNTRY'")
    known = reference.where(F.col("continent_name") == "AFRICA").select("country", F.col("continent_name").alias("continent"))
    similar = reference.withColumn("country", F.concat(F.lower("country"), F.lit(" (official)")))
    found, missing = H.split_found(H.assign_continent(countries, known, similar, regions), regions)
    return found.withColumn("found", F.lit(True)).unionByName(missing.withColumn("found", F.lit(False)))


@query(
    "h14_merge_levels",
    """
    SELECT row_id, PARENT, LEVEL_NUMBER FROM loc WHERE LEVEL_NAME NOT IN ('COUNTRY', 'CONTINENT')
    UNION ALL SELECT row_id, PARENT, 0 FROM loc WHERE LEVEL_NAME = 'COUNTRY'
    UNION ALL SELECT row_id, 'WORLD', -1 FROM loc WHERE LEVEL_NAME = 'CONTINENT'
    """,
)
def h14(spark, d):
    view = location_view(spark, d)
    rest = view.where("LEVEL_NAME NOT IN ('COUNTRY', 'CONTINENT')")
    countries = view.where("LEVEL_NAME = 'COUNTRY'").withColumnRenamed("PARENT", "CONTINENT").drop("LEVEL_NUMBER")
    continents = view.where("LEVEL_NAME = 'CONTINENT'").drop("PARENT", "LEVEL_NUMBER")
    return H.merge_levels(rest, countries, continents).select("row_id", "PARENT", "LEVEL_NUMBER")


_PROCESSED_SQL = "(SELECT CODE FROM loc WHERE PARENT IS NOT NULL AND LEVEL_NAME <> 'PORT_TERMINAL')"


@query("h15_find_outliers", f"SELECT row_id, CODE FROM raw WHERE CODE NOT IN {_PROCESSED_SQL}")
def h15(spark, d):
    processed = location_view(spark, d).where("PARENT IS NOT NULL AND LEVEL_NAME <> 'PORT_TERMINAL'")
    return H.find_outliers(raw_view(spark, d), processed).select("row_id", "CODE")


@query(
    "h16_official_level_name",
    f"""
    , ref AS (SELECT n_code AS code, n_nationkey, ['cities'] AS l2 FROM country),
    names AS (SELECT code, 1 AS level, lower(c_mktsegment) AS name,
                     row_number() OVER (PARTITION BY code ORDER BY c_mktsegment) AS place
              FROM (SELECT DISTINCT code, c_mktsegment FROM customer JOIN ref ON c_nationkey = n_nationkey)
              UNION ALL SELECT code, 2, 'cities', 1 FROM ref),
    cases AS (SELECT DISTINCT PARENT, LEVEL_NAME, LEVEL_NUMBER, lower(trim(coalesce(LEVEL_NAME, 'nan'))) AS text FROM loc
              WHERE PARENT IS NOT NULL AND lower(trim(coalesce(LEVEL_NAME, 'nan'))) NOT IN ('country', 'continent', 'all', 'world')),
    scored AS (SELECT cases.*, name, place, {score_sql('text', 'name')} AS score FROM cases JOIN names ON code = trim(PARENT) AND level = LEVEL_NUMBER),
    best AS (SELECT PARENT, LEVEL_NAME, LEVEL_NUMBER,
             CASE WHEN max(score) >= 50 THEN arg_max(name, score * 1000 - place) ELSE arg_min(name, place) END AS name FROM scored GROUP BY ALL)
    SELECT row_id, coalesce(upper(best.name), loc.LEVEL_NAME) AS OFFICIAL_LEVEL_NAME
    FROM loc LEFT JOIN best ON best.PARENT = loc.PARENT AND best.LEVEL_NUMBER = loc.LEVEL_NUMBER
         AND best.LEVEL_NAME IS NOT DISTINCT FROM loc.LEVEL_NAME
    """,
)
def h16(spark, d):
    reference = level_reference(spark, d).withColumns(
        {"level_1": F.transform("level_1", F.lower), "level_2": F.lit("cities")}
    )
    view = location_view(spark, d).drop("OFFICIAL_LEVEL_NAME")
    return H.official_level_name(view, reference, "levenshtein").select("row_id", "OFFICIAL_LEVEL_NAME")


@query("h16_official_level_name_ratio")
def h16_ratio(spark, d):
    view = location_view(spark, d).drop("OFFICIAL_LEVEL_NAME")
    return H.official_level_name(view, level_reference(spark, d)).select("row_id", "OFFICIAL_LEVEL_NAME")


# Windows and order


@query(
    "w1_top_k_per_key",
    "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 5",
    loc=False,
)
def w1(spark, d):
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return rows.top_k(orders, ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 5)


@query(
    "w2_top_1_per_key",
    "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_partkey, l_suppkey) = 1",
    loc=False,
)
def w2(spark, d):
    items = table(spark, d, "lineitem")
    best = F.max_by(
        F.struct("l_linenumber", "l_extendedprice"),
        F.struct("l_extendedprice", -F.col("l_linenumber"), -F.col("l_partkey"), -F.col("l_suppkey")),
    )
    return items.groupBy("l_orderkey").agg(best.alias("b")).select("l_orderkey", "b.l_linenumber", "b.l_extendedprice")


@query(
    "w3_keep_first",
    "SELECT row_id, NAME, LEVEL_NAME, PARENT FROM loc QUALIFY row_number() OVER (PARTITION BY NAME, LEVEL_NAME, PARENT ORDER BY row_id) = 1",
)
def w3(spark, d):
    view = location_view(spark, d).select("row_id", "NAME", "LEVEL_NAME", "PARENT")
    return rows.keep_first(view, ["NAME", "LEVEL_NAME", "PARENT"], [F.col("row_id")])


@query("w4_distinct_rows", "SELECT DISTINCT text, lang FROM documents", loc=False)
def w4(spark, d):
    return rows.distinct_rows(table(spark, d, "documents").select("text", "lang"))


@query("w5_first_rows", "SELECT event_id, user_id FROM events ORDER BY ts, event_id LIMIT 1500", loc=False)
def w5(spark, d):
    return rows.first_rows(table(spark, d, "events"), 1500, ["ts", "event_id"]).select("event_id", "user_id")


@query(
    "w6_row_ordinal",
    "SELECT doc_id, row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS ordinal FROM documents",
    loc=False,
)
def w6(spark, d):
    return rows.with_ordinal(table(spark, d, "documents").select("doc_id", "n_chars"), ["n_chars", "doc_id"]).select("doc_id", "ordinal")


# Sets and reports


@query(
    "u1_union_ragged",
    """
    SELECT row_id, NAME, PARENT, CAST(NULL AS VARCHAR) AS CONTINENT FROM loc WHERE LEVEL_NAME = 'CITY'
    UNION ALL SELECT row_id, NAME, NULL, PARENT FROM loc WHERE LEVEL_NAME = 'COUNTRY'
    """,
)
def u1(spark, d):
    view = location_view(spark, d)
    countries = view.where("LEVEL_NAME = 'COUNTRY'").select("row_id", "NAME", F.col("PARENT").alias("CONTINENT"))
    return rows.union_ragged(view.where("LEVEL_NAME = 'CITY'").select("row_id", "NAME", "PARENT"), countries)


@query("u2_key_union", "SELECT CODE FROM loc WHERE LEVEL_NAME = 'COUNTRY' UNION SELECT CODE FROM loc WHERE PARENT = 'N3'")
def u2(spark, d):
    view = location_view(spark, d)
    return rows.key_union(view.where("LEVEL_NAME = 'COUNTRY'"), view.where("PARENT = 'N3'"), key="CODE")


@query(
    "u3_except_by_key",
    "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')",
    loc=False,
)
def u3(spark, d):
    items = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"), "l_linenumber")
    closed = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("key"))
    return J.anti_by_key(items, closed, "key").withColumnRenamed("key", "l_orderkey")


@query(
    "u4_intersect_by_key",
    "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')",
    loc=False,
)
def u4(spark, d):
    items = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"), "l_linenumber")
    closed = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("key"))
    return J.semi_by_key(items, closed, "key").withColumnRenamed("key", "l_orderkey")


@query(
    "u5_merge_problems",
    f"""
    , found AS ({ALL_PROBLEMS_SQL}),
    merged AS (SELECT row_id, PROBLEM FROM found
      UNION ALL SELECT row_id, '{report.DUPLICATE}' FROM loc WHERE LEVEL_NAME = 'PORT_TERMINAL'
      UNION ALL SELECT row_id, '{report.OUTLIER}' FROM raw WHERE CODE NOT IN {_PROCESSED_SQL})
    SELECT row_id, PROBLEM, CASE WHEN starts_with(PROBLEM, 'UniquenessConstraint') THEN 'NAME'
      {' '.join(f"WHEN regexp_matches(PROBLEM, '(?i)\\b{c}\\b') THEN '{c}'" for c in PROCESSED_COLUMNS)} END AS COLUMN_PROBLEM FROM merged
    """,
)
def u5(spark, d):
    view = stored_view(spark, d)
    problems = V.extract_all(view, C.run_suite(view, _EXACT)).select("row_id", *PROCESSED_COLUMNS, "PROBLEM")
    processed = view.where("PARENT IS NOT NULL AND LEVEL_NAME <> 'PORT_TERMINAL'")
    outliers = H.find_outliers(raw_view(spark, d), processed)
    merged = report.merge_problems(problems, view.where("LEVEL_NAME = 'PORT_TERMINAL'"), outliers)
    return merged.select("row_id", "PROBLEM", "COLUMN_PROBLEM")


_REVIEWED = "SELECT doc_id, coalesce(quality, 0) = 1 AS ok FROM documents LEFT JOIN labels USING (doc_id)"


@query(
    "f8_correction_pairs",
    f"""
    WITH n AS (SELECT 'D' || doc_id AS code, ok, row_number() OVER (ORDER BY doc_id) - 1 AS place FROM ({_REVIEWED})),
    p AS (SELECT a.code AS c0, a.ok AS ok0, b.code AS c1, coalesce(b.ok, false) AS ok1
          FROM n AS a LEFT JOIN n AS b ON b.place = a.place + 1 WHERE a.place % 2 = 0)
    SELECT CASE WHEN ok0 THEN c1 ELSE c0 END AS Old, CASE WHEN ok0 THEN c0 ELSE c1 END AS Corrected FROM p WHERE ok0 OR ok1
    """,
    loc=False,
)
def f8(spark, d):
    quality = table(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, " True").otherwise("False").alias("Valid"))
    reviewed = table(spark, d, "documents").select("doc_id").join(quality, "doc_id", "left")
    reviewed = reviewed.withColumn("CODE", F.concat(F.lit("D"), F.col("doc_id").cast("string")))
    return report.correction_pairs(reviewed, ["doc_id"])


@query(
    "f9_compare_detections",
    """
    , a AS (SELECT CODE FROM loc WHERE LEVEL_NAME = 'CITY'), b AS (SELECT CODE FROM loc WHERE PARENT = 'N3')
    SELECT 'common' AS side, a.CODE FROM a JOIN b USING (CODE)
    UNION ALL SELECT 'a_only', CODE FROM a WHERE CODE NOT IN (SELECT CODE FROM b)
    UNION ALL SELECT 'b_only', CODE FROM b WHERE CODE NOT IN (SELECT CODE FROM a)
    """,
)
def f9(spark, d):
    view = location_view(spark, d).select("CODE", "LEVEL_NAME", "PARENT")
    parts = report.compare_detections(view.where("LEVEL_NAME = 'CITY'"), view.where("PARENT = 'N3'"))
    return rows.union_ragged(*[p.select(F.lit(side).alias("side"), "CODE") for side, p in parts.items()])


@query(
    "f10_changed_rows",
    """
    SELECT row_id, 'ALL#WORLD#' || PARENT || '#' || CODE AS HIERARCHY FROM loc WHERE LEVEL_NAME = 'COUNTRY' AND LEVEL_NUMBER = 0
    """,
)
def f10(spark, d):
    view = location_view(spark, d)
    return report.changed_rows(_moved_countries(view).select("row_id", "HIERARCHY"), view.select("HIERARCHY"))
