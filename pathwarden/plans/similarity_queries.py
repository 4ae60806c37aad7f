"""Near-duplicate and vector queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pathwarden.model import CONTINENTS, PROCESSED_COLUMNS
from pathwarden.operators import checks as C
from pathwarden.operators import fuzzy, rows, vectors
from pathwarden.operators.grouping import seed_members
from pathwarden.plans import flows
from pathwarden.plans.basic_queries import ALL_PROBLEMS_SQL
from pathwarden.plans.registry import LOC, query
from pathwarden.plans.table_queries import score_sql
from pathwarden.session import checkpoint_folder
from pathwarden.sources.location_view import level_reference, location_view, raw_view, table


def pages_view(spark, d):
    """Web addresses in the shape of locations: the address is the name, its parts are the path."""
    url = F.col("url")
    path = F.concat(F.lit("WEB#"), F.regexp_replace(F.regexp_replace(url, "^https?://", ""), "[^A-Za-z0-9]+", "#"))
    return table(spark, d, "pages").select(
        F.col("page_id").alias("row_id"),
        url.alias("NAME"),
        F.concat(F.lit("P"), F.col("page_id").cast("string")).alias("CODE"),
        path.alias("HIERARCHY"),
        F.lit(False).alias("IS_GROUP"),
        F.lit(None).cast("string").alias("CHILDREN"),
        F.regexp_extract(url, "/([a-z][a-z])/", 1).alias("LEVEL_NAME"),
    )


_PAGES = """
WITH RECURSIVE pg AS (
  SELECT page_id AS row_id, url AS NAME, regexp_extract(url, '/([a-z][a-z])/', 1) AS LEVEL_NAME,
         'WEB#' || regexp_replace(regexp_replace(url, '^https?://', ''), '[^A-Za-z0-9]+', '#', 'g') AS HIERARCHY FROM pages)
"""


def _pairs_sql(source, name_cutoff, path_cutoff):
    return f"""
    , scored AS MATERIALIZED (SELECT a.LEVEL_NAME AS block, a.row_id AS a, b.row_id AS b,
           CAST({score_sql('a.NAME', 'b.NAME')} AS INTEGER) AS name_score,
           CAST({score_sql('a.HIERARCHY', 'b.HIERARCHY')} AS INTEGER) AS path_score
    FROM {source} AS a JOIN {source} AS b ON a.LEVEL_NAME = b.LEVEL_NAME AND a.row_id < b.row_id),
    edges AS (SELECT * FROM scored WHERE name_score >= {name_cutoff} AND path_score >= {path_cutoff})
    """


def _sweep_sql(nodes, neighbours, order="id"):
    """The sequential sweep over `nodes` (id) in order; a node takes its untaken larger neighbours."""
    return f"""
    , ordered AS MATERIALIZED (SELECT id, row_number() OVER (ORDER BY {order}) AS pos,
                  coalesce((SELECT list(b ORDER BY b) FROM {neighbours} AS e WHERE e.a = n.id), []) AS nb FROM {nodes} AS n),
    sweep AS (
      SELECT CAST(0 AS BIGINT) AS step, CAST([] AS BIGINT[]) AS taken, CAST([] AS STRUCT(seed BIGINT, id BIGINT)[]) AS found
      UNION ALL
      SELECT step + 1,
             CASE WHEN list_contains(taken, x) OR len(fresh) = 0 THEN taken ELSE list_concat(taken, list_append(fresh, x)) END,
             CASE WHEN list_contains(taken, x) OR len(fresh) = 0 THEN found
                  ELSE list_concat(found, list_transform(list_append(fresh, x), lambda m: {{'seed': x, 'id': m}})) END
      FROM (SELECT s.step, s.taken, s.found, CAST(o.id AS BIGINT) AS x,
                   list_filter(CAST(o.nb AS BIGINT[]), lambda m: NOT list_contains(s.taken, m)) AS fresh
            FROM sweep AS s JOIN ordered AS o ON o.pos = s.step + 1)),
    swept AS (SELECT unnest(found) AS f FROM sweep WHERE step = (SELECT max(step) FROM sweep)),
    grouped AS (SELECT f.seed AS seed, f.id AS id FROM swept)
    """


_NAMES_SQL = f"""
, nm AS (SELECT LEVEL_NAME AS block, NAME AS name, min(row_id) AS id FROM loc WHERE LEVEL_NAME IS NOT NULL GROUP BY 1, 2),
np AS (SELECT a.block, a.id, a.name, b.name AS match, CAST({score_sql('a.name', 'b.name')} AS INTEGER) AS score
       FROM nm AS a JOIN nm AS b ON a.block = b.block),
matches AS MATERIALIZED (SELECT np.block, np.id, np.name, row_number() OVER (PARTITION BY np.block, np.id ORDER BY score DESC, row_id) AS rank,
                   row_id AS row, match, score
            FROM np JOIN loc ON loc.LEVEL_NAME = np.block AND loc.NAME = np.match WHERE score >= 85
            QUALIFY row_number() OVER (PARTITION BY np.block, np.id ORDER BY score DESC, row_id) <= 5)
"""

_NAME_SWEEP_SQL = (
    _NAMES_SQL
    + """
, several AS (SELECT block, id FROM matches GROUP BY 1, 2 HAVING count(*) > 1),
ordered AS MATERIALIZED (SELECT s.id, row_number() OVER (ORDER BY s.id) AS pos,
            (SELECT list(DISTINCT t.id) FROM matches AS m JOIN nm AS t ON t.block = m.block AND t.name = m.match WHERE m.id = s.id) AS nb
            FROM several AS s),
sweep AS (
  SELECT CAST(0 AS BIGINT) AS step, CAST([] AS BIGINT[]) AS taken, CAST([] AS BIGINT[]) AS seeds
  UNION ALL
  SELECT step + 1,
         CASE WHEN list_contains(taken, o.id) THEN taken ELSE list_concat(taken, CAST(o.nb AS BIGINT[])) END,
         CASE WHEN list_contains(taken, o.id) THEN seeds ELSE list_append(seeds, CAST(o.id AS BIGINT)) END
  FROM sweep AS s JOIN ordered AS o ON o.pos = s.step + 1),
seeds AS (SELECT unnest(seeds) AS id FROM sweep WHERE step = (SELECT max(step) FROM sweep)),
name_groups AS (SELECT block, id AS "group", rank, row FROM matches WHERE id IN (SELECT id FROM seeds))
"""
)


@query("f1_similar_names", _NAMES_SQL + "SELECT block, id, name, rank, row, match, score FROM matches")
def f1(spark, d):
    return fuzzy.similar_names(location_view(spark, d), cutoff=85, scorer="levenshtein")


@query("f1_similar_names_weighted")
def f1_weighted(spark, d):
    return fuzzy.similar_names(pages_view(spark, d), scorer="weighted")


@query("f2_group_by_name", _NAME_SWEEP_SQL + 'SELECT block, "group", rank, row FROM name_groups')
def f2(spark, d):
    return fuzzy.group_by_name(fuzzy.similar_names(location_view(spark, d), cutoff=85, scorer="levenshtein"))


@query(
    "f3_fetch_group_rows",
    _NAME_SWEEP_SQL
    + """
    SELECT row_id, CODE, "group", rank FROM loc JOIN (
      SELECT row, "group", rank FROM name_groups QUALIFY row_number() OVER (PARTITION BY row ORDER BY "group", rank) = 1) ON row = row_id
    """,
)
def f3(spark, d):
    view = location_view(spark, d)
    groups = fuzzy.name_groups(view, "LEVEL_NAME", "row_id", 5, 85, "levenshtein")
    return fuzzy.group_rows(groups, view).select("row_id", "CODE", "group", "rank")


@query(
    "f4_similar_groups",
    _PAGES + _pairs_sql("pg", 90, 85) + _sweep_sql("(SELECT row_id AS id FROM pg)", "edges") + "SELECT seed, id FROM grouped",
    loc=False,
)
def f4(spark, d):
    view = pages_view(spark, d)
    return fuzzy.similar_groups(view, name_cutoff=90, path_cutoff=85, scorer="levenshtein").select("seed", "id")


@query("f4_similar_groups_ratio")
def f4_ratio(spark, d):
    return fuzzy.similar_groups(pages_view(spark, d), name_cutoff=90, path_cutoff=90)


_STRIPPED_SQL = (
    _PAGES
    + """
    , stripped AS (SELECT k * 1000000000 + row_id AS row_id, k, LEVEL_NAME || k AS LEVEL_NAME, NAME,
        CASE WHEN k = 0 THEN HIERARCHY ELSE array_to_string(
          list_slice(string_split(HIERARCHY, '#'), 1, greatest(len(string_split(HIERARCHY, '#')) - k, 0)), '#') END AS HIERARCHY
        FROM pg, (SELECT unnest([CAST(0 AS BIGINT), 1, 2, 3]) AS k))
    """
    + _pairs_sql("stripped", 88, 88)
    + _sweep_sql("(SELECT row_id AS id FROM stripped)", "edges")
    + "SELECT CAST(seed // 1000000000 AS INTEGER) AS levels, seed % 1000000000 AS seed, id % 1000000000 AS id FROM grouped"
)


@query("f5_similar_groups_stripped", _STRIPPED_SQL, loc=False)
def f5(spark, d):
    groups = fuzzy.similar_groups_stripped(
        pages_view(spark, d), [0, 1, 2, 3], name_cutoff=88, path_cutoff=88, scorer="levenshtein"
    )
    return groups.select("levels", "seed", "id")


@query("f6_static_detection")
def f6(spark, d):
    return fuzzy.static_detection(location_view(spark, d), scorer="weighted")


_STATIC_SQL = (
    # The names' sweep stands beside the rows', so its tables get names of their own.
    _NAME_SWEEP_SQL.replace("ordered", "ordered_names").replace("sweep", "name_sweep")
    + """
    , firsts AS (SELECT row, "group" * 6 + rank AS place FROM name_groups QUALIFY row_number() OVER (PARTITION BY row ORDER BY "group", rank) = 1),
    stripped AS MATERIALIZED (SELECT k * 1000000000 + row_id AS row_id, k, place, LEVEL_NAME || k AS LEVEL_NAME, NAME,
        CASE WHEN k = 0 THEN HIERARCHY ELSE array_to_string(
          list_slice(string_split(HIERARCHY, '#'), 1, greatest(len(string_split(HIERARCHY, '#')) - k, 0)), '#') END AS HIERARCHY
        FROM loc JOIN firsts ON row = row_id, (SELECT unnest([CAST(0 AS BIGINT), 1, 2, 3]) AS k) WHERE HIERARCHY IS NOT NULL),
    edges AS MATERIALIZED (SELECT a.row_id AS a, b.row_id AS b FROM stripped AS a JOIN stripped AS b
        ON a.LEVEL_NAME = b.LEVEL_NAME AND a.row_id < b.row_id
        WHERE {names} >= 90 AND coalesce({paths}, 100) >= 90)
    """.format(names=score_sql("a.NAME", "b.NAME"), paths=score_sql("a.HIERARCHY", "b.HIERARCHY"))
    + _sweep_sql("(SELECT row_id AS id, place FROM stripped)", "edges", "place, id")
    + """
    , listed AS (SELECT loc.*, seed // 1000000000 AS levels, seed % 1000000000 AS opener FROM grouped JOIN loc ON row_id = id % 1000000000)
    SELECT row_id, CODE, levels || ' LEVELS' AS LEVELS_REMOVED FROM listed
    QUALIFY row_number() OVER (PARTITION BY NAME, CODE, HIERARCHY, IS_GROUP, CHILDREN, LEVEL_NAME ORDER BY levels, opener, row_id) = 1
    """
)


@query("f6_static_detection_levenshtein", _STATIC_SQL)
def f6_levenshtein(spark, d):
    """Name groups, then similar paths in the order of the name groups, all four strippings."""
    found = fuzzy.static_detection(location_view(spark, d), cutoff=85, scorer="levenshtein", pair_scorer="levenshtein")
    return found.select("row_id", "CODE", "LEVELS_REMOVED")


@query("f6_static_detection_pages")
def f6_pages(spark, d):
    return fuzzy.static_detection(pages_view(spark, d))


@query(
    "f7_name_duplicates",
    _NAME_SWEEP_SQL + "SELECT row_id, NAME, CODE, LEVEL_NAME FROM loc WHERE row_id IN (SELECT row FROM name_groups)",
)
def f7(spark, d):
    found = fuzzy.name_duplicates(location_view(spark, d), cutoff=85, scorer="levenshtein")
    return found.select("row_id", "NAME", "CODE", "LEVEL_NAME")


@query("f7_name_duplicates_weighted")
def f7_weighted(spark, d):
    return fuzzy.name_duplicates(pages_view(spark, d))


@query(
    "j8_fuzzy_self_join",
    _PAGES + _pairs_sql("pg", 85, 80) + "SELECT block, a, b, name_score, path_score FROM edges",
    loc=False,
)
def j8(spark, d):
    return fuzzy.similar_path_pairs(pages_view(spark, d), name_cutoff=85, path_cutoff=80, scorer="levenshtein")


@query("j8_fuzzy_self_join_ratio")
def j8_ratio(spark, d):
    return fuzzy.similar_path_pairs(pages_view(spark, d), name_cutoff=90, path_cutoff=90)


# Vectors

_UNITS = """
WITH RECURSIVE unit AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
cosines AS MATERIALIZED (SELECT a.id AS a, b.id AS b, list_cosine_similarity(a.v, b.v) AS cosine FROM unit AS a, unit AS b WHERE a.id < b.id)
"""


_TURNED = """
WITH RECURSIVE unit AS (
  SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  UNION ALL SELECT vec_id + 1000000, list_concat([embedding[1] + 0.02], CAST(embedding[2:] AS DOUBLE[])) FROM embeddings WHERE vec_id % 3 = 0
  UNION ALL SELECT vec_id + 2000000, CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id % 7 = 0),
cosines AS MATERIALIZED (SELECT a.id AS a, b.id AS b, list_cosine_similarity(a.v, b.v) AS cosine FROM unit AS a, unit AS b WHERE a.id < b.id)
"""


def _turned(spark, d):
    """The vectors, slightly turned copies of some, and equal copies of others: pairs above 0.98 exist."""
    vectors_ = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"))
    first = F.array(F.get("v", F.lit(0)) + F.lit(0.02))
    turned = vectors_.where("id % 3 = 0").select((F.col("id") + 1000000).alias("id"), F.concat(first, F.slice("v", 2, F.size("v"))).alias("v"))
    copies = vectors_.where("id % 7 = 0").select((F.col("id") + 2000000).alias("id"), "v")
    return vectors_.unionByName(turned).unionByName(copies)


@query("v2_cosine_pairs_near", _TURNED + "SELECT a, b, round(cosine, 6) AS cosine FROM cosines WHERE cosine > 0.98", loc=False)
def v2_near(spark, d):
    pairs = vectors.cosine_pairs(_turned(spark, d), threshold=0.98, vector="v")
    return pairs.select("a", "b", F.round("cosine", 6).alias("cosine"))


@query("v1_encode_text")
def v1(spark, d):
    named = location_view(spark, d).select("row_id", F.col("NAME").alias("text"))
    return vectors.encode_text(named)


@query("v2_cosine_pairs", _UNITS + "SELECT a, b, round(cosine, 6) AS cosine FROM cosines WHERE cosine > 0.35", loc=False)
def v2(spark, d):
    pairs = vectors.cosine_pairs(table(spark, d, "embeddings"), threshold=0.35, id="vec_id", vector="embedding")
    return pairs.select("a", "b", F.round("cosine", 6).alias("cosine"))


@query("j9_similarity_self_join", _UNITS + "SELECT a, b, round(cosine, 6) AS cosine FROM cosines WHERE cosine > 0.4", loc=False)
def j9(spark, d):
    pairs = vectors.cosine_pairs(table(spark, d, "embeddings"), threshold=0.4, id="vec_id", vector="embedding")
    return pairs.select("a", "b", F.round("cosine", 6).alias("cosine"))


@query(
    "g1_greedy_groups",
    _UNITS
    + ", edges AS (SELECT a, b FROM cosines WHERE cosine > 0.3)"
    + _sweep_sql("(SELECT id FROM unit)", "edges")
    + "SELECT seed, id FROM grouped",
    loc=False,
)
def g1(spark, d):
    nodes = table(spark, d, "embeddings").select(F.lit(0).alias("block"), F.col("vec_id").alias("id"), "embedding")

    def find(left, right=None):
        pairs = vectors.cosine_pairs(left, right, threshold=0.3, vector="embedding")
        return pairs.select(F.lit(0).alias("block"), "a", "b")

    return seed_members(nodes, find).select("seed", "id")


def _semantic_sql(threshold, shown):
    return f"""
    , near AS (SELECT a, b FROM cosines WHERE cosine > {threshold} UNION ALL SELECT b, a FROM cosines WHERE cosine > {threshold}
               UNION ALL SELECT id, id FROM unit),
    ordered AS MATERIALIZED (SELECT a AS id, row_number() OVER (ORDER BY a) AS pos, list(b) AS nb FROM near GROUP BY a HAVING count(*) > 1),
    sweep AS (
      SELECT CAST(0 AS BIGINT) AS step, CAST([] AS BIGINT[]) AS visited, CAST([] AS BIGINT[]) AS seeds
      UNION ALL
      SELECT step + 1,
             CASE WHEN list_contains(visited, o.id) THEN visited ELSE list_concat(visited, o.nb) END,
             CASE WHEN list_contains(visited, o.id) THEN seeds ELSE list_append(seeds, o.id) END
      FROM sweep AS s JOIN ordered AS o ON o.pos = s.step + 1)
    SELECT a AS seed, b AS id{shown} FROM near
    WHERE a IN (SELECT unnest(seeds) FROM sweep WHERE step = (SELECT max(step) FROM sweep))
    """


@query("v3_semantic_groups", _UNITS + _semantic_sql(0.33, ""), loc=False)
def v3_groups(spark, d):
    return vectors.semantic_groups(table(spark, d, "embeddings"), 0.33, "vec_id", "embedding")


@query("v3_semantic_groups_near", _TURNED + _semantic_sql(0.98, ""), loc=False)
def v3_groups_near(spark, d):
    return vectors.semantic_groups(_turned(spark, d), 0.98, "id", "v")


@query(
    "w7_rows_in_group_order",
    _TURNED + _semantic_sql(0.98, ", row_number() OVER (PARTITION BY a ORDER BY a <> b, b) - 1 AS place"),
    loc=False,
)
def w7(spark, d):
    """Each group's rows: the one that opened it, then the others."""
    return rows.in_group_order(vectors.semantic_groups(_turned(spark, d), 0.98, "id", "v"))


def _with_vectors(spark, d):
    """Locations with the vector of a row number; many rows share one."""
    embeddings = table(spark, d, "embeddings").select(F.col("vec_id").alias("_v"), "embedding")
    many = embeddings.agg(F.count("*")).scalar()
    return location_view(spark, d).withColumn("_v", F.col("row_id") % many).join(embeddings, "_v").drop("_v")


@query("v3_semantic_duplicates")
def v3(spark, d):
    found = vectors.semantic_duplicates(_with_vectors(spark, d), 0.98, vector="embedding")
    return found.drop("embedding")


@query("v3_semantic_duplicates_encoded")
def v3_encoded(spark, d):
    return vectors.semantic_duplicates(location_view(spark, d), 0.98)


@query(
    "v4_mean_similarity",
    """
    WITH unit AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
    SELECT a.id AS vec_id, round(avg(list_cosine_similarity(a.v, b.v)), 6) AS mean_similarity FROM unit AS a, unit AS b GROUP BY a.id
    """,
    loc=False,
)
def v4(spark, d):
    measured = vectors.mean_similarity(table(spark, d, "embeddings"), "embedding")
    return measured.select("vec_id", F.round("mean_similarity", 6).alias("mean_similarity"))


@query(
    "v5_semantic_outliers",
    """
    , vec AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    held AS (SELECT row_id, HIERARCHY, row_id % (SELECT count(*) FROM vec) AS id FROM loc WHERE NOT IS_GROUP),
    counted AS (SELECT id, count(*) AS n FROM held GROUP BY id),
    means AS (SELECT a.id, sum(n * list_cosine_similarity(a.v, b.v)) / sum(n) AS m FROM vec AS a, vec AS b JOIN counted ON counted.id = b.id GROUP BY a.id)
    SELECT row_id, 'outside root' AS reason FROM held WHERE HIERARCHY IS NULL OR NOT starts_with(HIERARCHY, 'ALL')
    UNION ALL SELECT row_id, 'low similarity' FROM held JOIN means USING (id) WHERE m < 0.001
    """,
)
def v5(spark, d):
    found = vectors.semantic_outliers(_with_vectors(spark, d), below=0.001, vector="embedding")
    return found.select("row_id", "reason")


@query("v5_semantic_outliers_encoded")
def v5_encoded(spark, d):
    return vectors.semantic_outliers(location_view(spark, d))


# Whole runs


def _processed(spark, d):
    reference = level_reference(spark, d).withColumn("continent_name", F.initcap("continent_name"))
    known = reference.where(F.col("continent_name").isin("Africa", "Asia")).select("country", F.col("continent_name").alias("continent"))
    return flows.process_locations(raw_view(spark, d), reference, known)


_CONTINENT_ROWS = ", ".join(f"'{c}'" for c in CONTINENTS)
# The whole repair of the raw table, with Levenshtein scores: continents, countries, parents, paths, levels, level names.
_REPAIR_SQL = """
, kept AS (SELECT * FROM raw WHERE IS_GROUP = false),
continents AS (
  SELECT row_id, CASE WHEN NAME LIKE '% %' THEN 'Middle East' ELSE upper(NAME[1]) || lower(NAME[2:]) END AS NAME,
         CODE, HIERARCHY, IS_GROUP, CHILDREN, 'CONTINENT' AS LEVEL_NAME
  FROM kept, (SELECT unnest([{continents}]) AS continent)
  WHERE LEVEL_NAME = 'REGION' AND HIERARCHY LIKE 'ALL#WORLD%' AND length(HIERARCHY) - length(replace(HIERARCHY, '#', '')) = 2
    AND {continent_score} > 90
  UNION ALL SELECT -1, 'Oceania', 'OCE', 'ALL#WORLD#OCE', false, NULL, 'CONTINENT'),
rest AS (SELECT * FROM kept WHERE CODE NOT IN (SELECT CODE FROM continents)),
named AS (SELECT * FROM rest WHERE LEVEL_NAME = 'COUNTRY'),
reference AS (
  SELECT n_code, n_name, n_nationkey, CASE WHEN r_name LIKE '% %' THEN 'Middle East' ELSE r_name[1] || lower(r_name[2:]) END AS continent
  FROM country),
alike AS (
  SELECT NAME, continent FROM (SELECT DISTINCT NAME FROM named), reference WHERE {country_score} > 80
  QUALIFY row_number() OVER (PARTITION BY NAME ORDER BY {country_score} DESC, n_nationkey) = 1),
placed AS (
  SELECT named.*, coalesce(known.continent, alike.continent, 'NOT FOUND') AS CONTINENT FROM named
  LEFT JOIN (SELECT * FROM reference WHERE continent IN ('Africa', 'Asia')) AS known ON n_name = named.NAME
  LEFT JOIN alike ON alike.NAME = named.NAME),
missing AS (SELECT * FROM placed WHERE CONTINENT NOT IN ({continents_as_written})),
countries AS (
  SELECT placed.* REPLACE (coalesce(continents.HIERARCHY, '') || '#' || placed.CODE AS HIERARCHY)
  FROM placed LEFT JOIN continents ON continents.NAME = placed.CONTINENT
  WHERE placed.CODE NOT IN (SELECT CODE FROM missing)),
lower_rows AS (
  SELECT * FROM rest WHERE CODE NOT IN (SELECT CODE FROM missing UNION ALL SELECT CODE FROM countries)),
steps AS (
  SELECT row_id, unnest(string_split(HIERARCHY, '#')) AS step, generate_subscripts(string_split(HIERARCHY, '#'), 1) AS place
  FROM lower_rows),
ancestors AS (SELECT row_id, arg_min(step, place) AS PARENT FROM steps WHERE step IN (SELECT CODE FROM countries) GROUP BY row_id),
parented AS (
  SELECT lower_rows.*, PARENT FROM lower_rows LEFT JOIN ancestors USING (row_id) WHERE PARENT IS NOT NULL OR CODE IN ('ALL', 'WORLD')),
country_paths AS (SELECT CODE AS country_code, arg_max(HIERARCHY, row_id) AS country_path FROM countries GROUP BY CODE),
rebased AS (
  SELECT parented.* REPLACE (CASE
    WHEN country_path IS NULL OR upper(coalesce(LEVEL_NAME, '')) = 'COUNTRY' THEN HIERARCHY
    WHEN HIERARCHY IS NULL THEN country_path
    WHEN list_contains(string_split(HIERARCHY, '#'), PARENT) THEN array_to_string(list_concat([country_path],
         list_slice(string_split(HIERARCHY, '#'), list_position(string_split(HIERARCHY, '#'), PARENT) + 1, 1000)), '#')
    ELSE HIERARCHY END AS HIERARCHY)
  FROM parented LEFT JOIN country_paths ON PARENT = country_code),
depths AS (
  SELECT row_id, max(length(prefix) - length(replace(prefix, '#', ''))) AS depth
  FROM rebased JOIN (SELECT DISTINCT HIERARCHY AS prefix FROM countries) ON HIERARCHY = prefix OR starts_with(HIERARCHY, prefix || '#')
  GROUP BY row_id),
merged AS (
  SELECT rebased.*, length(HIERARCHY) - length(replace(HIERARCHY, '#', '')) - depth AS LEVEL_NUMBER FROM rebased LEFT JOIN depths USING (row_id)
  UNION ALL SELECT * EXCLUDE (CONTINENT), CONTINENT, 0 FROM countries
  UNION ALL SELECT *, 'WORLD', -1 FROM continents),
merged_paths AS (SELECT CODE AS country_code, arg_max(HIERARCHY, row_id) AS country_path FROM merged WHERE LEVEL_NAME = 'COUNTRY' GROUP BY CODE),
fixed AS (
  SELECT merged.* REPLACE (
    CASE WHEN LEVEL_NAME = 'PORT_TERMINAL' AND LEVEL_NUMBER <> 1 THEN coalesce(country_path, '') || '#' || CODE ELSE HIERARCHY END AS HIERARCHY,
    CASE WHEN LEVEL_NAME = 'PORT_TERMINAL' AND LEVEL_NUMBER <> 1 THEN 1 ELSE LEVEL_NUMBER END AS LEVEL_NUMBER)
  FROM merged LEFT JOIN merged_paths ON PARENT = country_code),
level_names AS (
  SELECT n_code, 1 AS level, lower(c_mktsegment) AS word, row_number() OVER (PARTITION BY n_code ORDER BY c_mktsegment) AS place
  FROM (SELECT DISTINCT n_code, c_mktsegment FROM customer JOIN country ON c_nationkey = n_nationkey)
  UNION ALL SELECT n_code, 2, 'cities', 1 FROM country),
cases AS (
  SELECT DISTINCT PARENT, LEVEL_NAME, LEVEL_NUMBER, lower(trim(coalesce(LEVEL_NAME, 'nan'))) AS text FROM fixed
  WHERE PARENT IS NOT NULL AND lower(trim(coalesce(LEVEL_NAME, 'nan'))) NOT IN ('country', 'continent', 'all', 'world')),
level_scores AS (
  SELECT cases.*, word AS option, place, {level_score} AS score FROM cases JOIN level_names ON n_code = trim(PARENT) AND level = LEVEL_NUMBER),
official AS (
  SELECT PARENT, LEVEL_NAME, LEVEL_NUMBER,
         CASE WHEN max(score) >= 50 THEN arg_max(option, score * 1000 - place) ELSE arg_min(option, place) END AS option
  FROM level_scores GROUP BY ALL),
processed AS (
  SELECT fixed.*, coalesce(upper(option), fixed.LEVEL_NAME) AS OFFICIAL_LEVEL_NAME FROM fixed
  LEFT JOIN official ON official.PARENT = fixed.PARENT AND official.LEVEL_NUMBER = fixed.LEVEL_NUMBER
   AND official.LEVEL_NAME IS NOT DISTINCT FROM fixed.LEVEL_NAME)
""".format(
    continents=_CONTINENT_ROWS.upper(),
    continents_as_written=_CONTINENT_ROWS,
    continent_score=score_sql("continent", "NAME"),
    country_score=score_sql("NAME", "n_name"),
    level_score=score_sql("text", "word"),
)


def _processed_by_edits(spark, d):
    """The repair with Levenshtein scores, which stay in the JVM; the reference's level names are in lower case."""
    reference = level_reference(spark, d).withColumns(
        {"continent_name": F.initcap("continent_name"), "level_1": F.transform("level_1", F.lower), "level_2": F.lit("cities")}
    )
    known = reference.where(F.col("continent_name").isin("Africa", "Asia")).select("country", F.col("continent_name").alias("continent"))
    names = [c.upper() for c in CONTINENTS]
    return flows.process_locations(raw_view(spark, d), reference, known, scorer="levenshtein", level_scorer="levenshtein", names=names)


@query("flow_process_locations_levenshtein", _REPAIR_SQL + f"SELECT row_id, {', '.join(PROCESSED_COLUMNS)} FROM processed")
def flow_process_levenshtein(spark, d):
    return _processed_by_edits(spark, d).processed.select("row_id", *PROCESSED_COLUMNS)


@query("flow_location_outliers_levenshtein", _REPAIR_SQL + "SELECT raw.* FROM raw WHERE CODE NOT IN (SELECT CODE FROM merged)")
def flow_outliers_levenshtein(spark, d):
    return _processed_by_edits(spark, d).outliers


# The rows behind the exact constraints, of which each asks for all rows, over the repaired table without its roots.
_VALIDATE_SQL = (
    LOC.replace("loc AS (", "view_rows AS (")
    + _REPAIR_SQL
    + ", loc AS (SELECT * FROM processed WHERE CODE NOT IN ('ALL', 'WORLD'))"
    + ALL_PROBLEMS_SQL
)


@query("flow_validate_levenshtein", _VALIDATE_SQL, loc=False)
def flow_validate_levenshtein(spark, d):
    checks = [C.error_check(approximate=False), C.warning_check(approximate=False)]
    _, problems = flows.validate(_processed_by_edits(spark, d).processed, checks)
    return problems.select("row_id", "PROBLEM")


@query("flow_process_locations")
def flow_process(spark, d):
    return _processed(spark, d).processed


@query("flow_location_outliers")
def flow_outliers(spark, d):
    return _processed(spark, d).outliers


@query("flow_validate")
def flow_validate(spark, d):
    _, problems = flows.validate(_processed(spark, d).processed)
    return problems


@query("flow_problem_rows")
def flow_problems(spark, d):
    run = _processed(spark, d)
    return flows.problem_rows(run.processed, run.outliers)


@query("flow_compare_detectors")
def flow_compare(spark, d):
    parts = flows.compare_detectors(location_view(spark, d))
    return rows.union_ragged(*[p.select(F.lit(side).alias("side"), "CODE") for side, p in parts.items()])


@query(
    "flow_report",
    """
    SELECT count(*) AS constraints, true AS scored FROM (SELECT unnest(range(25)))
    """,
    loc=False,
)
def flow_report(spark, d):
    """Validate, score and append in one run, then once more in the same minute: one score in the history."""
    view = location_view(spark, d)
    checks = [C.error_check(approximate=False), C.warning_check(approximate=False)]
    path = f"{checkpoint_folder(spark)}/history-{uuid.uuid4().hex}"
    for _ in range(2):
        results, history = flows.report_run(spark, view, path, "2025-05-20 10:59:30", checks)
    score = results.agg(F.avg((F.col("constraint_status") == "Success").cast("double")) * 100).scalar()
    scored = history.agg((F.count("*") == 1) & (F.abs(F.max("total_score") - score) < 1e-9)).scalar()
    return results.agg(F.count("*").alias("constraints"), scored.alias("scored"))
