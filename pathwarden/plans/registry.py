"""The registered queries and, where SQL can express them, the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The location view of sources/location_view.py, in SQL.
LOC = """
WITH RECURSIVE parts AS (SELECT count(*) AS n FROM part),
country AS (
  SELECT n_nationkey, n_name, r_name, 'N' || n_nationkey AS n_code,
         'ALL#WORLD#R' || r_regionkey || '#N' || n_nationkey AS n_path
  FROM nation JOIN region ON n_regionkey = r_regionkey),
city AS (
  SELECT c_custkey AS k, p_name, n_code, n_path, c_mktsegment,
         CASE WHEN c_custkey > 0 AND c_custkey % 73 = 0 THEN 'C' || (c_custkey - 1) ELSE 'C' || c_custkey END AS code
  FROM customer JOIN country ON c_nationkey = n_nationkey
  JOIN part ON p_partkey = c_custkey % (SELECT n FROM parts)),
base AS (
  SELECT 0 AS row_id, 'ALL' AS NAME, 'ALL' AS CODE, 'ALL' AS HIERARCHY, false AS IS_GROUP,
         CAST(NULL AS VARCHAR) AS CHILDREN, CAST(NULL AS VARCHAR) AS LEVEL_NAME,
         CAST(NULL AS VARCHAR) AS PARENT, CAST(NULL AS INTEGER) AS LEVEL_NUMBER
  UNION ALL SELECT 1, 'WORLD', 'WORLD', 'ALL#WORLD', false, NULL, NULL, NULL, NULL
  UNION ALL SELECT r_regionkey + 10, r_name, 'R' || r_regionkey, 'ALL#WORLD#R' || r_regionkey, false, NULL,
         'CONTINENT', 'WORLD', -1 FROM region
  UNION ALL SELECT n_nationkey + 100, n_name, n_code,
         CASE WHEN n_nationkey = 24 THEN 'ALL#WORLD#N24' ELSE n_path END, false, NULL, 'COUNTRY', r_name, 0 FROM country
  UNION ALL SELECT n_nationkey * 10 + 1000 + list_position(
         ['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'], c_mktsegment),
         c_mktsegment, n_code || '_' || c_mktsegment, n_path || '#' || n_code || '_' || c_mktsegment, false, NULL,
         'REGION', n_code, 1
  FROM (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer) JOIN country ON c_nationkey = n_nationkey
  WHERE n_nationkey % 7 <> 0
  UNION ALL SELECT k * 2 + 10000, p_name, code,
         CASE WHEN k > 0 AND k % 67 = 0 THEN 'BAD_' || code WHEN k > 0 AND k % 83 = 0 THEN NULL
              ELSE n_path || '#' || n_code || '_' || c_mktsegment || '#C' || k END,
         k > 0 AND k % 79 = 0,
         CASE WHEN k > 0 AND k % 79 = 0 THEN CASE k % 3 WHEN 0 THEN '[]' WHEN 2 THEN '["X"]' END END,
         CASE WHEN k > 0 AND k % 71 = 0 THEN 'COUNTRY' ELSE 'CITY' END,
         CASE WHEN k > 0 AND k % 89 = 0 THEN NULL ELSE n_code END,
         CASE WHEN k > 0 AND k % 97 = 0 THEN 3 ELSE 2 END FROM city
  UNION ALL SELECT s_suppkey * 2 + 10001, p_name, 'S' || s_suppkey, n_path || '#S' || s_suppkey, false, NULL,
         'PORT_TERMINAL', n_code, 1
  FROM supplier JOIN country ON s_nationkey = n_nationkey
  JOIN part ON p_partkey = s_suppkey % (SELECT n FROM parts)),
loc AS (SELECT *, LEVEL_NAME AS OFFICIAL_LEVEL_NAME FROM base),
raw AS (SELECT row_id, NAME, CODE, HIERARCHY, IS_GROUP, CHILDREN,
               CASE WHEN LEVEL_NAME = 'CONTINENT' THEN 'REGION' ELSE LEVEL_NAME END AS LEVEL_NAME FROM base)
"""


def query(name: str, sql: str | None = None, loc: bool = True) -> Callable[[Query], Query]:
    """Register a query; `loc` puts the location view in front of its SQL.

    The SQL may begin with more common table expressions, after a comma.
    """

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            text = sql.strip()
            ORACLES[name] = f"{LOC}{text}" if loc else text
        return function

    return register
