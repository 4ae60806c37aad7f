"""The suite's rules: fixed names, and what each demands of a row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pathwarden.functions.paths import position_of, segment_count, segments_after

# The rules' names, which stored results carry, and the columns they are about.
COUNTRY_DEPTH = "Country-level hierarchy should have 3 #s"
LEVEL_MATCHES = "LEVEL_NUMBER matches # after PARENT"
MISSING_PARENT = "Missing HIERARCHY"
UNDER_WORLD = "Rows directly under WORLD should be CONTINENT level"
GROUP_HAS_CHILDREN = "If IS_GROUP is true then CHILDREN must not be NULL"
CHILDREN_PRESENT = "If IS_GROUP is true then CHILDREN must not be empty"



def _country_depth() -> Column:
    """A country sits four segments deep; other rows are free."""
    return (F.col("LEVEL_NAME") != "COUNTRY") | (segment_count(F.col("HIERARCHY")) == 4)


def _level_matches() -> Column:
    """Below its parent a row lies as many segments as its level number. Continents have no such number.

    A row without a place to count from (path or parent missing) is free; a parent that is not on the path
    counts from the path's start.
    """
    path, parent = F.col("HIERARCHY"), F.col("PARENT")
    below = F.coalesce(segments_after(path, parent), segment_count(path))
    return position_of(path, parent).isNull() | ((below == F.col("LEVEL_NUMBER")) & (F.col("LEVEL_NAME") != "CONTINENT"))


def _under_world() -> Column:
    """Right under WORLD stand continents only."""
    path = F.col("HIERARCHY")
    right_under = F.startswith(path, F.lit("ALL#WORLD#")) & (segment_count(path) == 3)
    return ~right_under | (F.col("LEVEL_NAME") == "CONTINENT")


# The columns each rule reads, as its constraint text names them, and the rule.
RULES: dict[str, tuple[str, Callable[[], Column]]] = {
    COUNTRY_DEPTH: ("LEVEL_NAME and HIERARCHY", _country_depth),
    LEVEL_MATCHES: ("HIERARCHY and PARENT and LEVEL_NUMBER and LEVEL_NAME", _level_matches),
    UNDER_WORLD: ("HIERARCHY and LEVEL_NAME", _under_world),
    GROUP_HAS_CHILDREN: ("IS_GROUP and CHILDREN", lambda: ~(F.col("IS_GROUP") & F.col("CHILDREN").isNull())),
    CHILDREN_PRESENT: ("CHILDREN", lambda: F.col("CHILDREN").isNotNull()),
}
RULE_COLUMNS = {
    COUNTRY_DEPTH: "HIERARCHY",
    LEVEL_MATCHES: "HIERARCHY",
    MISSING_PARENT: "HIERARCHY",
    UNDER_WORLD: "HIERARCHY",
    GROUP_HAS_CHILDREN: "IS_GROUP",
    CHILDREN_PRESENT: "IS_GROUP",
}
STRING_COLUMNS = ["NAME", "CODE", "HIERARCHY", "LEVEL_NAME", "PARENT", "OFFICIAL_LEVEL_NAME"]
COMPLETE_COLUMNS = ["NAME", "CODE", "HIERARCHY", "LEVEL_NAME", "OFFICIAL_LEVEL_NAME", "PARENT", "LEVEL_NUMBER"]
