"""Whole flows and the registered queries."""

from pathwarden.plans import basic_queries, table_queries, similarity_queries  # noqa: F401
from pathwarden.plans.registry import ORACLES, QUERIES


def oracles() -> dict[str, str]:
    return dict(ORACLES)


__all__ = ["QUERIES", "oracles"]
