"""The registered queries of the text operators against their SQL."""

import pytest

from __spark_entry__ import oracle_sql, queries
from compare import connect, difference

SF = "/root/testdata/sf0.001"
NAMES = [n for n in queries() if n.startswith("op") or n == "pipeline"]


def test_all_are_registered():
    assert {n.split("_")[0] for n in NAMES} == {"pipeline", *[f"op{n}" for n in range(1, 14)]}


@pytest.mark.parametrize("name", [n for n in NAMES if n in oracle_sql()])
def test_query(spark, name):
    assert difference(spark, connect(SF), name, queries()[name], oracle_sql()[name], SF) is None
