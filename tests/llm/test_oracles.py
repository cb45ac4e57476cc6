"""Every corpus query that SQL can express equals its SQL: names, types, values."""

import os

import oracle
import pytest

from feedweave.llm.catalog import ORACLES, QUERIES

FOLDER = os.environ.get("FEEDWEAVE_TEST_DATA", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert oracle.compare(spark, FOLDER, name, QUERIES[name], ORACLES[name]) == []


def test_all_operators_are_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= names
