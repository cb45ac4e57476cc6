"""Every registered query equals its SQL counterpart: names, types, values."""

import os

import pytest

import oracle
from feedweave.catalog import ORACLES, QUERIES

FOLDER = os.environ.get("FEEDWEAVE_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert oracle.compare(spark, FOLDER, name, QUERIES[name], ORACLES[name], con) == []


def test_entry_returns_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
