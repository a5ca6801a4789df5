"""Every registered query against its SQL in an independent engine, whole results."""

import pytest

import __spark_entry__ as entry
from compare import compare, database

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF)


def test_every_query_has_sql():
    assert set(entry.REGISTERED) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.REGISTERED))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SF, name).startswith("ok")


def test_flagship(spark):
    result = entry.entry(spark)
    groups = {r[0] for r in result.select("resolution_group").distinct().collect()}
    assert result.count() > 400 and len(groups) == 5
