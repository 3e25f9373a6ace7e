"""Every registered query against its SQL on the smallest data set."""

import pytest

import __spark_entry__ as entry
from rostrum.plans import catalog
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
FNS, SQLS = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(FNS))
def test_query_matches_sql(spark, con, name):
    ok, note = compare(spark, con, name, FNS[name], SQLS.get(name), FOLDER)
    assert ok, note


def test_every_query_has_sql():
    assert set(FNS) == set(SQLS)


def test_entry(spark):
    df = entry.entry(spark)
    assert "stance_level_locf" in df.columns and df.count() > 0
