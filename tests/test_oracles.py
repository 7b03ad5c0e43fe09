"""Every query against its SQL twin on the smallest tables."""

import check_oracles
import pytest

import __spark_entry__ as entry
import query_set

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check_oracles.connect(SF)


@pytest.mark.parametrize("name", list(query_set.QUERIES))
def test_query(spark, con, name):
    assert check_oracles.compare(spark, con, name, SF) == ""


def test_entry(spark):
    assert entry.entry(spark).count() == 150
    assert set(query_set.QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())
