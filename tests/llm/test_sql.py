"""Every SQL twin of the training-data queries on the smallest tables."""

import check_oracles
import pytest

import __spark_entry__ as entry
from reelmeter.llm.sql import ORACLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check_oracles.connect(SF)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, con, name):
    assert check_oracles.compare(spark, con, name, SF) == ""


def test_all_are_registered():
    assert set(ORACLES) <= set(entry.oracle_sql()) and set(ORACLES) <= set(entry.queries())
