"""Every registered query against its SQL equivalent on the smallest tables."""

import os

import pytest

from oracle import compare, duck

import __spark_entry__ as entry
from orelayer.suite import ORACLES, QUERIES

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["department", "job", "hire_year", "q1", "q2", "q3", "q4"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ours = QUERIES[name](spark, SF).toArrow()
    assert compare(ours, con.sql(ORACLES[name]).to_arrow_table()) == []
