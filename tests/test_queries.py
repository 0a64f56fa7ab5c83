"""Every registered query against its SQL, on the smallest input tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_file
from compare import difference, oracle_connection
from croplake.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="input tables are not here")
ORACLES = entry_file.oracle_sql()
#: The queries of the reference's operators; those of optional packages have tests beside theirs.
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = oracle_connection(SF_DIR)
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(NAMES) <= set(ORACLES)
    assert set(NAMES) <= set(entry_file.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    df = entry_file.queries()[name](spark, SF_DIR)
    assert difference(df, duck, ORACLES[name]) is None


def test_entry_has_rows(spark):
    assert not entry_file.entry(spark).isEmpty()
