"""Every check query against its SQL on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, duck

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    assert compare(df, con, entry.oracle_sql()[name]) is None


def test_every_migration_query_has_sql():
    assert {n for s in entry.SECTIONS for n in s.queries} == {n for s in entry.SECTIONS for n in s.sql}


def test_entry_reports_changes(spark):
    df = entry.entry(spark)
    assert df.columns == ["column", "changed", "rows"]
    assert df.count() == 5
