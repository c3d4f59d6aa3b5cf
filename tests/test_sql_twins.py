"""Every registered query against its SQL on the smallest tables, row by row."""

import os

import pytest

import __spark_entry__ as repo
from sql_twin import mismatches

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_every_query_has_sql():
    assert set(repo.reference_sql()) == set(repo.reference_queries())


@pytest.mark.parametrize("name", sorted(repo.reference_queries()))
def test_query_equals_sql(spark, name):
    rows, only_spark, only_sql = mismatches(spark, name, SF_DIR)
    assert rows > 0
    assert (only_spark, only_sql) == (0, 0)


def test_entry(spark):
    assert repo.entry(spark).count() > 0
