"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from barstats.plans.catalog import QUERIES
from barstats.plans.oracle import ORACLE
from barstats.schema import ENRICHED_COLUMNS
from oracle_check import difference, duck

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_agrees_with_its_sql(spark, con, name):
    query, sql = entry_points.queries()[name], entry_points.oracle_sql()[name]
    assert difference(query(spark, str(FOLDER)), con, sql) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry_has_the_enriched_columns(spark):
    assert entry_points.entry(spark).columns == list(ENRICHED_COLUMNS)
