"""Every registered query against its SQL on the small tables."""

import os

import pytest

import __spark_entry__ as entry
from shelfmark import queries as registry
from oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables absent")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_catalogue_query_has_sql():
    assert set(registry.functions()) == set(registry.sql_texts())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(name, spark, connection):
    difference, _ = compare(entry.queries()[name](spark, SF_DIR), connection,
                            entry.oracle_sql()[name])
    assert difference is None


def test_entry_gives_rows(spark):
    frame = entry.entry(spark)
    assert frame.count() > 0 and "listing_id" in frame.columns
