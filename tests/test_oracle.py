"""Every registered query against its SQL twin."""

import pytest
from check_queries import compare, duck

import __spark_entry__ as entry
from pagefacts import catalog


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_sql(spark, con, sf_dir, name):
    assert compare(spark, con, name, sf_dir) is None


def test_every_query_has_a_twin():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert "title" in df.columns and df.count() > 0
