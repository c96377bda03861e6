"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from parity import compare, duck
from strata.catalogue.oracle import ORACLE
from strata.catalogue.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_query_has_its_sql():
    """All of the library's own; of those on training text, the ones that SQL can express."""
    assert set(QUERIES) == set(ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_parity(spark, connection, name):
    assert compare(spark, connection, SF_DIR, name) is None


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
