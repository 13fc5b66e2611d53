"""Every registered query against its SQL, on the smallest supplied tables."""

import os

import pytest

from checks.compare import compare
from checks.queries import QUERIES
from checks.sql import ORACLE

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="supplied tables are not here")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    verdict = compare(spark, SF_DIR, QUERIES[name], ORACLE.get(name))
    assert verdict.startswith("ok"), verdict


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


def test_entry_point(spark):
    import __spark_entry__ as entry_point
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(QUERIES) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())
    assert entry_point.entry(spark).count() == 5
