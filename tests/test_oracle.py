"""Every registered query against its SQL check, on the smallest tables."""

from __future__ import annotations

import pytest
from compare import connect, differences

import __spark_entry__ as entry_point
from ledgerline.workload.catalog import CHECKS, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    assert differences(QUERIES[name](spark, SF_DIR), connection, CHECKS[name]) == []


def test_entry(spark):
    frame = entry_point.entry(spark)
    assert frame.columns[0] == "month" and frame.count() > 0
