"""Every query with a SQL counterpart gives the same rows as DuckDB; the others give rows."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check_queries  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check_queries.connect(SMALL)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    assert check_queries.compare(spark, con, SMALL, name) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["customer_id", "region", "order_count", "total_amount", "spending_tier"]


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
