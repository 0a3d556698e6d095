"""Every registered query agrees with its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as registered
from suite.base import ORACLES, QUERIES
from suite.compare import difference


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_duckdb(spark, small, duck, name):
    assert difference(QUERIES[name](spark, small), duck, ORACLES[name]) is None


def test_entry_has_rows(spark):
    assert registered.entry(spark).count() > 0
