"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def oracle(sf_dir):
    return check.oracle_connection(sf_dir)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_its_sql(spark, oracle, sf_dir, name):
    message, ok = check.compare(spark, oracle, sf_dir, name)
    assert ok, message


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_returns_rows(spark):
    assert entry(spark).count() > 0
