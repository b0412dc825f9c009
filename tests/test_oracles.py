"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest
from compare import differences, open_tables
from conftest import FOLDER

import __spark_entry__ as entry_point

QUERIES, ORACLES = entry_point.QUERIES, entry_point.ORACLES


@pytest.fixture(scope="module")
def tables():
    return open_tables(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    assert differences(QUERIES[name](spark, FOLDER), tables, ORACLES[name]) is None


def test_registered():
    assert QUERIES.keys() <= entry_point.queries().keys()
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
