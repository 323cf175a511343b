"""Every registered query against its SQL on the smallest generated tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as registry
from compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(registry._library_queries()) == set(registry._library_sql())


@pytest.mark.parametrize("name", list(registry._library_queries()))
def test_query_equals_sql(spark, con, name):
    assert differences(registry._library_queries()[name](spark, SF_DIR), con, registry._library_sql()[name]) == []


def test_entry(spark):
    assert registry.entry(spark).count() > 0
