from __future__ import annotations

import pytest
from compare import differences, duck

import __spark_entry__
from emberwave.plans import registry

SQL = registry.oracle_sql()


def test_every_query_has_sql():
    assert set(SQL) == set(registry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, small, name):
    assert differences(registry.queries()[name](spark, small), duck(small), SQL[name]) is None


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0
