from __future__ import annotations

import pytest
from compare import differences, duck

from emberwave.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, small, name):
    assert differences(queries.queries()[name](spark, small), duck(small), queries.oracle_sql()[name]) is None
