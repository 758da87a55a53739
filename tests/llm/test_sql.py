"""Queries against their SQL twins, whole results."""

import oracle
import pytest

from smeltery.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark, small):
    assert oracle.differences(QUERIES[name](spark, small), oracle.connect(small), ORACLES[name]) == []
