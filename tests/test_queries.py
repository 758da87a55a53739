"""Every registered query against its SQL twin, and the driver's contract."""

import pytest

import __spark_entry__ as contract
import oracle
from smeltery.catalogue import ORACLES, QUERIES



@pytest.fixture(scope="module")
def duck(small):
    return oracle.connect(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark, small, duck):
    assert oracle.differences(QUERIES[name](spark, small), duck, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(name, spark, tiny):
    assert QUERIES[name](spark, tiny).count() > 0


def test_entry_gives_features(spark):
    frame = contract.entry(spark)
    assert frame.count() > 0
    assert "feature__zscore__entries_and_exits" in frame.columns


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.queries())
