import pytest

from strata.checks import registry
from tests.oracle import DATA, differences, duck


@pytest.fixture(scope="module")
def con():
    return duck()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(name, spark, con):
    query = registry.queries()[name]
    sql = registry.oracles().get(name)
    if sql is None:
        assert query(spark, DATA).count() >= 0
        return
    assert differences(query, sql, spark, con) == []


def test_every_oracle_has_a_query():
    assert set(registry.oracles()) <= set(registry.queries())
