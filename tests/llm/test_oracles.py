import pytest

from strata.llm.queries import ORACLES, QUERIES
from tests.oracle import differences, duck


@pytest.mark.parametrize("name", ["base_secrets", "base_personal_data", "base_model"])
def test_base_columns_equal_their_oracle(spark, sf_dir, name):
    assert differences(QUERIES[name], ORACLES[name], spark, duck(sf_dir), sf_dir) == []
