"""Every registered question equals its DuckDB oracle on sf0.01 (the driver's gate)."""

import pytest

from tests.conftest import SF_ORACLE
from tests.oracle_compare import compare
from tillroll.plans.registry import QUESTIONS


@pytest.mark.parametrize("key", list(QUESTIONS))
def test_matches_oracle(spark, key):
    res = compare(spark, SF_ORACLE, [key], verbose=False)[key]
    assert res["ok"], res["problems"]
