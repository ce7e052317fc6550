"""The queries that SQL can express, against DuckDB."""

import pytest
from cartwheel.llm import registry
from cartwheel.plans.verify import compare
from conftest import SMALL


@pytest.mark.parametrize("name", sorted(registry.all_sql()))
def test_matches_sql(spark, duck, name):
    r = compare(registry.all_queries()[name](spark, SMALL), registry.all_sql()[name], SMALL, duck)
    assert r["match"], r
