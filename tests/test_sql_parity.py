"""Every registered query against its SQL over the smallest driver tables."""

import pytest

from checks.catalog import QUERIES
from checks.compare import difference, oracle_connection
from checks.oracle import SQL

# Fitted models have no SQL; they are covered by test_modeling.
MODELS = {"random_forest_forecast", "model_selection"}


@pytest.fixture(scope="module")
def oracle(tiny_dir):
    return oracle_connection(tiny_dir)


def test_registry_is_complete():
    assert set(QUERIES) - set(SQL) == MODELS
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, tiny_dir, oracle, name):
    assert difference(QUERIES[name](spark, tiny_dir), oracle, SQL[name]) is None
