import importlib.util

import pytest

import __spark_entry__ as entry
from tabwarden import catalogue

from .conftest import SF
from .oracle import same


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_its_sql(spark, name):
    same(catalogue.QUERIES[name](spark, SF), catalogue.ORACLES[name], SF)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    there = importlib.util.find_spec("tabwarden.llm") is not None and importlib.util.find_spec("tabwarden.llm.queries") is not None
    assert ("pipeline" in entry.queries()) == there
