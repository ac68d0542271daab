import pytest

import __spark_entry__ as entry
from tabwarden.llm import queries

from ..conftest import SF
from ..oracle import same


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    same(queries.QUERIES[name](spark, SF), queries.ORACLES[name], SF)


def test_all_operators_and_the_pipeline_are_registered():
    names = [n.split("_")[0] for n in entry.queries() if n.startswith("op")]
    assert sorted(names) == sorted(f"op{k}" for k in range(1, 14)) and "pipeline" in entry.queries()
