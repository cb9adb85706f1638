import pytest

from quarry.llm import queries
from tests.oracle import answers, rows


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, sf, name):
    got = rows(queries.QUERIES[name](spark, sf))
    assert got == answers(queries.ORACLES[name], sf)
    assert got[1]
