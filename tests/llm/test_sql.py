"""Registered text queries against their SQL in DuckDB, on whole tables."""

import pytest

from tallyhouse.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import differences, duck


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, sf, name):
    assert differences(QUERIES[name](spark, sf), ORACLE_SQL[name], duck(sf)) == []
