"""The training-data queries that SQL can express, against DuckDB on the whole table."""

import pytest

from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck
from tickweave.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = duck(SF_SMALL).execute(ORACLE_SQL[name]).df()
    assert len(got) > 0
    diff = compare(got, want)
    assert diff is None, diff
