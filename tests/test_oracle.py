"""Every registered quote query against its independent DuckDB SQL (exact equality).

The training-data queries are tested in ``tests/llm``: SQL can't express most of them."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SF_ORACLE
from tests.oracle_check import compare, duck
from tickweave.plans.catalog import QUERIES
from tickweave.plans.streams import STREAM_QUERIES

NAMES = sorted({**QUERIES, **STREAM_QUERIES})


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(queries())
    missing = [n for n in NAMES if n not in oracle_sql()]
    assert not missing, missing


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = queries()[name](spark, SF_ORACLE).toPandas()
    want = con.execute(oracle_sql()[name]).df()
    assert len(got) > 0
    diff = compare(got, want)
    assert diff is None, diff


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["window_start", "window_end", "symbol", "n_quotes", "sma_close", "avg_gain",
                          "total_volume", "int_avg_volume"]
    assert df.count() > 0
