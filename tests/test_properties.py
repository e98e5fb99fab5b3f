"""Properties: results do not depend on partitioning or row order; RSI bounds;
totals agree; random inputs against brute force."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.oracle_check import compare
from tests.test_operators import T0, bars, brute_window_changes
from tickweave.operators.aggregates import window_metrics
from tickweave.operators.changes import window_changes
from tickweave.operators.indicators import rsi_smoothed, rsi_window
from tickweave.sources.decode import decode_quotes
from tickweave.sources.lines import render_quote_lines
from tickweave.sources.tables import load_quotes, with_high_low


@pytest.fixture(scope="module")
def quotes(spark):
    return load_quotes(spark, SF_SMALL, key="user_id").cache()


def shuffled(df, n):
    return df.repartition(n).orderBy(F.rand(seed=n))


@pytest.mark.parametrize("n", [1, 3, 17])
def test_results_do_not_depend_on_partitioning(spark, quotes, n):
    for fn in (lambda q: window_metrics(q, "1 day", "12 hours"),
               lambda q: rsi_window(q, "1 day", "12 hours"),
               lambda q: rsi_smoothed(q, "1 day", "12 hours").select(
                   "window_start", "symbol", F.round("rsi", 9).alias("rsi"))):
        a = fn(quotes).toPandas()
        b = fn(shuffled(quotes, n)).toPandas()
        assert len(a) > 0 and compare(a, b) is None


def test_rsi_is_within_bounds(spark, quotes):
    for df in (rsi_window(quotes, "1 day", "12 hours"), rsi_smoothed(quotes, "1 day", "12 hours")):
        bad = df.where(F.col("rsi").isNotNull() & ((F.col("rsi") < 0) | (F.col("rsi") > 100)))
        assert bad.count() == 0
        assert df.where(F.col("rsi").isNotNull()).count() > 0


def test_key_volumes_add_up_to_window_total(spark, quotes):
    m = window_metrics(quotes, "1 day", "12 hours")
    by_key = m.groupBy("window_start").agg(F.sum("total_volume").alias("v"), F.sum("n_quotes").alias("n"))
    whole = window_metrics(quotes.withColumn("symbol", F.lit("ALL")), "1 day", "12 hours").select(
        "window_start", F.col("total_volume").alias("v"), F.col("n_quotes").alias("n"))
    assert compare(by_key.toPandas(), whole.toPandas()) is None


def test_decode_does_not_depend_on_line_order(spark):
    lines = render_quote_lines(with_high_low(load_quotes(spark, SF_SMALL))).select("value")
    a = decode_quotes(lines).quotes.drop("seq").toPandas()
    b = decode_quotes(shuffled(lines, 5)).quotes.drop("seq").toPandas()
    assert len(a) == 1000 and compare(a, b) is None


bar_lists = st.lists(st.tuples(st.sampled_from("AB"), st.integers(0, 120),
                               st.decimals(min_value=Decimal("0.01"), max_value=Decimal("50"), places=2)),
                     min_size=1, max_size=40)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=bar_lists)
def test_window_changes_random_against_brute_force(spark, rows):
    data = [(s, m, i, 1, c, 1) for i, (s, m, c) in enumerate(rows)]
    got = window_changes(bars(spark, data), "20 minutes", "10 minutes", bucket="7 minutes").collect()
    want = brute_window_changes(data, 20, 10)
    assert len(got) == len(want)
    for r in got:
        start = int((r["window_start"] - T0) / dt.timedelta(minutes=1))
        n, g, l_, _ = want[(r["symbol"], start)]
        assert (r["n_bars"], r["gain"], r["loss"]) == (n, g, l_)
