"""Cumulative profit: mean close minus mean open since the start of the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickweave.functions.scalar import mean_of
from tickweave.operators.indicators import carry_forward
from tickweave.operators.windows import flatten_window, window_col
from tickweave.schema import DEFAULT_SLIDE, DEFAULT_WINDOW
from tickweave.session import cut_lineage


def _profit(sum_close: str, sum_open: str, n_close: str, n_open: str):
    """Each mean divides by the number of its own values: a NULL is not a quote at 0."""
    return (mean_of(sum_close, n_close) - mean_of(sum_open, n_open)).alias("cumulative_profit")


def _sums(close: str, open_: str):
    return [F.sum(close).alias("_sc"), F.sum(open_).alias("_so"), F.count(close).alias("_nc"), F.count(open_).alias("_no")]


def cumulative_profit(quotes: DataFrame, key: str = "symbol", close: str = "close",
                      open_: str = "open") -> DataFrame:
    """Per key over all quotes: count, mean close, mean open and their difference.

    One aggregation with map-side combine; each quote counted once.
    """
    agg = quotes.groupBy(key).agg(*_sums(close, open_), F.count(F.lit(1)).alias("n_quotes"))
    return agg.select(key, "n_quotes", mean_of("_sc", "_nc").alias("avg_close"),
                      mean_of("_so", "_no").alias("avg_open"), _profit("_sc", "_so", "_nc", "_no"))


def running_profit(quotes: DataFrame, slide: str = DEFAULT_SLIDE, key: str = "symbol", time: str = "ts",
                   close: str = "close", open_: str = "open") -> DataFrame:
    """Cumulative profit of each key at the end of every slide in which it traded.

    Quotes are summed per key and slide-long bucket first (map-side combine),
    then running sums run over the per-key bucket summaries, one row per
    bucket, so each quote enters the totals exactly once.
    """
    buckets = flatten_window(
        quotes.where(F.col(time).isNotNull())
        .groupBy(window_col(time, slide, None).alias("window"), key)
        .agg(*_sums(close, open_), F.count(F.lit(1)).alias("n_quotes")))
    w = Window.partitionBy(key).orderBy("window_start").rowsBetween(Window.unboundedPreceding, 0)
    running = buckets.select(key, "window_end", *[F.sum(c).over(w).alias(c) for c in ("_sc", "_so", "_nc", "_no", "n_quotes")])
    return running.select(key, "window_end", "n_quotes", _profit("_sc", "_so", "_nc", "_no"))


def running_profit_carried(quotes: DataFrame, slide: str = DEFAULT_SLIDE, key: str = "symbol", time: str = "ts",
                           close: str = "close", open_: str = "open") -> DataFrame:
    """``running_profit`` of every known key at the end of every slide, from its
    first slide to the last one of the data: a key that does not trade keeps its value."""
    run = running_profit(quotes, slide, key, time, close, open_)
    run = cut_lineage(run.withColumn("window_start", F.col("window_end") - F.expr(f"INTERVAL {slide}")))
    return carry_forward(run, run.select(key, "window_start"), slide, slide, key, ("n_quotes", "cumulative_profit")).select(
        key, "window_end", "n_quotes", "cumulative_profit")


def profit_parity(quotes: DataFrame, window: str = DEFAULT_WINDOW, slide: str = DEFAULT_SLIDE,
                  key: str = "symbol", time: str = "ts", close: str = "close",
                  open_: str = "open") -> DataFrame:
    """The feed's original running profit, for comparison: window sums are added
    once per sliding window (a quote is counted ``window / slide`` times) and
    each window counts ``n - 1`` quotes.  NULL while that count is 0.
    """
    per_window = flatten_window(
        quotes.where(F.col(time).isNotNull())
        .groupBy(window_col(time, window, slide).alias("window"), key)
        .agg(F.sum(close).alias("_sc"), F.sum(open_).alias("_so"), (F.count(F.lit(1)) - 1).alias("_n")))
    w = Window.partitionBy(key).orderBy("window_start").rowsBetween(Window.unboundedPreceding, 0)
    running = per_window.select(key, "window_start", "window_end", F.sum("_sc").over(w).alias("_sc"),
                                F.sum("_so").over(w).alias("_so"), F.sum("_n").over(w).alias("n_counted"))
    return running.select(key, "window_start", "window_end", "n_counted",
                          _profit("_sc", "_so", "n_counted", "n_counted"))
