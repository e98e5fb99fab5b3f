"""Closed windows of a quote stream: chained window aggregations in append mode.

The state lives in Spark's own state store under Spark's watermark.  A first
aggregation collects the bars of short time buckets (at most ``run`` long) and,
when the watermark has passed a bucket, emits its run: an ordered, mergeable
summary (see ``operators.runs``).  A second one merges the runs of each window
and emits a window once it is closed.  Buckets tile windows of any length and
slide.  What the watermark has passed is dropped from the state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.operators.indicators import report_aggregates, report_columns
from tickweave.operators.runs import BUCKET, RUN, bucket_length, merged, run_columns, run_of_bars
from tickweave.operators.windows import flatten_window, interval_micros, window_col
from tickweave.schema import DEFAULT_SLIDE, DEFAULT_WINDOW

#: Longest time bucket whose bars are held one by one.
RUN_LENGTH = "1 minute"


def stream_window_changes(quotes: DataFrame, window: str = DEFAULT_WINDOW, slide: str | None = DEFAULT_SLIDE,
                          delay: str = "10 minutes", key: str = "symbol", time: str = "ts",
                          order: Sequence[str] = ("seq", "close"), value: str = "close", extra: Sequence = (),
                          member: str | None = None, run: str = RUN_LENGTH) -> DataFrame:
    """``window_changes`` of a stream: every closed window and key once, in append
    mode.  Quotes later than ``delay`` behind the latest one are dropped.

    With ``member`` (an arrival time) that is the axis of the windows and of the
    watermark, while the bars of a window are ordered by ``time``.
    """
    dtype = quotes.schema[value].dataType
    axis = member or time
    rows = quotes.where(F.col(time).isNotNull() & F.col(axis).isNotNull()).withWatermark(axis, delay)
    if order and order[-1] == value:
        # The value itself ends the order: once in a bar is enough.
        order = order[:-1]
    bars = F.sort_array(F.collect_list(F.struct(time, *order, F.col(value).alias("value"))))
    sums = [agg.alias(name) for _, name, agg in extra]
    names = [name for _, name, _ in extra]
    if member:
        # The runs of (window, time bucket): a window's bars come in any order of their own times.
        step = interval_micros(run)
        start = (F.floor(F.unix_micros(time) / step) * step).alias(BUCKET)
        runs = rows.groupBy(window_col(member, window, slide).alias("window"), key, start).agg(bars.alias("_bars"), *sums)
        runs = runs.select("window", key, BUCKET, run_of_bars(F.col("_bars"), dtype).alias(RUN), *names)
        groups = [F.col("window")]
    else:
        runs = rows.groupBy(window_col(time, bucket_length(window, slide, run), None).alias("_w"), key).agg(bars.alias("_bars"), *sums)
        runs = runs.select(F.window_time("_w").alias("_at"), key, F.col("_w.start").alias(BUCKET),
                           run_of_bars(F.col("_bars"), dtype).alias(RUN), *names)
        groups = [window_col("_at", window, slide).alias("window")]
    pair = F.struct(F.col(BUCKET).alias("s"), F.col(RUN).alias("r"))
    whole = runs.groupBy(*groups, key).agg(merged(F.collect_list(pair), dtype).alias(RUN), *[F.sum(n).alias(n) for n in names])
    return flatten_window(run_columns(whole, key, names))


def stream_window_report(quotes: DataFrame, window: str = DEFAULT_WINDOW, slide: str | None = DEFAULT_SLIDE,
                         delay: str = "10 minutes", key: str = "symbol", time: str = "ts",
                         order: Sequence[str] = ("seq", "close"), close: str = "close", open_: str = "open",
                         volume: str = "volume", member: str | None = None, run: str = RUN_LENGTH) -> DataFrame:
    """``window_report`` of a stream, and ``n_changes``: one row per closed window and key."""
    changes = stream_window_changes(quotes, window, slide, delay, key, time, order, close,
                                    report_aggregates(open_, volume, close), member, run)
    return report_columns(changes, key, extra=("n_changes",))
