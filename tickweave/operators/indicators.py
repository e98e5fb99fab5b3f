"""Relative strength index: per window, smoothed across windows, carried forward."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickweave.functions.scalar import exact_sum, int_mean, mean_of, rsi
from tickweave.operators.changes import window_changes
from tickweave.operators.scan import DEFAULT_BLOCK, affine_scan, plain_value
from tickweave.operators.windows import interval_micros
from tickweave.schema import DEFAULT_SLIDE, DEFAULT_WINDOW

SMOOTHING_MODES = ("wilder", "undivided")


def rsi_window(bars: DataFrame, window: str = DEFAULT_WINDOW, slide: str | None = DEFAULT_SLIDE,
               key: str = "symbol", time: str = "ts", order: Sequence[str] = ("seq",),
               value: str = "close", min_bars: int = 2, bucket: str | None = None, member: str | None = None) -> DataFrame:
    """Stateless RSI of each key and window from the changes inside the window.

    ``rsi`` uses all changes; ``rsi_skip_first`` leaves out the window's first
    change (the feed's original indicator started one bar late).  RSI is NULL
    with fewer than ``min_bars`` bars or when no price moved.
    """
    wc = window_changes(bars, window, slide, key, time, order, value, bucket, member=member)
    enough = F.col("n_bars") >= min_bars
    return wc.select(
        "window_start", "window_end", key, "n_bars",
        F.col("gain").cast("double").alias("gain"),
        F.col("loss").cast("double").alias("loss"),
        F.when(enough, rsi("gain", "loss")).alias("rsi"),
        F.when(enough, rsi(F.col("gain") - F.col("first_gain"), F.col("loss") - F.col("first_loss")))
        .alias("rsi_skip_first"),
    )


def report_aggregates(open_: str = "open", volume: str = "volume", value: str = "close") -> list:
    """The window-metric aggregates ``window_changes(extra=...)`` adds to its
    own, as ``(bar columns they need, name, aggregate)`` triples.  All are sums
    or counts, so they can be summed again across buckets."""
    gain = F.col(value) - F.col(open_)
    return [((open_, volume), "_sum_gain", F.sum(gain)),
            ((), "_n_gain", F.count(gain)),
            ((), "_sum_close", F.sum(value)),
            ((), "_n_close", F.count(value)),
            ((), "total_volume", exact_sum(volume)),
            ((), "_n_volume", F.count(volume))]


def report_columns(wc: DataFrame, key: str = "symbol", min_bars: int = 2, extra: Sequence[str] = ()) -> DataFrame:
    """Final columns of ``window_report`` from ``window_changes`` with the report aggregates."""
    enough = F.col("n_bars") >= min_bars
    return wc.select(
        "window_start", "window_end", key, F.col("n_bars").alias("n_quotes"),
        mean_of("_sum_close", "_n_close").alias("sma_close"),
        mean_of("_sum_gain", "_n_gain").alias("avg_gain"),
        F.col("total_volume").try_cast("bigint").alias("total_volume"),
        int_mean("total_volume", "_n_volume").alias("int_avg_volume"),
        F.col("gain").cast("double").alias("gain"), F.col("loss").cast("double").alias("loss"),
        F.when(enough, rsi("gain", "loss")).alias("rsi"),
        F.when(enough, rsi(F.col("gain") - F.col("first_gain"), F.col("loss") - F.col("first_loss")))
        .alias("rsi_skip_first"), *extra)


def window_report(bars: DataFrame, window: str = DEFAULT_WINDOW, slide: str | None = DEFAULT_SLIDE,
                  key: str = "symbol", time: str = "ts", order: Sequence[str] = ("seq",),
                  close: str = "close", open_: str = "open", volume: str = "volume",
                  min_bars: int = 2, bucket: str | None = None, member: str | None = None) -> DataFrame:
    """Window metrics and window RSI of each key from one aggregation: quote
    count, moving average of close, average gain, total and integer-mean
    volume, gain/loss sums, RSI and RSI without the first change.  Equal to
    ``window_metrics`` joined with ``rsi_window``, with one shuffle instead of
    two and no join."""
    wc = window_changes(bars, window, slide, key, time, order, close, bucket,
                        report_aggregates(open_, volume, close), member)
    return report_columns(wc, key, min_bars)


def rsi_smoothed(bars: DataFrame, window: str = DEFAULT_WINDOW, slide: str | None = DEFAULT_SLIDE,
                 key: str = "symbol", time: str = "ts", order: Sequence[str] = ("seq",),
                 value: str = "close", mode: str = "wilder", bucket: str | None = None,
                 summaries: DataFrame | None = None, seed: DataFrame | None = None,
                 block: int = DEFAULT_BLOCK) -> DataFrame:
    """RSI whose average gain and loss are carried from window to window.

    For the k-th window of a key with ``L`` changes (windows with fewer than
    two bars are skipped) and gain/loss sums ``g``/``l``:

    * ``wilder``:    ``G = (G_prev * L + g) / (L + 1)``, the same for the loss;
    * ``undivided``: ``G = G_prev * L + g`` (the feed's original update, which
      lets history grow without bound: the averages become infinite, while
      the index, their ratio, stays finite; kept for comparison).

    Both start from 0, or from ``seed`` (``key, avg_gain, avg_loss``: the state
    left by earlier data, as in a stream).  The recurrence is solved with a
    parallel prefix scan over per-window summaries (``summaries`` may be passed
    precomputed, with columns ``key, window_start, window_end, n_changes,
    gain, loss``).
    """
    if mode not in SMOOTHING_MODES:
        raise ValueError(f"mode must be one of {SMOOTHING_MODES}")
    max_len = None
    if summaries is None:
        # Windows per key are bounded by the data's time span, which decides
        # the scan's rounds without computing the summaries twice.
        us = F.unix_micros(F.col(time).cast("timestamp"))
        lo, hi = bars.agg(F.min(us), F.max(us)).first()
        step_us, len_us = interval_micros(slide or window), interval_micros(window)
        max_len = 0 if lo is None else (hi - lo) // step_us + -(-len_us // step_us) + 1
    wc = summaries if summaries is not None else window_changes(
        bars, window, slide, key, time, order, value, bucket)
    L = F.col("n_changes").cast("double")
    steps = wc.where(F.col("n_changes") >= 1).select(key, "window_start", "window_end", "n_changes", "gain", "loss")
    if mode == "wilder":
        steps = steps.select("*", (L / (L + 1)).alias("_a"), (F.col("gain").cast("double") / (L + 1)).alias("avg_gain"),
                             (F.col("loss").cast("double") / (L + 1)).alias("avg_loss"))
    else:
        steps = steps.select("*", L.alias("_a"), F.col("gain").cast("double").alias("avg_gain"),
                             F.col("loss").cast("double").alias("avg_loss"))
    steps = steps.drop("gain", "loss").withColumn("_seed", F.lit(False))
    if seed is not None:
        # The seed is the constant map x -> state, placed before every window.
        ts_type = wc.schema["window_start"].dataType.simpleString()
        steps = steps.unionByName(seed.select(
            key, F.lit("0001-01-01 00:00:00").cast(ts_type).alias("window_start"),
            F.lit(None).cast(ts_type).alias("window_end"), F.lit(None).cast("bigint").alias("n_changes"),
            F.lit(0.0).alias("_a"), F.col("avg_gain").cast("double").alias("avg_gain"),
            F.col("avg_loss").cast("double").alias("avg_loss"), F.lit(True).alias("_seed")))
    scanned = affine_scan(steps, key, ["window_start"], "_a", ["avg_gain", "avg_loss"],
                          block=block, max_len=max_len, exponent="_exp").where(~F.col("_seed"))
    # The index is a ratio: it needs only the mantissas, whatever the exponent.
    return scanned.select("window_start", "window_end", key,
                          (F.col("n_changes") + 1).alias("n_bars"),
                          plain_value("avg_gain", "_exp").alias("avg_gain"), plain_value("avg_loss", "_exp").alias("avg_loss"),
                          rsi("avg_gain", "avg_loss").alias("rsi"))


def carry_intervals(values: DataFrame, present: DataFrame, key: str = "symbol", cols: Sequence[str] = ("rsi",)) -> DataFrame:
    """The known value of every key over time as intervals: ``key``, ``valid_from``,
    ``valid_to`` (the window start from which the next value holds, NULL for
    the last one) and ``cols``: a keyed state that is never dropped, in one row
    per change instead of one per key and slide.

    ``present`` lists ``key, window_start`` of the windows where a key has data
    (a key is known from its first one on, with NULL until it has a value);
    ``values`` holds ``key, window_start, *cols``.
    """
    firsts = present.groupBy(key).agg(F.min("window_start").alias("window_start")).select(
        key, "window_start", *[F.lit(None).cast(values.schema[c].dataType).alias(c) for c in cols], F.lit(0).alias("_has"))
    known = values.where(F.coalesce(*[F.col(c).cast("string") for c in cols]).isNotNull())
    points = firsts.unionByName(known.select(key, "window_start", *cols, F.lit(1).alias("_has")))
    w = Window.partitionBy(key).orderBy("window_start", "_has")
    carried = w.rowsBetween(Window.unboundedPreceding, 0)
    rows = points.select(key, F.col("window_start").alias("valid_from"), F.lead("window_start").over(w).alias("valid_to"),
                         *[F.last(c, ignorenulls=True).over(carried).alias(c) for c in cols])
    return rows.where(F.col("valid_to").isNull() | (F.col("valid_from") < F.col("valid_to")))


def values_at(intervals: DataFrame, points: DataFrame, time: str, key: str = "symbol", cols: Sequence[str] = ("rsi",)) -> DataFrame:
    """The ``points`` (``key``, ``time`` and any other columns) with the values that
    hold at their time (NULL before a key is known): one ordered pass over both."""
    none = [F.lit(None).cast(intervals.schema[c].dataType).alias(c) for c in cols]
    other = [c for c in points.columns if c not in (key, time, *cols)]
    starts = intervals.select(key, F.col("valid_from").alias(time), F.struct(*cols).alias("_v"),
                              *[F.lit(None).cast(points.schema[c].dataType).alias(c) for c in other], F.lit(0).alias("_is"))
    asked = points.select(key, F.col(time).cast(intervals.schema["valid_from"].dataType).alias(time),
                          F.when(F.lit(False), F.struct(*none)).alias("_v"), *other, F.lit(1).alias("_is"))
    w = Window.partitionBy(key).orderBy(time, "_is").rowsBetween(Window.unboundedPreceding, 0)
    found = starts.unionByName(asked).withColumn("_v", F.last("_v", ignorenulls=True).over(w)).where("_is = 1")
    return found.select(key, time, *other, *[F.col("_v")[c].alias(c) for c in cols])


def expand_intervals(intervals: DataFrame, until: Column, slide: str, window: str, key: str = "symbol",
                     cols: Sequence[str] = ("rsi",)) -> DataFrame:
    """One row per key and window of the ``slide`` grid from the key's first
    interval to the window start ``until``, generated where the interval is."""
    step = F.expr(f"INTERVAL {slide}")
    last = F.coalesce(F.col("valid_to") - step, until)
    return intervals.where(F.col("valid_from") <= last).select(
        key, F.explode(F.sequence("valid_from", last, step)).alias("window_start"), *cols).select(
        key, "window_start", (F.col("window_start") + F.expr(f"INTERVAL {window}")).alias("window_end"), *cols)


def carry_forward(values: DataFrame, present: DataFrame, slide: str, window: str,
                  key: str = "symbol", cols: Sequence[str] = ("rsi",)) -> DataFrame:
    """Every key in every slide from its first window to the last window of the
    data, with the last known value of ``cols``: the intervals of
    ``carry_intervals``, expanded.  Prefer the intervals where a single far date
    would stretch the grid.
    """
    intervals = carry_intervals(values, present, key, cols)
    last = present.agg(F.max("window_start")).first()[0]
    return expand_intervals(intervals, F.lit(last).cast(present.schema["window_start"].dataType), slide, window, key, cols)
