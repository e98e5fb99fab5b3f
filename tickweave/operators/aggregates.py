"""Per-key sliding-window metrics (one pass, one shuffle)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickweave.functions.scalar import exact_sum, int_mean, mean_of
from tickweave.operators.windows import flatten_window, interval_micros, window_col
from tickweave.schema import DEFAULT_SLIDE, DEFAULT_WINDOW


# Above this many windows per row (window / slide), sums are first taken per
# slide-long bucket and only the bucket summaries are copied into windows.
PREAGGREGATE_RATIO = 4
#: Fixed value: the reason code of a window total beyond bigint.
VOLUME_OVERFLOW = "volume_overflow"


def window_metrics(quotes: DataFrame, window: str = DEFAULT_WINDOW, slide: str | None = DEFAULT_SLIDE,
                   key: str = "symbol", time: str = "ts", close: str = "close", open_: str = "open",
                   volume: str = "volume", preaggregate: bool | None = None, exact_volume: bool = False) -> DataFrame:
    """Simple moving average of close, average gain (close - open), total and
    integer-mean volume and the quote count per key and window.

    All metrics come from one ``groupBy``: map-side partial aggregation
    (sums and counts per key and window) shrinks the data before the single
    shuffle on ``(window, key)``.  Sums stay decimal until the final division,
    so the result is independent of partitioning and addition order.

    A sliding window copies each row ``window / slide`` times before the
    partial aggregation.  When that ratio exceeds ``PREAGGREGATE_RATIO`` (or
    ``preaggregate=True``) the sums are first taken per key and slide-long
    bucket and only those summaries are copied into the windows they lie in
    (exact when the window is a multiple of the slide).

    Volumes are summed as decimals of 38 digits: no input ends the job.  A total
    that is no bigint is NULL; ``exact_volume`` adds the exact sum and the
    ``reason`` ``volume_overflow`` of such windows.
    """
    gain = F.col(close) - F.col(open_)
    parts = [(F.count(F.lit(1)), "n_quotes"), (F.sum(close), "_sum_close"), (F.count(close), "_n_close"),
             (F.sum(gain), "_sum_gain"), (F.count(gain), "_n_gain"), (exact_sum(volume), "total_volume"),
             (F.count(volume), "_n_volume")]
    w_us = interval_micros(window)
    s_us = interval_micros(slide) if slide else w_us
    if preaggregate is None:
        preaggregate = w_us // s_us > PREAGGREGATE_RATIO
    if preaggregate and s_us < w_us and w_us % s_us == 0:
        buckets = (quotes.groupBy(F.window(time, slide).start.alias("_bucket"), F.col(key))
                   .agg(*[fn.alias(name) for fn, name in parts]))
        agg = (buckets.groupBy(window_col("_bucket", window, slide).alias("window"), F.col(key))
               .agg(*[F.sum(name).alias(name) for _, name in parts]))
    else:
        agg = (quotes.groupBy(window_col(time, window, slide).alias("window"), F.col(key))
               .agg(*[fn.alias(name) for fn, name in parts]))
    out = agg.select(
        "window", key, F.col("n_quotes").cast("bigint").alias("n_quotes"),
        mean_of("_sum_close", "_n_close").alias("sma_close"),
        mean_of("_sum_gain", "_n_gain").alias("avg_gain"),
        F.col("total_volume").try_cast("bigint").alias("total_volume"),
        int_mean("total_volume", "_n_volume").alias("int_avg_volume"),
        *([F.col("total_volume").alias("exact_volume"), volume_reason("total_volume").alias("reason")] if exact_volume else []),
    )
    return flatten_window(out)


def volume_reason(total: str) -> Column:
    """The quarantine reason of a window whose total volume is no bigint, else NULL."""
    return F.when(F.col(total).isNotNull() & F.col(total).try_cast("bigint").isNull(), F.lit(VOLUME_OVERFLOW))


def window_counts(quotes: DataFrame, window: str = DEFAULT_WINDOW, slide: str | None = DEFAULT_SLIDE,
                  time: str = "ts", fill_empty: bool = False) -> DataFrame:
    """Number of quotes per window over all keys (the feed's record count).

    With ``fill_empty`` every window between the first and the last one is
    listed, with 0 where no quote fell: the runs of ``window_count_runs``,
    expanded.
    """
    if fill_empty:
        return expand_count_runs(window_count_runs(quotes, window, slide, time), window, slide)
    return flatten_window(quotes.groupBy(window_col(time, window, slide).alias("window")).agg(F.count(F.lit(1)).alias("n_quotes")))


def window_count_runs(quotes: DataFrame, window: str = DEFAULT_WINDOW, slide: str | None = DEFAULT_SLIDE, time: str = "ts") -> DataFrame:
    """The counts of all windows from the first to the last as runs: ``window_start``
    of the run's first window, ``n_windows`` and ``n_quotes`` of each.

    A run is one window with quotes, or all empty windows up to the next one, so
    the table has at most two rows per window with quotes, however long nothing
    was traded.  One aggregation: a gap is seen from the window before it.
    """
    counts = window_counts(quotes, window, slide, time)
    step = interval_micros(slide or window)
    following = F.lead("window_start").over(Window.orderBy("window_start"))
    gap = (F.unix_micros(following.cast("timestamp")) - F.unix_micros(F.col("window_start").cast("timestamp"))) / step - 1
    seen = counts.select("window_start", "n_quotes", gap.cast("bigint").alias("_gap"))
    own = F.struct("window_start", F.lit(1).cast("bigint").alias("n_windows"), "n_quotes")
    empty = F.struct((F.col("window_start") + F.expr(f"INTERVAL {slide or window}")).alias("window_start"),
                     F.col("_gap").alias("n_windows"), F.lit(0).cast("bigint").alias("n_quotes"))
    return seen.select(F.explode(F.when(F.col("_gap") > 0, F.array(own, empty)).otherwise(F.array(own))).alias("r")).select("r.*")


def expand_count_runs(runs: DataFrame, window: str = DEFAULT_WINDOW, slide: str | None = DEFAULT_SLIDE) -> DataFrame:
    """One row per window of the runs."""
    step = F.expr(f"INTERVAL {slide or window}")
    last = F.col("window_start") + step * (F.col("n_windows") - 1).cast("int")
    each = runs.select(F.explode(F.sequence("window_start", last, step)).alias("window_start"), "n_quotes")
    return each.select("window_start", (F.col("window_start") + F.expr(f"INTERVAL {window}")).alias("window_end"), "n_quotes")
