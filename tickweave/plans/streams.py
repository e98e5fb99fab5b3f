"""Streaming forms of catalog queries, run to completion on a rendered feed.

Each query renders the quote feed from ``events`` as JSON-array lines in a
fresh folder under the shared checkpoint root.  The feed comes a week at a
time; the stream runs over each week until all files are processed
(``availableNow``) and is started again on its checkpoint for the next one, so
its state crosses as many micro-batches and restarts as there are weeks.

The window metrics, the top gainer and the profit cover every quote and window
of the feed, so they equal the batch queries and share their SQL: in update mode
a window is written with each week that changes it, and the last version counts.
The other window results come in append mode: the windows that the watermark has
closed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.app import LineOutputs, profit_report
from tickweave.operators.ranking import top_k
from tickweave.plans.catalog import DAY_SLIDE, DAY_WINDOW, FEED_SLIDE, FEED_WINDOW, broken_feed
from tickweave.session import checkpoint_root
from tickweave.sinks.files import per_batch_parquet
from tickweave.sources.decode import decode_quotes
from tickweave.sources.lines import read_lines, render_quote_lines
from tickweave.sources.tables import load_quotes, with_high_low
from tickweave.streaming.feed import latest_snapshot, latest_versions, quote_stream, start, stream_window_metrics
from tickweave.streaming.rsi import ClosedWindows, read_carried, read_results
from tickweave.streaming.windows import stream_window_report

ONCE = {"availableNow": True}


def _workdir(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/tickweave-streams/{name}-{uuid.uuid4().hex}"


def _weekly(spark: SparkSession, d: str, work: str, begin: Callable[[str], object]) -> None:
    """Add the feed to ``work/feed`` week by week; after each, ``begin(folder)``
    starts the stream, which ends when it has read the week.  Quotes without a time
    come in lines of their own with the first week."""
    quotes = with_high_low(load_quotes(spark, d)).withColumn("week", F.floor(F.unix_date(F.to_date("ts")) / 7))
    render_quote_lines(quotes, extra_keys=("week",)).select("week", "value").write.partitionBy("week").parquet(f"{work}/weeks")
    weeks = spark.read.parquet(f"{work}/weeks")
    span = weeks.agg(F.min("week"), F.max("week")).first()
    first, last = (0, 0) if span[0] is None else span
    for week in range(first, last + 1):
        chosen = F.col("week") == week
        if week == first:
            chosen = chosen | F.col("week").isNull()
        weeks.where(chosen).select("value").coalesce(8).write.mode("append").text(f"{work}/feed")
        begin(f"{work}/feed").awaitTermination()


def _closed(spark: SparkSession, d: str, name: str, output: str, window: str, slide: str, delay: str) -> str:
    """Run ``ClosedWindows`` with one kind of output over the weekly feed; returns its folder."""
    work = _workdir(spark, name)

    def begin(folder: str):
        report = stream_window_report(quote_stream(spark, folder).quotes, window, slide, delay)
        return start(report, f"{work}/checkpoint", "append", foreach_batch=ClosedWindows(f"{work}/out", outputs=(output,)), trigger=ONCE)

    _weekly(spark, d, work, begin)
    return f"{work}/out"


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols or ("window_start", "window_end")})


METRICS = ("window_start", "window_end", "symbol", "n_quotes", "sma_close", "avg_gain", "total_volume", "int_avg_volume")
RSI = ("window_start", "window_end", "symbol", "n_quotes AS n_bars", "gain", "loss", "rsi", "rsi_skip_first")


def _all_windows(spark: SparkSession, d: str, name: str) -> DataFrame:
    """Metrics of every window after the last week.  A week writes the windows that
    it changed, with all their quotes so far; the watermark drops only the state of
    windows that no later week reaches."""
    work = _workdir(spark, name)

    def begin(folder: str):
        metrics = stream_window_metrics(quote_stream(spark, folder).quotes, FEED_WINDOW, FEED_SLIDE, "1 day")
        return start(metrics, f"{work}/checkpoint", "update", foreach_batch=per_batch_parquet(f"{work}/out"), trigger=ONCE)

    _weekly(spark, d, work, begin)
    return _ntz(latest_versions(spark, f"{work}/out", "window_start", "window_end", "symbol")).select(*METRICS)


def q_stream_window_metrics(spark: SparkSession, d: str) -> DataFrame:
    return _all_windows(spark, d, "metrics")


def q_stream_top_gainer(spark: SparkSession, d: str) -> DataFrame:
    """Best symbol of every window."""
    best = top_k(_all_windows(spark, d, "top"), "avg_gain", 1)
    return best.select("window_start", "window_end", "rank", "symbol", "avg_gain")


def q_stream_sliding(spark: SparkSession, d: str) -> DataFrame:
    """Windows of 10 minutes moved every 4: no multiple of the slide."""
    root = _closed(spark, d, "sliding", "windows", "10 minutes", "4 minutes", "1 hour")
    return _ntz(read_results(spark, root, "windows")).select(*METRICS, "rsi")


def q_stream_rsi_window(spark: SparkSession, d: str) -> DataFrame:
    """Window RSI of the windows that the watermark (latest quote time - 12 hours) has closed."""
    root = _closed(spark, d, "rsi", "windows", DAY_WINDOW, DAY_SLIDE, "12 hours")
    return _ntz(read_results(spark, root, "windows")).selectExpr(*RSI)


def q_stream_rsi_smoothed(spark: SparkSession, d: str) -> DataFrame:
    """RSI smoothed across the closed windows by keyed state."""
    root = _closed(spark, d, "rsi-smoothed", "smoothed", DAY_WINDOW, DAY_SLIDE, "12 hours")
    return _ntz(read_results(spark, root, "smoothed")).select("window_start", "window_end", "symbol", "n_bars", F.round("rsi", 6).alias("rsi"))


def q_stream_carried(spark: SparkSession, d: str) -> DataFrame:
    """The smoothed RSI of every known symbol as intervals of validity."""
    root = _closed(spark, d, "carried", "smoothed", DAY_WINDOW, DAY_SLIDE, "12 hours")
    return _ntz(read_carried(spark, root), "valid_from", "valid_to").withColumn("rsi", F.round("rsi", 6))


def _arrival_feed(spark: SparkSession, d: str, work: str) -> DataFrame:
    """A stream of lines with the time of their arrival: those of a block of 64
    quotes arrive a minute after those of the block before, in an order that has
    nothing to do with the times of the quotes."""
    lines = render_quote_lines(with_high_low(load_quotes(spark, d)))
    block = F.floor(F.col("first_seq") / 64)
    at = F.timestamp_seconds(F.lit(1_710_000_000) + block * 60)
    lines = lines.select("value", at.alias("arrival_ts"), F.floor(block * 64 / F.lit(1024)).alias("part"))
    lines.write.parquet(f"{work}/staged")
    staged = spark.read.parquet(f"{work}/staged")
    span = staged.agg(F.min("part"), F.max("part")).first()
    step = -(-(span[1] - span[0] + 1) // 4)
    for low in range(span[0], span[1] + 1, step):
        # One file after the other, in the order of arrival: a micro-batch each.
        staged.where(F.col("part").between(low, low + step - 1)).select("value", "arrival_ts").coalesce(1).write.mode("append").parquet(f"{work}/feed")
    return spark.readStream.schema("value string, arrival_ts timestamp").option("maxFilesPerTrigger", "1").parquet(f"{work}/feed")


def _arrival_report(spark: SparkSession, d: str, name: str) -> DataFrame:
    work = _workdir(spark, name)
    quotes = decode_quotes(_arrival_feed(spark, d, work), keep=("arrival_ts",)).quotes
    report = stream_window_report(quotes, FEED_WINDOW, FEED_SLIDE, "2 minutes", member="arrival_ts")
    start(report, f"{work}/checkpoint", "append", sink=f"{work}/out", trigger=ONCE).awaitTermination()
    return _ntz(spark.read.parquet(f"{work}/out"))


def q_stream_arrival_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Window metrics by the time of arrival."""
    return _arrival_report(spark, d, "arrival-metrics").select(*METRICS)


def q_stream_arrival_rsi(spark: SparkSession, d: str) -> DataFrame:
    """RSI of the quotes that arrived in a window, in the order of their own times."""
    return _arrival_report(spark, d, "arrival-rsi").selectExpr(*RSI)


def q_stream_profit(spark: SparkSession, d: str) -> DataFrame:
    """Mean prices and cumulative profit after the last week, from the state of the weeks before."""
    work = _workdir(spark, "profit")

    def begin(folder: str):
        lines = read_lines(spark, folder, streaming=True, arrival_time=True)
        return start(lines, f"{work}/checkpoint", "append", foreach_batch=LineOutputs(f"{work}/out"), trigger=ONCE)

    _weekly(spark, d, work, begin)
    return profit_report(latest_snapshot(spark, f"{work}/out/state/profit"))


def q_stream_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Quarantine of a streamed feed that holds good, cut-short and non-array lines."""
    work = _workdir(spark, "quarantine")
    broken_feed(spark, d).write.text(f"{work}/feed")
    bad = quote_stream(spark, f"{work}/feed", max_files_per_trigger=4).quarantine
    out = f"{work}/out"
    start(bad, f"{work}/checkpoint", "append", sink=out, trigger=ONCE).awaitTermination()
    return spark.read.parquet(out).select("line", "reason")


STREAM_QUERIES = {name: fn for name, fn in globals().items() if name.startswith("q_stream_") and callable(fn)}
#: Streaming queries whose result is that of a batch query.
STREAM_ORACLE = {"q_stream_window_metrics": "q_window_metrics", "q_stream_top_gainer": "q_top_gainer",
                 "q_stream_profit": "q_profit", "q_stream_quarantine": "q_json_quarantine"}
