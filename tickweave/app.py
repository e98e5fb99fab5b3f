"""The quote feed application: watch a directory, publish per-window results.

``python -m tickweave.app <input_dir> <output_dir> [window] [slide] [delay]
[--arrival] [--files-per-trigger N] [--price-type TYPE] [--max-ahead INTERVAL]``

Two streaming queries read the folder, each with a checkpoint of its own.  The
first decodes the lines and, per closed window and symbol (Spark's watermark,
append mode; see ``streaming.windows``), writes under ``output_dir``:

* ``windows``     quote count, moving average of close, average gain, total and
                  integer-mean volume, RSI and RSI without the first change;
* ``top_gain`` / ``top_volume``  the best symbol of each closed window;
* ``text``        ``<window start> (symbol,value)`` lines of the average, gain, volume
                  and RSI of each closed window (``output=<name>``);
* ``smoothed``    RSI smoothed across windows;
* ``carried``     the smoothed RSI of every symbol as intervals of validity.

The second writes per micro-batch (one per minute by default):

* ``quarantine``  lines, elements and fields that could not be used, with the reason;
* ``profit``      cumulative profit (mean close - mean open) per symbol since
                  the start, in descending order; ``top_profit`` its best symbol.
                  Every decoded quote counts here, also one that comes too late
                  for its window.

With ``--arrival`` a quote belongs to the windows of the time at which its file
arrived (its modification time), the quotes of a window still being ordered by
their own times.  Quotes whose time is later than their file's by more than
``--max-ahead`` (one day) are reported and have no time.

All outputs are partitioned by ``batch_id`` and rewritten whole when a batch
is replayed after a failure; state lives under ``output_dir/state`` and the
progress of the queries under ``output_dir/_checkpoint``.
"""

from __future__ import annotations

import argparse
import sys
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickweave.functions.scalar import mean_of
from tickweave.operators.ranking import sorted_desc, top_k
from tickweave.schema import DEFAULT_SLIDE, DEFAULT_WINDOW, FEED_PRICE_TYPE
from tickweave.sinks.files import batch_path, write_parquet
from tickweave.sources.decode import decode_quotes
from tickweave.sources.lines import read_lines
from tickweave.streaming.feed import FEED_TRIGGER, quote_stream
from tickweave.streaming.rsi import BatchState, ClosedWindows
from tickweave.streaming.windows import stream_window_report

MAX_AHEAD = "1 day"


def profit_report(state: DataFrame) -> DataFrame:
    """``cumulative_profit`` from the per-symbol sums that ``LineOutputs`` keeps."""
    close, open_ = mean_of("sum_close", "n_close"), mean_of("sum_open", "n_open")
    return state.select("symbol", "n_quotes", close.alias("avg_close"), open_.alias("avg_open"), (close - open_).alias("cumulative_profit"))


class LineOutputs:
    """``foreachBatch`` function over raw text lines (columns ``value`` and
    ``arrival_ts``): quarantine and cumulative profit."""

    def __init__(self, root: str, price_type: str = FEED_PRICE_TYPE, max_ahead: str | None = MAX_AHEAD):
        self.root, self.price_type, self.max_ahead = root, price_type, max_ahead
        self.state = BatchState(f"{root}/state/profit")

    def __call__(self, lines: DataFrame, batch_id: int) -> None:
        lines = lines.persist()
        decoded = decode_quotes(lines, price_type=self.price_type, arrival="arrival_ts", max_ahead=self.max_ahead)
        with ThreadPoolExecutor(max_workers=2) as pool:
            tasks = [pool.submit(write_parquet, decoded.quarantine, batch_path(f"{self.root}/quarantine", batch_id)),
                     pool.submit(self._profit, decoded.quotes, batch_id)]
            for task in tasks:
                task.result()
        lines.unpersist()

    def _profit(self, quotes: DataFrame, batch_id: int) -> None:
        """Running per-symbol sums (each quote once) and the profit ranking."""
        add = quotes.groupBy("symbol").agg(F.sum("close").alias("sum_close"), F.sum("open").alias("sum_open"),
                                            F.count("close").alias("n_close"), F.count("open").alias("n_open"),
                                            F.count(F.lit(1)).alias("n_quotes"))
        prev = self.state.read(quotes.sparkSession, batch_id - 1)
        if prev is not None:
            add = prev.unionByName(add).groupBy("symbol").agg(
                F.sum("sum_close").alias("sum_close"), F.sum("sum_open").alias("sum_open"),
                *(F.sum(c).alias(c) for c in ("n_close", "n_open", "n_quotes")))
        # The scale of the prices stays; sums have 38 digits.
        scale = next(f.dataType.scale for f in quotes.schema if f.name == "close")
        sums = [F.col(c).cast(f"decimal(38,{scale})").alias(c) for c in ("sum_close", "sum_open")]
        state = self.state.write(add.select("symbol", *sums, "n_close", "n_open", "n_quotes"), batch_id)
        profit = profit_report(state).select("symbol", "n_quotes", "cumulative_profit")
        write_parquet(sorted_desc(profit, "cumulative_profit"), batch_path(f"{self.root}/profit", batch_id))
        write_parquet(top_k(profit, "cumulative_profit", 1, per=()), batch_path(f"{self.root}/top_profit", batch_id))


class Feed:
    """The running queries of a feed."""

    def __init__(self, windows: StreamingQuery, lines: StreamingQuery):
        self.windows, self.lines = windows, lines

    def awaitTermination(self) -> None:
        """Until both have ended; if one fails the other is stopped and the error raised."""
        try:
            while self.windows.isActive or self.lines.isActive:
                for query in (self.windows, self.lines):
                    query.awaitTermination(1)
            for query in (self.windows, self.lines):
                query.awaitTermination()
        except BaseException:
            self.stop()
            raise

    def stop(self) -> None:
        for query in (self.windows, self.lines):
            query.stop()


def run_feed(spark: SparkSession, input_dir: str, output_dir: str, window: str = DEFAULT_WINDOW,
             slide: str = DEFAULT_SLIDE, delay: str = "10 minutes", trigger: dict | None = None,
             max_files_per_trigger: int | None = None, arrival: bool = False, price_type: str = FEED_PRICE_TYPE,
             max_ahead: str | None = MAX_AHEAD, mode: str = "wilder") -> Feed:
    """Start the feed on ``input_dir``; returns the running queries."""
    out = output_dir.rstrip("/")
    trigger = trigger or {"processingTime": FEED_TRIGGER}
    quotes = quote_stream(spark, input_dir, max_files_per_trigger, arrival, price_type, max_ahead).quotes
    report = stream_window_report(quotes, window, slide, delay, member="arrival_ts" if arrival else None)
    windows = (report.writeStream.outputMode("append").option("checkpointLocation", f"{out}/_checkpoint/windows")
               .trigger(**trigger).foreachBatch(ClosedWindows(out, mode=mode)).start())
    lines = read_lines(spark, input_dir, streaming=True, max_files_per_trigger=max_files_per_trigger, arrival_time=True)
    rest = (lines.writeStream.option("checkpointLocation", f"{out}/_checkpoint/lines")
            .trigger(**trigger).foreachBatch(LineOutputs(out, price_type, max_ahead)).start())
    return Feed(windows, rest)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="python -m tickweave.app", exit_on_error=False)
    parser.add_argument("input_dir")
    parser.add_argument("output_dir")
    parser.add_argument("window", nargs="?", default=DEFAULT_WINDOW)
    parser.add_argument("slide", nargs="?", default=DEFAULT_SLIDE)
    parser.add_argument("delay", nargs="?", default="10 minutes")
    parser.add_argument("--arrival", action="store_true")
    parser.add_argument("--files-per-trigger", type=int)
    parser.add_argument("--price-type", default=FEED_PRICE_TYPE)
    parser.add_argument("--max-ahead", default=MAX_AHEAD)
    try:
        args = parser.parse_args(sys.argv[1:] if argv is None else argv)
    except (argparse.ArgumentError, SystemExit):
        parser.print_usage(sys.stderr)
        return 1
    from tickweave.session import build_session

    run_feed(build_session(), args.input_dir, args.output_dir, args.window, args.slide, args.delay,
             max_files_per_trigger=args.files_per_trigger, arrival=args.arrival, price_type=args.price_type,
             max_ahead=args.max_ahead).awaitTermination()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
