"""Structured Streaming over a directory of JSON-array quote files.

The batch operators are reused unchanged where Spark's streaming aggregation
can run them (window metrics, cumulative profit); per-window rankings run on
each micro-batch of closed windows in ``foreachBatch``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickweave.operators.aggregates import window_metrics
from tickweave.operators.profit import cumulative_profit
from tickweave.operators.ranking import top_k
from tickweave.schema import DEFAULT_SLIDE, DEFAULT_WINDOW, FEED_PRICE_TYPE
from tickweave.sinks.files import per_batch_parquet
from tickweave.sources.decode import Decoded, decode_quotes
from tickweave.sources.lines import read_lines

# Fixed value of the feed: one micro-batch per minute.
FEED_TRIGGER = "60 seconds"


def quote_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                 arrival_time: bool = False, price_type: str = FEED_PRICE_TYPE, max_ahead: str | None = None) -> Decoded:
    """Decoded quotes and quarantine of a watched directory.

    ``ts`` is a TIMESTAMP (event time, usable with a watermark).  With
    ``arrival_time`` the rows also carry ``arrival_ts``, the modification time
    of the file they came from, to window by arrival as the original feed did.
    With ``max_ahead`` a quote whose time is later than its file's by more than
    that is reported and loses its time (see ``decode_quotes``).
    """
    lines = read_lines(spark, path, streaming=True, max_files_per_trigger=max_files_per_trigger,
                       arrival_time=arrival_time or bool(max_ahead))
    return decode_quotes(lines, keep=("arrival_ts",) if arrival_time else (), price_type=price_type,
                         arrival="arrival_ts" if max_ahead else None, max_ahead=max_ahead)


def stream_window_metrics(quotes: DataFrame, window: str = DEFAULT_WINDOW, slide: str = DEFAULT_SLIDE,
                          watermark: str = "10 minutes", time: str = "ts") -> DataFrame:
    """Sliding-window metrics of a quote stream (state is dropped once the
    watermark passes a window's end)."""
    return window_metrics(quotes.withWatermark(time, watermark), window, slide, time=time)


def stream_profit(quotes: DataFrame) -> DataFrame:
    """Cumulative profit per key since the start of the stream (update/complete mode)."""
    return cumulative_profit(quotes)


def start(df: DataFrame, checkpoint: str, mode: str = "append", sink: str | None = None,
          foreach_batch=None, trigger: dict | None = None, query_name: str | None = None,
          console_rows: int | None = None) -> StreamingQuery:
    """Start ``df`` with a checkpoint (required: it is what makes a restart
    resume exactly where the failed run stopped).

    ``sink`` is a parquet folder (append mode), else ``foreach_batch`` gets each
    micro-batch; ``console_rows`` prints that many rows of every micro-batch
    and ``query_name`` alone gives an in-memory table (both for demos: they
    pass results through the driver).  ``trigger`` defaults to the feed's
    60-second batches.
    """
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"processingTime": FEED_TRIGGER}))
    if query_name:
        w = w.queryName(query_name)
    if foreach_batch is not None:
        return w.foreachBatch(foreach_batch).start()
    if sink:
        return w.format("parquet").option("path", sink).start()
    if console_rows:
        return w.format("console").option("numRows", str(console_rows)).option("truncate", "false").start()
    if query_name:
        return w.format("memory").start()
    raise ValueError("give a sink folder, a foreach_batch function or a query name")


def start_top_k(metrics: DataFrame, by: str, k: int, out_root: str, checkpoint: str,
                trigger: dict | None = None) -> StreamingQuery:
    """Top ``k`` keys by ``by`` for every window as it closes.

    ``metrics`` must be a watermarked window aggregation: in append mode each
    closed window arrives once with all of its keys, so ranking the
    micro-batch is exact; results go to ``out_root/batch_id=<n>``.
    """
    return start(metrics, checkpoint, "append", trigger=trigger,
                 foreach_batch=per_batch_parquet(out_root, transform=lambda b: top_k(b, by, k)))


def latest_snapshot(spark: SparkSession, out_root: str) -> DataFrame:
    """The newest ``batch_id=<n>`` folder of a complete-mode sink."""
    df = spark.read.parquet(out_root)
    last = df.agg(F.max("batch_id")).first()[0]
    return df.where(F.col("batch_id") == last).drop("batch_id")


def latest_versions(spark: SparkSession, out_root: str, *key: str) -> DataFrame:
    """The rows of an update-mode sink with ``batch_id=<n>`` folders: of those with
    one ``key`` (NULLs are equal) the newest counts."""
    df = spark.read.parquet(out_root)
    rest = [c for c in df.columns if c not in (*key, "batch_id")]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), "batch_id").alias("_row")).select(*key, "_row.*")
