"""File sinks for window results.

Every writer here is idempotent: a micro-batch that is replayed after a
failure overwrites its own ``batch_id=<n>`` folder instead of appending a
second copy, so results survive executor or driver loss without duplicates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def batch_path(root: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/batch_id={batch_id}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on the file system that it is on, if it is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def pair_lines(df: DataFrame, key: str, value: str, *keep: str) -> DataFrame:
    """``(key,value)`` text lines, the feed's text output format, and the columns ``keep``."""
    return df.select(*keep, F.format_string("(%s,%s)", F.col(key), F.col(value).cast("string")).alias("value"))


def write_pair_text(df: DataFrame, path: str, key: str, value: str) -> None:
    pair_lines(df, key, value).write.mode("overwrite").text(path)


#: Fixed value: the four text outputs of the feed, as columns of the window report.
TEXT_OUTPUTS = ("sma_close", "avg_gain", "total_volume", "rsi")
#: Fixed form of a window's start before each line of the text outputs.
WINDOW_TEXT = "yyyyMMddHHmmss"


def write_window_text(report: DataFrame, root: str, outputs: tuple[str, ...], key: str = "symbol") -> None:
    """Lines ``<window start> (key,value)`` of each output column, in
    ``root/output=<name>``; all outputs from one pass over ``report``.  A NULL
    value is not written.

    The number of files follows the amount of text, not the number of windows:
    lines are rebalanced by output, so a task writes one file per output, small
    outputs share few tasks and a large one is split.
    """
    values = F.explode(F.array(*(F.struct(F.lit(o).alias("output"), F.col(o).cast("string").alias("text")) for o in outputs)))
    rows = report.select(key, F.date_format("window_start", WINDOW_TEXT).alias("window"), values.alias("v"))
    pairs = pair_lines(rows.where("v.text IS NOT NULL").select(key, "window", "v.*"), key, "text", "output", "window")
    lines = pairs.select("output", F.concat_ws(" ", "window", "value").alias("value"))
    lines.hint("rebalance", "output").write.mode("overwrite").partitionBy("output").text(root)


def read_window_text(spark: SparkSession, root: str) -> DataFrame:
    """The lines of ``write_window_text`` as ``output``, ``window_start``, ``symbol`` and ``value`` (double)."""
    line = r"^([0-9]+) \((.*),([^,]*)\)$"
    lines = spark.read.text(root)
    return lines.select("output", F.to_timestamp(F.regexp_extract("value", line, 1), WINDOW_TEXT).alias("window_start"),
                        F.regexp_extract("value", line, 2).alias("symbol"),
                        F.regexp_extract("value", line, 3).cast("double").alias("value"))


def per_batch_parquet(root: str, partition_by: tuple[str, ...] = (),
                      transform: Callable[[DataFrame], DataFrame] | None = None):
    """``foreachBatch`` function writing each micro-batch (optionally transformed,
    e.g. ranked) to ``root/batch_id=<n>``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch) if transform else batch
        write_parquet(out, batch_path(root, batch_id), partition_by)
    return run


def per_batch_text(root: str, key: str, value: str,
                   transform: Callable[[DataFrame], DataFrame] | None = None):
    """``foreachBatch`` function writing ``(key,value)`` lines per micro-batch."""
    def run(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch) if transform else batch
        write_pair_text(out, batch_path(root, batch_id), key, value)
    return run
