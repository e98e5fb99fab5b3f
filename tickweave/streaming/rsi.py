"""Outputs per closed window of a quote stream, and the RSI smoothed across them.

``ClosedWindows`` is a ``foreachBatch`` function over ``stream_window_report``,
which emits each window once, when Spark's watermark has closed it.  The only
state kept here is one row per key: the smoothed averages after the last closed
window.  State of batch ``n`` is written to ``<root>/state/smooth/batch_id=<n>``
and read back by batch ``n + 1``; a replayed batch reads the same state and
overwrites its own output, so a restart after a failure gives the same results.
States that no replay can need any more are removed.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickweave.operators.indicators import rsi_smoothed
from tickweave.operators.ranking import top_k
from tickweave.sinks.files import TEXT_OUTPUTS, batch_path, remove, write_parquet, write_window_text

#: Batches whose state is kept: a replay needs that of the batch before it.
KEPT_STATES = 2


class BatchState:
    """A state table per micro-batch below ``root``."""

    def __init__(self, root: str):
        self.root = root

    def read(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """The state that a batch left; None before the first one.  A later batch
        must find it: missing state is an error, never a fresh start."""
        if batch_id < 0:
            return None
        try:
            return spark.read.parquet(batch_path(self.root, batch_id))
        except AnalysisException as e:
            raise RuntimeError(f"the state of batch {batch_id} is missing below {self.root}; "
                               "restore it, or start again with a new checkpoint and output folder") from e

    def write(self, df: DataFrame, batch_id: int) -> DataFrame:
        """Write the state of a batch, drop the one that is no longer needed, and
        return the state as written."""
        write_parquet(df, batch_path(self.root, batch_id))
        remove(df.sparkSession, batch_path(self.root, batch_id - KEPT_STATES))
        return df.sparkSession.read.parquet(batch_path(self.root, batch_id))


class ClosedWindows:
    """``foreachBatch`` function over the closed windows of a stream.

    Results below ``root``, each with a ``batch_id`` partition column:
    ``windows`` (the rows as they come), ``top_gain`` / ``top_volume`` (the best
    key of each window), ``text`` (``(key,value)`` lines), ``smoothed`` (the RSI
    smoothed across windows) and ``carried`` (the smoothed RSI of every key as
    intervals ``valid_from`` / ``valid_to``; the last one of a key is open until
    a later batch continues it).  ``outputs`` limits the files written.
    """

    def __init__(self, root: str, key: str = "symbol", mode: str = "wilder",
                 outputs: tuple[str, ...] = ("windows", "top", "text", "smoothed")):
        self.root, self.key, self.mode, self.outputs = root.rstrip("/"), key, mode, outputs
        self.state = BatchState(f"{self.root}/state/smooth")

    def __call__(self, closed: DataFrame, batch_id: int) -> None:
        closed = closed.persist()
        tasks = []
        if "windows" in self.outputs:
            tasks.append(lambda: write_parquet(closed, batch_path(f"{self.root}/windows", batch_id)))
        if "top" in self.outputs:
            for metric, name in (("avg_gain", "top_gain"), ("total_volume", "top_volume")):
                tasks.append(lambda metric=metric, name=name: write_parquet(
                    top_k(closed, metric, 1, tie=(self.key,)), batch_path(f"{self.root}/{name}", batch_id)))
        if "text" in self.outputs:
            tasks.append(lambda: write_window_text(closed, batch_path(f"{self.root}/text", batch_id), TEXT_OUTPUTS, self.key))
        if "smoothed" in self.outputs:
            tasks.append(lambda: self._smooth(closed, batch_id))
        # The outputs share only the persisted batch: submit their jobs together.
        with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
            for done in [pool.submit(task) for task in tasks]:
                done.result()
        closed.unpersist()

    def _smooth(self, closed: DataFrame, batch_id: int) -> None:
        """Fold the closed windows into the state; write it and the intervals."""
        k, spark = self.key, closed.sparkSession
        prev = self.state.read(spark, batch_id - 1)
        if closed.isEmpty() and prev is not None:
            self.state.write(prev, batch_id)
            return
        seed = None if prev is None else prev.where(F.col("avg_gain").isNotNull())
        smoothed = rsi_smoothed(None, key=k, mode=self.mode, summaries=closed, seed=seed).persist()
        write_parquet(smoothed, batch_path(f"{self.root}/smoothed", batch_id))
        first = closed.groupBy(k).agg(F.min("window_start").alias("first_start"))
        last = smoothed.groupBy(k).agg(F.max_by(F.struct("avg_gain", "avg_loss", "rsi", "window_start"), "window_start").alias("_s"))
        new = first.join(last, k, "left").select(k, "first_start", "_s.*")
        if prev is not None:
            pick = [F.coalesce(F.col(f"n.{c}"), F.col(f"p.{c}")).alias(c) for c in ("avg_gain", "avg_loss", "rsi", "window_start")]
            new = prev.alias("p").join(new.alias("n"), k, "full").select(
                k, F.coalesce("p.first_start", "n.first_start").alias("first_start"), *pick)
        self.state.write(new, batch_id)
        write_parquet(self._carried(closed, smoothed, prev), batch_path(f"{self.root}/carried", batch_id))
        smoothed.unpersist()

    def _carried(self, closed: DataFrame, smoothed: DataFrame, prev: DataFrame | None) -> DataFrame:
        """The new intervals of the batch's keys.  A key's last value of earlier
        batches is listed again where it holds until a value of this batch, so the
        open interval of the earlier batch is superseded."""
        k = self.key
        points = smoothed.where(F.col("rsi").isNotNull()).select(k, F.col("window_start").alias("valid_from"), "rsi", F.lit(1).alias("_is"))
        known = closed.groupBy(k).agg(F.min("window_start").alias("valid_from"))
        if prev is None:
            seen = known.select(k, "valid_from", F.lit(None).cast("double").alias("rsi"), F.lit(0).alias("_is"))
        else:
            held = prev.select(k, F.when(F.col("rsi").isNull(), F.col("first_start")).otherwise(F.col("window_start")).alias("valid_from"),
                               "rsi", F.lit(0).alias("_is")).join(known.select(k), k, "left_semi")
            fresh = known.join(prev.select(k), k, "left_anti")
            seen = held.unionByName(fresh.select(k, "valid_from", F.lit(None).cast("double").alias("rsi"), F.lit(0).alias("_is")))
        rows = points.unionByName(seen).withColumn("valid_to", F.lead("valid_from").over(Window.partitionBy(k).orderBy("valid_from", "_is")))
        return rows.where(F.col("valid_to").isNull() | (F.col("valid_from") < F.col("valid_to"))).select(k, "valid_from", "valid_to", "rsi")


def read_results(spark: SparkSession, root: str, name: str) -> DataFrame:
    """All rows written so far to ``<root>/<name>``."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}").drop("batch_id")


def read_carried(spark: SparkSession, root: str, key: str = "symbol") -> DataFrame:
    """The carried values as intervals that don't overlap: of the rows with one
    start the latest batch's counts, and each ends where the next one begins."""
    rows = spark.read.parquet(f"{root.rstrip('/')}/carried")
    latest = rows.groupBy(key, "valid_from").agg(F.max_by(F.struct("rsi"), "batch_id").alias("_v"))
    following = F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from"))
    return latest.select(key, "valid_from", following.alias("valid_to"), "_v.rsi")
