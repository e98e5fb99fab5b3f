"""Session helpers: a tuned SparkSession and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job of this library relies on.  Timestamps are compared as
# wall-clock values, so the session zone is pinned; AQE re-plans shuffles at
# run time (partition coalescing, skew splits).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tickweave", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster pass ``master=None`` and let ``spark-submit`` decide; size
    ``shuffle_partitions`` to the data (about 128-256 MB of shuffle output per
    partition), AQE coalesces the excess.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only a local session without the
    setting (tests) gets a fresh private folder; a cluster session without it
    is an error, because a machine-local folder does not survive executor loss.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current and sc.master.startswith("local"):
        # Core settings cannot change on a running session; register the
        # folder with the context instead (it adds a unique sub-folder).
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tickweave-ckpt-"))
        current = sc.getCheckpointDir()
    if current:
        return os.path.dirname(current.rstrip("/"))
    raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` usable and return the folder it writes to."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    sc.setCheckpointDir(checkpoint_root(spark))
    return sc.getCheckpointDir()


def cut_lineage(df):
    """Write ``df`` to the shared checkpoint folder and continue from the copy.

    Used at the boundary after an expensive reduction (e.g. per-window
    summaries), so later steps and retries after a lost executor start from
    the written result instead of recomputing from the raw data.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
