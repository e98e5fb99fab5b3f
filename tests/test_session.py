"""Checkpoint folder: the session's setting wins; a local session without one gets a private folder."""

import os
import subprocess
import sys
import tempfile

from tickweave.session import checkpoint_root, ensure_checkpoint_dir

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from tickweave.session import checkpoint_root, cut_lineage
assert spark.sparkContext.getConf().get("spark.checkpoint.dir", None) is None
root = checkpoint_root(spark)
assert "tickweave-ckpt-" in root, root
assert cut_lineage(spark.range(7)).count() == 7
print("OK", root)
"""


def test_session_setting_is_used(spark):
    root = checkpoint_root(spark)
    assert root
    assert ensure_checkpoint_dir(spark)


def test_local_session_without_setting_gets_private_folder():
    conf_dir = tempfile.mkdtemp(prefix="tickweave-emptyconf-")
    env = dict(os.environ, SPARK_CONF_DIR=conf_dir)
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT)], env=env, capture_output=True,
                         text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "OK" in out.stdout


def test_queries_are_listed_without_a_session():
    """The entry module is imported before any session exists."""
    import subprocess
    import sys

    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert q and set(o) <= set(q)"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
