"""tickweave: time-ordered quote analytics as Spark DataFrame operators.

Batch and Structured Streaming forms of per-key sliding-window metrics,
rankings, relative strength indices and cumulative profit, fed from parquet
tables or directories of JSON-array text lines.
"""

__version__ = "0.1.0"
