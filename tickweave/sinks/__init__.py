"""Idempotent per-batch file sinks (parquet and ``(key,value)`` text)."""

from tickweave.sinks.files import (batch_path, pair_lines, per_batch_parquet, per_batch_text, write_pair_text,
                                   write_parquet)

__all__ = ["batch_path", "pair_lines", "per_batch_parquet", "per_batch_text", "write_pair_text", "write_parquet"]
