"""Structured Streaming forms: the quote stream, window aggregations in append
mode, and the RSI smoothed across the windows as they close."""

from tickweave.streaming.feed import (latest_snapshot, quote_stream, start, start_top_k, stream_profit,
                                      stream_window_metrics)
from tickweave.streaming.rsi import ClosedWindows, read_carried, read_results
from tickweave.streaming.windows import stream_window_changes, stream_window_report

__all__ = ["ClosedWindows", "latest_snapshot", "quote_stream", "read_carried", "read_results", "start", "start_top_k",
           "stream_profit", "stream_window_changes", "stream_window_metrics", "stream_window_report"]
