"""DataFrame -> DataFrame operators; every one also works on a streaming
DataFrame where Spark allows the underlying aggregation."""

from tickweave.operators.aggregates import expand_count_runs, window_count_runs, window_counts, window_metrics
from tickweave.operators.changes import bar_changes, window_changes
from tickweave.operators.indicators import (carry_forward, carry_intervals, expand_intervals, rsi_smoothed, rsi_window, values_at,
                                            window_report)
from tickweave.operators.profit import cumulative_profit, profit_parity, running_profit
from tickweave.operators.ranking import first_rows, sorted_desc, top_k
from tickweave.operators.runs import merge_runs, run_of_bars, window_runs
from tickweave.operators.scan import affine_scan
from tickweave.operators.windows import flatten_window, window_col

__all__ = [
    "affine_scan", "bar_changes", "carry_forward", "carry_intervals", "cumulative_profit", "expand_count_runs", "expand_intervals",
    "first_rows", "flatten_window", "merge_runs", "profit_parity", "rsi_smoothed", "rsi_window", "run_of_bars", "running_profit",
    "sorted_desc", "top_k", "values_at", "window_changes", "window_col", "window_count_runs", "window_counts", "window_metrics",
    "window_report", "window_runs",
]
