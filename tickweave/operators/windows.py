"""Time windows: sliding/tumbling assignment, flattening and window grids."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.schema import DEFAULT_SLIDE, DEFAULT_WINDOW


def window_col(time: str = "ts", window: str = DEFAULT_WINDOW, slide: str | None = DEFAULT_SLIDE,
               start: str | None = None) -> Column:
    """The ``window`` struct of a row: every window of length ``window`` moved by
    ``slide`` (``slide == window`` or ``None``: tumbling) that contains ``time``.

    Windows are aligned to 1970-01-01 00:00 (plus ``start``).  A sliding window
    makes ``window / slide`` copies of each row; Catalyst fuses that expansion
    with the partial aggregation in one codegen stage.
    """
    if slide is None or slide == window:
        return F.window(time, window, startTime=start) if start else F.window(time, window)
    if start:
        return F.window(time, window, slide, start)
    return F.window(time, window, slide)


def flatten_window(df: DataFrame, name: str = "window") -> DataFrame:
    """Replace the ``window`` struct by ``window_start`` / ``window_end`` columns."""
    rest = [c for c in df.columns if c != name]
    return df.select(F.col(f"{name}.start").alias("window_start"),
                     F.col(f"{name}.end").alias("window_end"), *rest)


_UNITS = {"millisecond": 1000, "second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6, "day": 86400 * 10**6, "week": 604800 * 10**6}


def interval_micros(text: str) -> int:
    """``'10 minutes'`` -> microseconds (units: millisecond .. week)."""
    if not re.fullmatch(r"(\s*\d+\s*[a-z]+)+\s*", text.lower()):
        raise ValueError(f"cannot read interval {text!r}")
    total = 0
    for n, unit in re.findall(r"(\d+)\s*([a-z]+?)s?\b", text.lower()):
        if unit not in _UNITS:
            raise ValueError(f"unsupported interval unit in {text!r}")
        total += int(n) * _UNITS[unit]
    if not total:
        raise ValueError(f"cannot read interval {text!r}")
    return total
