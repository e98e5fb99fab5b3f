"""Bar-to-bar changes of each key, computed without one task per key.

A change is ``value[j] - value[j-1]`` for consecutive bars of a key in
``(time, *order)`` order.  The sequential part (``lag``) runs per
``(key, time bucket)``, so even a key holding a third of all rows is spread
over as many tasks as it has buckets.  Only the first two bars of a bucket
need bars of earlier buckets; they are re-lagged in a second pass over the
first and last two bars of every bucket (at most four rows per key and
bucket, however dense the data).

The changes of time windows need no such list: they are merged from runs (see
``runs``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickweave.operators.runs import DEFAULT_BUCKET, run_columns, window_runs
from tickweave.operators.windows import flatten_window
from tickweave.schema import DEFAULT_SLIDE, DEFAULT_WINDOW

_B = "_bucket"

def bar_changes(bars: DataFrame, key: str = "symbol", time: str = "ts",
                order: Sequence[str] = ("seq",), value: str = "close",
                bucket: str = DEFAULT_BUCKET, carry: Sequence[str] = ()) -> DataFrame:
    """One row per bar: ``key``, ``cur_ts``, ``prev_ts`` and ``prev2_ts`` (times
    of the two bars before it), ``value`` and ``change`` (NULL for a key's
    first bar), plus the ``carry`` columns of the bar.  Bars without a time
    are ignored.  A bar without a value has no change and is nobody's previous
    bar: changes run from value to value.

    ``bucket`` only decides how the sequential work is split; the result does
    not depend on it.
    """
    carry = [c for c in carry if c not in (key, time, value, *order)]
    base = (bars.where(F.col(time).isNotNull())
            .select(F.col(key), F.col(time).alias("cur_ts"), *[F.col(o) for o in order],
                    F.col(value).alias("value"), *[F.col(c) for c in carry],
                    F.col(value).isNull().alias("_gap"), F.window(time, bucket).start.alias(_B)))
    sort = [F.col("cur_ts"), *[F.col(o) for o in order]]
    in_bucket = Window.partitionBy(key, _B, "_gap").orderBy(*sort)
    lagged = base.select(
        "*",
        F.lag("cur_ts", 1).over(in_bucket).alias("prev_ts"),
        F.lag("cur_ts", 2).over(in_bucket).alias("prev2_ts"),
        F.lag("value", 1).over(in_bucket).alias("_pv"),
        F.row_number().over(in_bucket).alias("_rn"),
        F.lead("cur_ts", 2).over(in_bucket).isNull().alias("_tail"))
    cols = [key, "cur_ts", *order, "value", *carry, "prev_ts", "prev2_ts",
            (F.col("value") - F.col("_pv")).alias("change")]
    inner = lagged.where(F.col("_rn") >= 3).select(*cols)
    # Bucket edges: the first two bars of each bucket take their predecessors
    # from the last two bars of the key's earlier buckets.
    by_key = Window.partitionBy(key, "_gap").orderBy(*sort)
    edges = (lagged.where((F.col("_rn") <= 2) | F.col("_tail"))
             .select(key, "cur_ts", *order, "value", *carry, "_rn",
                     F.lag("cur_ts", 1).over(by_key).alias("prev_ts"),
                     F.lag("cur_ts", 2).over(by_key).alias("prev2_ts"),
                     F.lag("value", 1).over(by_key).alias("_pv"))
             .where(F.col("_rn") <= 2)
             .select(*cols))
    return inner.unionByName(edges)


def window_changes(bars: DataFrame, window: str = DEFAULT_WINDOW, slide: str | None = DEFAULT_SLIDE,
                   key: str = "symbol", time: str = "ts", order: Sequence[str] = ("seq",),
                   value: str = "close", bucket: str | None = None,
                   extra: Sequence = (), member: str | None = None) -> DataFrame:
    """Per key and window: ``n_bars``, ``n_changes`` and the sums of positive
    (``gain``) and absolute negative (``loss``) changes between consecutive
    bars inside the window (exact decimals), plus ``first_gain`` /
    ``first_loss``, the part of those sums due to the window's first change.

    They come from the runs of short time buckets, merged in time order (see
    ``runs``).  ``extra`` holds ``(bar columns, name, aggregate)`` triples
    computed in the same aggregation (see ``window_report``); the aggregates
    must be sums or counts.  With ``member`` a bar belongs to the windows that
    contain that time (say, of its arrival), while the bars of a window are
    ordered by ``time``.
    """
    runs = window_runs(bars, window, slide, key, time, order, value, bucket or DEFAULT_BUCKET, member, extra)
    return flatten_window(run_columns(runs, key, [name for _, name, _ in extra]))
