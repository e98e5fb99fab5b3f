"""Ordered runs: mergeable summaries of a key's bars in time order.

A run stands for consecutive bars of a key: how many there are (``n``) and how
many have a value (``nv``), the first and the last value, the sums of positive
(``gain``) and absolute negative (``loss``) changes from value to value, and the
first change.  Two runs that follow each other merge into one: the only change
that neither knows is the one from the last value of the earlier run to the
first value of the later one.  So a window's changes come from the runs of
short time buckets, in the order of the buckets, however the bars were spread
over tasks, files or micro-batches; a bucket that arrives late merges like any
other.

Membership and order may be two axes.  By default a bar belongs to the windows
that contain its own time.  With ``member`` (say, an arrival time) it belongs to
the windows that contain that, while the bars of a window are still ordered by
their own time: the runs are then those of (window, time bucket).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tickweave.functions.scalar import bound
from tickweave.operators.windows import interval_micros, window_col

# Width of the time buckets that split each key's ordered work.  It changes no
# result; it bounds a task to five minutes of one key's bars, so a key holding a
# third of all rows still spreads over many tasks.
DEFAULT_BUCKET = "5 minutes"
BUCKET = "_bucket"
RUN = "_run"


def amount_type(value_type: T.DataType) -> str:
    """The type of a run's sums: exact for decimals (a sum of two has a digit to spare)."""
    return f"decimal(36,{value_type.scale})" if isinstance(value_type, T.DecimalType) else "double"


def run_type(value_type: T.DataType) -> str:
    v, s = value_type.simpleString(), amount_type(value_type)
    return f"struct<n:bigint,nv:bigint,first:{v},last:{v},gain:{s},loss:{s},first_change:{s}>"


def empty_run(value_type: T.DataType) -> Column:
    return F.lit(None).cast(run_type(value_type))


def _split(change: Column, amount: str) -> tuple[Column, Column]:
    """A change as gain and loss; NULL counts as none."""
    zero = F.lit(0).cast(amount)
    return F.when(change > 0, change).otherwise(zero).cast(amount), F.when(change < 0, -change).otherwise(zero).cast(amount)


def merge_runs(a: Column, b: Column, value_type: T.DataType) -> Column:
    """The run of ``a`` followed by ``b``; a NULL run is empty."""
    amount = amount_type(value_type)
    step = (b["first"] - a["last"]).cast(amount)
    gain, loss = _split(step, amount)
    both = F.struct(
        (a["n"] + b["n"]).alias("n"), (a["nv"] + b["nv"]).alias("nv"),
        F.coalesce(a["first"], b["first"]).alias("first"), F.coalesce(b["last"], a["last"]).alias("last"),
        (a["gain"] + b["gain"] + gain).cast(amount).alias("gain"), (a["loss"] + b["loss"] + loss).cast(amount).alias("loss"),
        F.when(a["nv"] == 0, b["first_change"]).when(a["nv"] == 1, step).otherwise(a["first_change"]).alias("first_change"))
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(both.cast(run_type(value_type)))


def run_of_bars(bars: Column, value_type: T.DataType) -> Column:
    """The run of an array of structs with ``value``, in order (NULL for an empty array).

    The changes are taken from one array of the values: folding the bars with
    ``merge_runs`` would build a whole run for each bar.
    """
    amount = amount_type(value_type)
    zero = F.lit(0).cast(amount)

    def changes(values: Column) -> Column:
        later = F.slice(values, 2, F.size(values))
        return F.transform(later, lambda x, i: (x - F.get(values, i)).cast(amount))

    def total(steps: Column, part: int) -> Column:
        return F.aggregate(steps, zero, lambda acc, x: (acc + _split(x, amount)[part]).cast(amount))

    def run(all_bars: Column, values: Column, steps: Column) -> Column:
        return F.when(F.size(all_bars) > 0, F.struct(
            F.size(all_bars).cast("bigint").alias("n"), F.size(values).cast("bigint").alias("nv"),
            F.get(values, F.lit(0)).alias("first"), F.get(values, F.size(values) - 1).alias("last"),
            total(steps, 0).alias("gain"), total(steps, 1).alias("loss"), F.get(steps, F.lit(0)).alias("first_change")).cast(run_type(value_type)))

    return bound(bars, lambda b: bound(F.filter(F.transform(b, lambda x: x["value"]), lambda v: v.isNotNull()),
                                       lambda values: bound(changes(values), lambda steps: run(b, values, steps))))


def bucket_length(window: str, slide: str | None, bucket: str) -> str:
    """The longest bucket of at most ``bucket`` that tiles windows of any length and slide."""
    whole = math.gcd(interval_micros(window), interval_micros(slide or window))
    return f"{math.gcd(whole, interval_micros(bucket)) // 1000} milliseconds"


def bucket_runs(bars: DataFrame, groups: Sequence[str], bucket: str, time: str, order: Sequence[str], value: str,
                extra: Sequence = ()) -> DataFrame:
    """One run (``_run``) per ``groups`` and time bucket (``_bucket``, its start),
    with the ``extra`` aggregates.  One exchange and one sort."""
    dtype = bars.schema[value].dataType
    amount = amount_type(dtype)
    rows = bars.where(F.col(time).isNotNull()).withColumn(BUCKET, F.window(time, bucket).start)
    own = Window.partitionBy(*groups, BUCKET).orderBy(time, *order)
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    change = (F.col(value) - F.last(value, ignorenulls=True).over(before)).cast(amount)
    rows = rows.select("*", F.when(F.col(value).isNotNull(), F.count(value).over(own)).alias("_at"), change.alias("_change"))
    gain, loss = _split(F.col("_change"), amount)
    run = F.struct(
        F.count(F.lit(1)).alias("n"), F.count(value).alias("nv"), F.max(F.when(F.col("_at") == 1, F.col(value))).alias("first"),
        F.max_by(value, "_at").alias("last"), F.sum(gain).cast(amount).alias("gain"), F.sum(loss).cast(amount).alias("loss"),
        F.max(F.when(F.col("_at") == 2, F.col("_change"))).alias("first_change"))
    return rows.groupBy(*groups, BUCKET).agg(run.cast(run_type(dtype)).alias(RUN), *[agg.alias(name) for _, name, agg in extra])


def merged(runs: Column, value_type: T.DataType) -> Column:
    """The run of an array of (start, run) structs, merged in the order of their starts."""
    return F.aggregate(F.sort_array(runs), empty_run(value_type), lambda acc, x: merge_runs(acc, x["r"], value_type))


def window_runs(bars: DataFrame, window: str, slide: str | None, key: str, time: str, order: Sequence[str], value: str,
                bucket: str = DEFAULT_BUCKET, member: str | None = None, extra: Sequence = ()) -> DataFrame:
    """One run per ``window`` and ``key``, and the ``extra`` sums.

    A window has at most ``window / bucket`` runs, which meet in its group in any
    order.
    """
    dtype = bars.schema[value].dataType
    cols = list(dict.fromkeys([key, time, *order, value, *([member] if member else []), *[c for x, _, _ in extra for c in x]]))
    rows = bars.select(*cols)
    if member:
        spread = rows.where(F.col(member).isNotNull()).withColumn("window", window_col(member, window, slide))
        runs = bucket_runs(spread, ["window", key], bucket, time, order, value, extra)
    else:
        runs = bucket_runs(rows, [key], bucket_length(window, slide, bucket), time, order, value, extra)
        runs = runs.withColumn("window", window_col(BUCKET, window, slide))
    pair = F.struct(F.col(BUCKET).alias("s"), F.col(RUN).alias("r"))
    return runs.groupBy("window", key).agg(merged(F.collect_list(pair), dtype).alias(RUN), *[F.sum(name).alias(name) for _, name, _ in extra])


def run_columns(df: DataFrame, key: str, extra: Sequence[str] = ()) -> DataFrame:
    """``window``, ``key`` and the run's numbers as columns."""
    r = F.col(RUN)
    first = r["first_change"]
    amount = df.schema[RUN].dataType["gain"].dataType.simpleString()
    first_gain, first_loss = _split(first, amount)
    return df.select("window", key, r["n"].alias("n_bars"), F.greatest(r["nv"] - 1, F.lit(0)).cast("bigint").alias("n_changes"),
                     r["gain"].alias("gain"), r["loss"].alias("loss"), first_gain.alias("first_gain"), first_loss.alias("first_loss"), *extra)
