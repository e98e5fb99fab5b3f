"""Ordered runs, validity intervals, gap runs, exact totals and broken elements."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.operators.aggregates import expand_count_runs, window_count_runs, window_metrics
from tickweave.operators.indicators import carry_intervals, expand_intervals, rsi_window, values_at
from tickweave.operators.ranking import first_rows
from tickweave.operators.runs import merged, run_of_bars
from tickweave.sources.decode import decode_quotes
from tickweave.streaming.windows import stream_window_changes

T0 = dt.datetime(2024, 1, 2, 9, 30)
PRICE = T.DecimalType(12, 2)
BARS = "symbol string, ts timestamp_ntz, arrival timestamp_ntz, seq long, close decimal(12,2)"


def summary(values):
    """The run of a list of values by definition."""
    known = [v for v in values if v is not None]
    changes = [b - a for a, b in zip(known, known[1:])]
    return (len(values), len(known), known[0] if known else None, known[-1] if known else None,
            sum((c for c in changes if c > 0), Decimal(0)), sum((-c for c in changes if c < 0), Decimal(0)), changes[0] if changes else None)


def test_runs_merge_in_any_split_and_any_order_of_arrival(spark):
    rng = random.Random(2)
    cases, rows = [], []
    for n in range(60):
        values = [None if rng.random() < 0.2 else Decimal(rng.randint(1, 500)) / 100 for _ in range(rng.randint(0, 9))]
        cuts = sorted(rng.choices(range(len(values) + 1), k=rng.randint(0, 4)))
        parts = [values[a:b] for a, b in zip([0, *cuts], [*cuts, len(values)])]
        pieces = [(i, [(v,) for v in part]) for i, part in enumerate(parts) if part]
        rng.shuffle(pieces)  # a late part merges like any other
        cases.append(summary(values) if values else None)
        rows.append((n, pieces))
    df = spark.createDataFrame(rows, "n int, parts array<struct<s:int,bars:array<struct<value:decimal(12,2)>>>>")
    pieces = F.transform("parts", lambda p: F.struct(p["s"].alias("s"), run_of_bars(p["bars"], PRICE).alias("r")))
    got = {r["n"]: r["run"] for r in df.select("n", merged(pieces, PRICE).alias("run")).collect()}
    assert [None if got[n] is None else tuple(got[n]) for n in range(len(cases))] == cases


def test_a_run_is_built_once_and_a_bar_holds_its_value_once(spark):
    """not a run per bar; the state of a stream holds no second copy of the value that ends the order."""
    plan = (lambda df: df._jdf.queryExecution().optimizedPlan().toString())
    bars = spark.createDataFrame([([(Decimal("1.5"),), (None,), (Decimal("2.5"),)],)], "bars array<struct<value:decimal(12,2)>>")
    runs = bars.select(run_of_bars(F.col("bars"), PRICE).alias("run"))
    assert tuple(runs.first()["run"]) == summary([Decimal("1.5"), None, Decimal("2.5")])
    assert plan(runs).count("first_change") <= 3
    changes = stream_window_changes(spark.createDataFrame([], BARS))
    assert "ts, ts#" in plan(changes) and ", close, close#" not in plan(changes)


def test_windows_by_arrival_ordered_by_quote_time(spark):
    rng = random.Random(4)
    rows = [(k, T0 + dt.timedelta(seconds=rng.randint(0, 7200)), T0 + dt.timedelta(seconds=rng.randint(0, 5400)), i,
             Decimal(rng.randint(100, 900)) / 100) for k in "AB" for i in range(150)]
    got = {(r["symbol"], r["window_start"]): (r["n_bars"], r["gain"], r["loss"])
           for r in rsi_window(spark.createDataFrame(rows, BARS), "30 minutes", "20 minutes", member="arrival").collect()}
    want = {}
    for k in "AB":
        start = dt.datetime(2024, 1, 2, 8, 0)
        while start < T0 + dt.timedelta(hours=3):
            inside = sorted(r for r in rows if r[0] == k and start <= r[2] < start + dt.timedelta(minutes=30))
            if inside:
                s = summary([r[4] for r in sorted(inside, key=lambda r: (r[1], r[3]))])
                want[(k, start)] = (s[0], float(s[4]), float(s[5]))
            start += dt.timedelta(minutes=20)
    assert got == want


def test_two_values_ten_years_apart_are_two_intervals(spark):
    far = T0 + dt.timedelta(days=3652)
    values = spark.createDataFrame([("A", T0, 1.5), ("A", far, 2.5)], "symbol string, window_start timestamp_ntz, rsi double")
    spans = carry_intervals(values, values.select("symbol", "window_start"))
    assert sorted(map(tuple, spans.collect())) == [("A", T0, far, 1.5), ("A", far, None, 2.5)]
    points = spark.createDataFrame([("A", T0 - dt.timedelta(days=1), 1), ("A", T0, 2), ("A", T0 + dt.timedelta(days=900), 3), ("A", far, 4), ("B", far, 5)],
                                   "symbol string, at timestamp_ntz, n int")
    assert {r["n"]: r["rsi"] for r in values_at(spans, points, "at").collect()} == {1: None, 2: 1.5, 3: 1.5, 4: 2.5, 5: None}
    until = F.lit(T0 + dt.timedelta(hours=2)).cast("timestamp_ntz")
    grid = expand_intervals(spans.withColumn("valid_to", F.lit(None).cast("timestamp_ntz")).limit(1), until, "30 minutes", "1 hour")
    assert grid.count() == 5


def test_a_gap_is_one_row_however_long(spark):
    far = T0 + dt.timedelta(days=3652)
    df = spark.createDataFrame([("A", T0, T0, 1, None), ("A", far, far, 2, None)], BARS)
    runs = window_count_runs(df, "10 minutes", "5 minutes").orderBy("window_start").collect()
    assert [(r["n_windows"], r["n_quotes"]) for r in runs] == [(1, 1), (1, 1), (3652 * 288 - 2, 0), (1, 1), (1, 1)]
    near = window_count_runs(df.where("seq = 1").union(df.where("seq = 2").withColumn("ts", F.lit(T0 + dt.timedelta(minutes=20)).cast("timestamp_ntz"))))
    assert [r["n_quotes"] for r in expand_count_runs(near).orderBy("window_start").collect()] == [1, 1, 0, 0, 1, 1]


def test_huge_volumes_do_not_end_the_job(spark):
    big = 9 * 10 ** 18
    df = spark.createDataFrame([("A", T0, 1, 1.0, 1.0, big), ("A", T0, 2, 1.0, 1.0, big), ("B", T0, 3, 1.0, 1.0, 7)],
                               "symbol string, ts timestamp_ntz, seq long, open double, close double, volume long")
    got = {r["symbol"]: r for r in window_metrics(df, "10 minutes", None, exact_volume=True).collect()}
    assert (got["A"]["total_volume"], got["A"]["int_avg_volume"], got["A"]["exact_volume"], got["A"]["reason"]) == (
        None, big, Decimal(2 * big), "volume_overflow")
    assert (got["B"]["total_volume"], got["B"]["reason"]) == (7, None)


def test_a_broken_element_stays_alone(spark):
    good = '{"symbol":"B","timestamp":"2024-01-02 09:30:00","priceData":{"open":1,"close":2,"volume":3}}'
    lines = {
        f'[{good},{{"symbol":"B","symbol":"C"}},{good}]': (2, [(1, "malformed_element")]),
        f'[{good}, nonsense here ,{good}]': (2, [(1, "malformed_element")]),
        f'[{good}{good}]': (0, [(0, "malformed_element")]),
        f'[{good},"a]b,{{\\"",{good}]': (2, [(1, "bad_element")]),
        f'[{good}],"end"],[': (0, [(None, "trailing_text")]),
        f'[{good}],"end"] garbage': (0, [(None, "trailing_text")]),
        f'[{good},': (0, [(None, "malformed")]),
        "[" + ",".join([good] * 400) + ',{"a":1,"a":2}]': (400, [(400, "malformed_element")]),
        "[]": (0, []),
    }
    df = spark.createDataFrame([(k,) for k in lines], "value string")
    decoded = decode_quotes(df.withColumn("n", F.col("value")), keep=("n",))
    quotes = {r["n"]: r["count"] for r in decoded.quotes.groupBy("n").count().collect()}
    faults = {}
    for r in decode_quotes(df).quarantine.orderBy("pos").collect():
        faults.setdefault(r["line"], []).append((r["pos"], r["reason"]))
    assert {k: (quotes.get(k, 0), faults.get(k, [])) for k in lines} == lines


def test_first_rows(spark):
    assert first_rows(spark.range(100)).count() == 10
