"""Hand-worked cases for each operator, plus properties checked against brute force."""

import datetime as dt
import math
import random
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from tickweave.functions.scalar import int_mean, render_quote, to_volume
from tickweave.operators.aggregates import window_counts, window_metrics
from tickweave.operators.changes import bar_changes, window_changes
from tickweave.operators.indicators import carry_forward, rsi_smoothed, rsi_window
from tickweave.operators.profit import cumulative_profit, profit_parity, running_profit
from tickweave.operators.ranking import top_k
from tickweave.operators.scan import affine_scan
from tickweave.plans.catalog import q_int_avg_volume_large
from tickweave.plans.oracle import ORACLE_SQL

T0 = dt.datetime(2024, 1, 2, 9, 30, 0)
SCHEMA = "symbol string, ts timestamp_ntz, seq bigint, open decimal(12,2), close decimal(12,2), volume bigint"


def bars(spark, rows):
    """rows: (symbol, minute offset, seq, open, close, volume)."""
    data = [(s, T0 + dt.timedelta(minutes=m), q, Decimal(str(o)), Decimal(str(c)), v)
            for s, m, q, o, c, v in rows]
    return spark.createDataFrame(data, SCHEMA)


def test_rsi_hand_worked(spark):
    # closes 1, 2, 1.5, 3: changes +1, -0.5, +1.5 -> gain 2.5, loss 0.5 -> RSI 83.33;
    # without the first change: 1.5 / 0.5 -> 75.
    df = bars(spark, [("A", i, i, 1, c, 1) for i, c in enumerate([1, 2, 1.5, 3])])
    r = rsi_window(df, "1 hour", None).collect()
    assert len(r) == 1
    assert r[0]["n_bars"] == 4
    assert r[0]["gain"] == pytest.approx(2.5) and r[0]["loss"] == pytest.approx(0.5)
    assert r[0]["rsi"] == pytest.approx(250 / 3)
    assert r[0]["rsi_skip_first"] == pytest.approx(75.0)


def test_rsi_edge_cases(spark):
    df = bars(spark, [("UP", 0, 0, 1, 1, 1), ("UP", 1, 1, 1, 2, 1),      # only gains -> 100
                      ("FLAT", 0, 2, 1, 5, 1), ("FLAT", 1, 3, 1, 5, 1),  # no move -> NULL
                      ("ONE", 0, 4, 1, 5, 1)])                          # one bar -> NULL
    r = {x["symbol"]: x for x in rsi_window(df, "1 hour", None).collect()}
    assert r["UP"]["rsi"] == 100.0
    assert r["FLAT"]["rsi"] is None
    assert r["ONE"]["rsi"] is None and r["ONE"]["n_bars"] == 1


def test_equal_timestamps_break_ties_by_seq(spark):
    df = bars(spark, [("A", 0, 2, 1, 3, 1), ("A", 0, 1, 1, 1, 1), ("A", 1, 3, 1, 2, 1)])
    ch = {x["seq"]: x["change"] for x in bar_changes(df).collect()}
    assert ch == {1: None, 2: Decimal("2.00"), 3: Decimal("-1.00")}


def brute_window_changes(rows, window_min, slide_min):
    """Per (symbol, window start) -> (n, gain, loss, first change) by sorting each window."""
    out = {}
    for sym in {r[0] for r in rows}:
        seq = sorted((r for r in rows if r[0] == sym), key=lambda r: (r[1], r[2]))
        starts = {(r[1] // slide_min - k) * slide_min for r in seq for k in range(window_min // slide_min)}
        for s in starts:
            inside = [r for r in seq if s <= r[1] < s + window_min]
            if not inside:
                continue
            d = [Decimal(str(b[4])) - Decimal(str(a[4])) for a, b in zip(inside, inside[1:])]
            out[(sym, s)] = (len(inside), sum((x for x in d if x > 0), Decimal(0)),
                             sum((-x for x in d if x < 0), Decimal(0)), d[0] if d else None)
    return out


@pytest.mark.parametrize("bucket", ["1 minute", "7 minutes", "1 hour", "1 day"])
def test_window_changes_match_brute_force_for_any_bucket(spark, bucket):
    rng = random.Random(7)
    rows = [(rng.choice("ABC"), rng.randrange(0, 300), i, 1, round(rng.uniform(1, 20), 2), 1)
            for i in range(400)]
    got = window_changes(bars(spark, rows), "30 minutes", "10 minutes", bucket=bucket).collect()
    want = brute_window_changes(rows, 30, 10)
    assert len(got) == len(want)
    for r in got:
        start = int((r["window_start"] - T0).total_seconds() // 60)
        n, g, l_, first = want[(r["symbol"], start)]
        assert (r["n_bars"], r["gain"], r["loss"]) == (n, g, l_)
        assert r["n_changes"] == n - 1
        assert r["first_gain"] == (first if first is not None and first > 0 else 0)
        assert r["first_loss"] == (-first if first is not None and first < 0 else 0)


def test_affine_scan_equals_sequential_fold(spark):
    rng = random.Random(3)
    rows = [(k, i, rng.uniform(0.1, 1.5), rng.uniform(-5, 5)) for k in "XY" for i in range(37)]
    df = spark.createDataFrame(rows, "k string, i int, a double, b double")
    got = {(r["k"], r["i"]): r["b"] for r in affine_scan(df, "k", ["i"], "a", ["b"]).collect()}
    for k in "XY":
        x = 0.0
        for _, i, a, b in (r for r in rows if r[0] == k):
            x = a * x + b
            assert got[(k, i)] == pytest.approx(x, rel=1e-12, abs=1e-12)


def test_rsi_smoothed_modes_by_hand(spark):
    # window 1 (minutes 0-59): closes 10, 11, 10.5 -> L=2, gain 1, loss 0.5
    # window 2 (minutes 60-119): closes 11, 12 -> L=1, gain 1, loss 0 (the change
    # 10.5 -> 11 crosses windows and is not counted)
    rows = [("S", 0, 0, 1, 10, 1), ("S", 1, 1, 1, 11, 1), ("S", 2, 2, 1, 10.5, 1),
            ("S", 60, 3, 1, 11, 1), ("S", 61, 4, 1, 12, 1)]
    df = bars(spark, rows)
    w = {r["window_start"].hour: r for r in rsi_smoothed(df, "1 hour", None, mode="wilder").collect()}
    g1, l1 = 1 / 3, 0.5 / 3
    g2, l2 = (g1 * 1 + 1) / 2, (l1 * 1 + 0) / 2
    assert w[9]["rsi"] == pytest.approx(100 * g1 / (g1 + l1))
    assert w[10]["rsi"] == pytest.approx(100 * g2 / (g2 + l2))
    u = {r["window_start"].hour: r for r in rsi_smoothed(df, "1 hour", None, mode="undivided").collect()}
    g2u, l2u = 1 * 1 + 1, 0.5 * 1 + 0
    assert u[10]["rsi"] == pytest.approx(100 * g2u / (g2u + l2u))
    with pytest.raises(ValueError):
        rsi_smoothed(df, mode="other")


def test_carry_forward_fills_empty_windows(spark):
    rows = [("A", 0, 0, 1, 1, 1), ("A", 1, 1, 1, 2, 1), ("A", 200, 2, 1, 3, 1),
            ("B", 0, 3, 1, 1, 1), ("B", 1, 4, 1, 0.5, 1)]
    df = bars(spark, rows)
    wc = window_changes(df, "1 hour", None)
    sm = rsi_smoothed(df, summaries=wc).select("symbol", "window_start", "rsi")
    out = carry_forward(sm, wc.select("symbol", "window_start"), "1 hour", "1 hour").orderBy("symbol", "window_start")
    got = [(r["symbol"], r["window_start"].hour, r["rsi"]) for r in out.collect()]
    assert got == [("A", 9, 100.0), ("A", 10, 100.0), ("A", 11, 100.0), ("A", 12, 100.0),
                   ("B", 9, 0.0), ("B", 10, 0.0), ("B", 11, 0.0), ("B", 12, 0.0)]


def test_window_metrics_and_top_k(spark):
    rows = [("A", 1, 0, 10, 11, 5), ("A", 2, 1, 10, 13, 7), ("B", 3, 2, 20, 19, 1), ("C", 4, 3, 5, 7, 2)]
    m = window_metrics(bars(spark, rows), "10 minutes", "5 minutes")
    first = {r["symbol"]: r for r in m.where(F.col("window_start") == T0).collect()}
    assert first["A"]["sma_close"] == 12.0 and first["A"]["avg_gain"] == 2.0
    assert first["A"]["total_volume"] == 12 and first["A"]["int_avg_volume"] == 6
    assert first["A"]["n_quotes"] == 2
    top = top_k(m, "avg_gain", 1).where(F.col("window_start") == T0).collect()
    assert [(r["symbol"], r["rank"]) for r in top] == [("A", 1)]
    top2 = top_k(m, "avg_gain", 2).where(F.col("window_start") == T0).collect()
    assert [r["symbol"] for r in sorted(top2, key=lambda r: r["rank"])] == ["A", "C"]
    counts = {r["window_start"]: r["n_quotes"] for r in window_counts(bars(spark, rows), "10 minutes", "5 minutes").collect()}
    assert counts[T0] == 4 and sum(counts.values()) == 8


def test_top_k_ties_are_deterministic(spark):
    rows = [("B", 1, 0, 1, 2, 1), ("A", 2, 1, 1, 2, 1), ("C", 3, 2, 1, 2, 1)]
    m = window_metrics(bars(spark, rows), "1 hour", None)
    assert [r["symbol"] for r in top_k(m, "avg_gain", 1).collect()] == ["A"]


def test_int_mean_truncates_toward_zero(spark):
    df = spark.createDataFrame([(7, -2), (-7, 2), (7, 2), (5, 0)], "t bigint, n bigint")
    got = [r[0] for r in df.select(int_mean("t", "n")).collect()]
    assert got == [-3, -3, 3, None]


def test_volume_text_conversion(spark):
    df = spark.createDataFrame([("10",), ("10.0",), ("10.5",), ("x",), (None,)], "v string")
    assert [r[0] for r in df.select(to_volume("v")).collect()] == [10, 10, None, None, None]


def test_profit_variants(spark):
    # A: (open, close) = (10, 11) at minute 0 and (10, 13) at minute 7.
    rows = [("A", 0, 0, 10, 11, 1), ("A", 7, 1, 10, 13, 1)]
    df = bars(spark, rows)
    p = cumulative_profit(df).collect()[0]
    assert p["cumulative_profit"] == 2.0 and p["n_quotes"] == 2
    run = [(r["n_quotes"], r["cumulative_profit"]) for r in running_profit(df, "5 minutes").orderBy("window_end").collect()]
    assert run == [(1, 1.0), (2, 2.0)]
    par = profit_parity(df, "10 minutes", "5 minutes").orderBy("window_start").collect()
    # windows: [-5,5): 1 quote -> count 0 -> NULL; [0,10): 2 quotes -> running count 1
    assert par[0]["cumulative_profit"] is None and par[0]["n_counted"] == 0
    assert par[1]["n_counted"] == 1 and par[1]["cumulative_profit"] == pytest.approx((11 + 11 + 13) - (30))


def test_render_quote(spark):
    df = bars(spark, [("AAA", 1, 0, 10, 10.5, 1200)]).withColumn("high", F.col("close")).withColumn("low", F.col("open"))
    assert df.select(render_quote()).first()[0] == "AAA - 2024-01-02 09:31:00 (10.00 - 10.50 - 10.00 - 10.50 - 1200)"


@pytest.mark.parametrize("block", [1, 2, 4, 256])
def test_blocked_scan_any_block_size(spark, block):
    rng = random.Random(11)
    rows = [(k, i, rng.uniform(0.1, 1.2), rng.uniform(0, 5), rng.uniform(0, 5))
            for k, n in (("X", 29), ("Y", 5), ("Z", 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, i int, a double, g double, l double")
    got = {(r["k"], r["i"]): (r["g"], r["l"]) for r in affine_scan(df, "k", ["i"], "a", ["g", "l"], block=block).collect()}
    assert len(got) == len(rows)
    for k in "XYZ":
        g = l_ = 0.0
        for _, i, a, bg, bl in (r for r in rows if r[0] == k):
            g, l_ = a * g + bg, a * l_ + bl
            assert got[(k, i)] == (pytest.approx(g, rel=1e-12), pytest.approx(l_, rel=1e-12))


def test_render_row(spark):
    from tickweave.functions.scalar import render_row
    df = spark.createDataFrame([("A", 1.5, None, 2)], "k string, g double, l double, n int")
    assert df.select(render_row("k", "g", "l", "n")).first()[0] == "A - 1.5 - 2"


@pytest.mark.parametrize("window,slide", [("30 minutes", "5 minutes"), ("1 hour", "10 minutes"), ("10 minutes", "5 minutes")])
def test_preaggregated_windows_equal_direct(spark, window, slide):
    import random as _r
    rng = _r.Random(5)
    rows = [(rng.choice("ABC"), rng.randrange(0, 240), i, round(rng.uniform(1, 9), 2), round(rng.uniform(1, 9), 2),
             rng.randrange(1, 50)) for i in range(300)]
    df = bars(spark, rows)
    a = window_metrics(df, window, slide, preaggregate=True).toPandas()
    b = window_metrics(df, window, slide, preaggregate=False).toPandas()
    from tests.oracle_check import compare
    assert len(a) > 0 and compare(a, b) is None


@pytest.mark.parametrize("bucket", ["3 minutes", "1 hour"])
def test_wide_window_changes_match_brute_force(spark, bucket):
    rng = random.Random(9)
    rows = [(rng.choice("AB"), rng.randrange(0, 400), i, 1, round(rng.uniform(1, 20), 2), 1) for i in range(300)]
    got = window_changes(bars(spark, rows), "60 minutes", "10 minutes", bucket=bucket).collect()
    want = brute_window_changes(rows, 60, 10)
    assert len(got) == len(want)
    for r in got:
        n, g, l_, first = want[(r["symbol"], int((r["window_start"] - T0).total_seconds() // 60))]
        assert (r["n_bars"], r["n_changes"], r["gain"], r["loss"]) == (n, n - 1, g, l_)
        assert r["first_gain"] == (first if first is not None and first > 0 else 0)
        assert r["first_loss"] == (-first if first is not None and first < 0 else 0)


def test_wide_window_report_equals_metrics_and_rsi(spark):
    from tests.oracle_check import compare
    from tickweave.operators.indicators import window_report
    rng = random.Random(4)
    rows = [(rng.choice("ABC"), rng.randrange(0, 300), i, round(rng.uniform(1, 9), 2), round(rng.uniform(1, 9), 2),
             rng.randrange(1, 50)) for i in range(300)]
    df = bars(spark, rows)
    rep = window_report(df, "1 hour", "10 minutes")
    m = window_metrics(df, "1 hour", "10 minutes", preaggregate=False)
    r = rsi_window(df, "1 hour", "10 minutes").select("window_start", "symbol", "gain", "loss", "rsi", "rsi_skip_first")
    want = m.join(r, ["window_start", "symbol"])
    assert compare(rep.toPandas(), want.toPandas()) is None


@pytest.mark.parametrize("mode", ["wilder", "undivided"])
def test_seeded_smoothing_continues_the_fold(spark, mode):
    rng = random.Random(21)
    rows = [(rng.choice("AB"), rng.randrange(0, 600), i, 1, round(rng.uniform(5, 9), 2), 1) for i in range(400)]
    df = bars(spark, rows)
    wc = window_changes(df, "1 hour", "30 minutes")
    cut = T0 + dt.timedelta(minutes=300)
    whole = {(r["symbol"], r["window_start"]): r["rsi"]
             for r in rsi_smoothed(df, mode=mode, summaries=wc).collect()}
    first = rsi_smoothed(df, mode=mode, summaries=wc.where(F.col("window_start") < cut))
    last = first.groupBy("symbol").agg(F.max_by(F.struct("avg_gain", "avg_loss"), "window_start").alias("s"))
    seed = last.select("symbol", "s.avg_gain", "s.avg_loss")
    rest = rsi_smoothed(df, mode=mode, summaries=wc.where(F.col("window_start") >= cut), seed=seed)
    got = {(r["symbol"], r["window_start"]): r["rsi"] for r in first.collect() + rest.collect()}
    assert got.keys() == whole.keys() and len(got) > 10
    for k, v in whole.items():
        assert got[k] == pytest.approx(v, rel=1e-9)


def test_int_mean_is_exact_for_large_sums(spark):
    df = spark.createDataFrame([(2474702362506447612, 579249), (-7, 2), (5, 0)], "t long, n long")
    got = [r[0] for r in df.select(int_mean("t", "n")).collect()]
    assert got == [2474702362506447612 // 579249, -3, None]


def test_int_avg_volume_of_sums_beyond_bigint(spark, scratch):
    big = 2 ** 63 - 1
    volumes = {"sum": [900_000] * 20 + [0], "row": [2_000_000, 0, 0, None, 7], "below": [-900_000] * 20 + [1],
               "no mean": [big, big], "cancel": [big, -big, 5], "none": [None, None], None: [900_000] * 11, "small": [3, 4]}
    rows = [(seq, symbol, v) for seq, (symbol, v) in enumerate((s, v) for s, vs in volumes.items() for v in vs)]
    events = [(seq, T0, 1, symbol, 1.0, "{}" if v is None else '{"k": %d}' % v) for seq, symbol, v in rows]
    spark.createDataFrame(events, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string") \
        .write.parquet(f"{scratch}/events.parquet")

    def mean(symbol):
        scaled = [v * 10 ** 13 + seq for seq, s, v in rows if s == symbol and v is not None]
        m = scaled and abs(sum(scaled)) // len(scaled)
        return (m if sum(scaled) > 0 else -m) if scaled and m <= big else None

    got = {r["symbol"]: r["int_avg_volume"] for r in q_int_avg_volume_large(spark, scratch).collect()}
    assert got == {s: mean(s) for s in volumes}
    assert got["no mean"] is None and got["none"] is None and got["row"] > 4 * 10 ** 18
    # The SQL takes rows up to bigint.
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{scratch}/events.parquet/*.parquet' "
                "WHERE event_type IS NULL OR event_type IN ('sum', 'below', 'none', 'small')")
    assert dict(con.execute(ORACLE_SQL["q_int_avg_volume_large"]).fetchall()) == {s: got[s] for s in ("sum", "below", "none", "small", None)}


def test_profit_divides_by_the_values_that_are_there(spark):
    df = spark.createDataFrame([("A", 10.0, 4.0), ("A", None, 6.0)], "symbol string, close double, open double")
    row = cumulative_profit(df).first()
    assert (row["avg_close"], row["avg_open"], row["cumulative_profit"], row["n_quotes"]) == (10.0, 5.0, 5.0, 2)


def test_interval_text_must_match_in_full():
    from tickweave.operators.windows import interval_micros

    assert interval_micros("1 hour 30 minutes") == 5_400_000_000
    for text in ("1.5 hours", "10", "ten minutes", ""):
        with pytest.raises(ValueError):
            interval_micros(text)


def test_scan_does_not_overflow_before_its_values(spark):
    df = spark.createDataFrame([("k", 0, 1e200, 0.001), ("k", 1, 1e200, 1.0), ("k", 2, 1e100, 1.0)], "key string, i int, a double, b double")
    got = [r["x"] for r in affine_scan(df, "key", ["i"], "a", ["b"], ["x"]).orderBy("i").collect()]
    assert got[0] == 0.001 and abs(got[1] / 1e197 - 1) < 1e-9 and abs(got[2] / 1e297 - 1) < 1e-9


def test_changes_run_from_value_to_value(spark):
    rows = [("A", f"2024-01-02 09:{m:02d}:00", m, c) for m, c in ((0, 10.0), (1, None), (2, 13.0), (7, None), (8, 12.0))]
    bars = spark.createDataFrame(rows, "symbol string, ts string, seq long, close double").select(
        "symbol", F.to_timestamp("ts").alias("ts"), "seq", F.col("close").cast("decimal(12,2)").alias("close"))
    got = rsi_window(bars, "1 day", None).collect()
    assert [(r["n_bars"], r["gain"], r["loss"], r["rsi"]) for r in got] == [(5, 3.0, 1.0, 75.0)]


def test_scan_digits_do_not_depend_on_the_block_size(spark):
    rng = random.Random(5)
    rows = [(k, i, float(rng.randint(1, 30)), rng.uniform(0, 5), rng.uniform(0, 5)) for k in "XY" for i in range(700)]
    df = spark.createDataFrame(rows, "k string, i int, a double, g double, l double")
    want = {}
    for k in "XY":
        g = l_ = t = 0.0  # brought to sum 1 after each step
        for _, i, a, bg, bl in (r for r in rows if r[0] == k):
            g, l_ = a * g + bg * math.exp(-t), a * l_ + bl * math.exp(-t)
            g, l_, t = g / (g + l_), l_ / (g + l_), t + math.log(g + l_)
            want[(k, i)] = g
    for block in (16, 256, 4096):
        got = affine_scan(df, "k", ["i"], "a", ["g", "l"], block=block, exponent="e").collect()
        assert {(r["k"], r["i"]): round(r["g"] / (r["g"] + r["l"]), 9) for r in got} == {k: round(v, 9) for k, v in want.items()}
    plain = affine_scan(df, "k", ["i"], "a", ["g", "l"]).where("i = 699").collect()
    assert all(math.isinf(r["g"]) and math.isinf(r["l"]) for r in plain)
    shrinking = df.withColumn("a", F.lit(1e-3)).withColumn("g", F.when(F.col("i") == 0, 1.0).otherwise(0.0))
    assert {r["g"] for r in affine_scan(shrinking, "k", ["i"], "a", ["g"], block=16).where("i > 300").collect()} == {0.0}
