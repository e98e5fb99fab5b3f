"""Streams over a directory of day files equal the batch operators on the same lines."""

import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.feed_files import write_day_files
from tests.oracle_check import compare
from tickweave.operators.aggregates import window_metrics
from tickweave.operators.changes import window_changes
from tickweave.operators.indicators import carry_intervals, rsi_smoothed, rsi_window, window_report
from tickweave.operators.profit import cumulative_profit
from tickweave.operators.ranking import top_k
from tickweave.sinks.files import per_batch_parquet, per_batch_text, read_window_text, write_window_text
from tickweave.sources.decode import decode_quotes
from tickweave.sources.lines import read_lines
from tickweave.streaming.feed import (latest_snapshot, quote_stream, start, start_top_k, stream_profit,
                                      stream_window_metrics)
from tickweave.operators.windows import interval_micros
from tickweave.plans.catalog import q_profit, q_top_gainer, q_window_metrics
from tickweave.plans.streams import q_stream_profit, q_stream_top_gainer, q_stream_window_metrics
from tickweave.streaming.rsi import ClosedWindows, read_carried, read_results
from tickweave.streaming.windows import stream_window_report

ONCE = {"availableNow": True}


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("feed"))
    n = write_day_files(spark, SF_SMALL, folder)
    assert n == 30
    return folder


def batch_quotes(spark, folder):
    return decode_quotes(read_lines(spark, folder)).quotes


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def test_window_metrics_stream_complete_mode(spark, feed, scratch):
    quotes = quote_stream(spark, feed, max_files_per_trigger=10).quotes
    out = os.path.join(scratch, "out")
    run(start(stream_window_metrics(quotes, "10 minutes", "5 minutes", "1 day"),
              os.path.join(scratch, "ckpt"), "complete", foreach_batch=per_batch_parquet(out), trigger=ONCE))
    got = latest_snapshot(spark, out).toPandas()
    want = window_metrics(batch_quotes(spark, feed), "10 minutes", "5 minutes").toPandas()
    assert len(got) > 0 and compare(got, want) is None


def test_profit_stream_complete_mode(spark, feed, scratch):
    quotes = quote_stream(spark, feed, max_files_per_trigger=7).quotes
    out = os.path.join(scratch, "out")
    run(start(stream_profit(quotes), os.path.join(scratch, "ckpt"), "complete",
              foreach_batch=per_batch_parquet(out), trigger=ONCE))
    got = latest_snapshot(spark, out).toPandas()
    want = cumulative_profit(batch_quotes(spark, feed)).toPandas()
    assert len(got) == 5 and compare(got, want) is None


def test_top_k_of_closed_windows(spark, feed, scratch):
    quotes = quote_stream(spark, feed, max_files_per_trigger=6).quotes
    metrics = stream_window_metrics(quotes, "1 day", "12 hours", "12 hours")
    out = os.path.join(scratch, "top")
    run(start_top_k(metrics, "avg_gain", 2, out, os.path.join(scratch, "ckpt"), trigger=ONCE))
    got = spark.read.parquet(out).drop("batch_id")
    # Append mode emits a window once the watermark (max time - 12 h) passes its end.
    last_end = got.agg(F.max("window_end")).first()[0]
    want = top_k(window_metrics(batch_quotes(spark, feed), "1 day", "12 hours"), "avg_gain", 2)
    want = want.where(F.col("window_end") <= F.lit(last_end))
    assert got.count() > 40
    assert compare(got.toPandas(), want.toPandas()) is None


def test_text_sink_pairs(spark, feed, scratch):
    quotes = quote_stream(spark, feed, max_files_per_trigger=15).quotes
    out = os.path.join(scratch, "text")
    run(start(stream_profit(quotes), os.path.join(scratch, "ckpt"), "complete",
              foreach_batch=per_batch_text(out, "symbol", "cumulative_profit"), trigger=ONCE))
    lines = [r[0] for r in spark.read.text(out).where(F.col("batch_id") == 1).collect()]
    assert len(lines) == 5 and all(x.startswith("(") and x.endswith(")") and "," in x for x in lines)


def closed_stream(spark, feed, scratch, name="rsi", per_trigger=4, **how):
    """Day windows moved every 12 hours, closed 12 hours late; the folder of the outputs."""
    root = os.path.join(scratch, name)
    report = stream_window_report(quote_stream(spark, feed, max_files_per_trigger=per_trigger).quotes, "1 day", "12 hours", "12 hours")
    query = start(report, os.path.join(scratch, name + "-ckpt"), "append", foreach_batch=ClosedWindows(root, **how), trigger=ONCE)
    run(query)
    return root, query


def closed_until(bq):
    """Is a window end at least 12 hours before the latest quote?"""
    latest = bq.agg(F.max("ts")).first()[0]
    return F.col("window_end") <= F.lit(latest) - F.expr("INTERVAL 12 hours")


def test_stateful_rsi_stream_equals_batch(spark, feed, scratch):
    root, _ = closed_stream(spark, feed, scratch, outputs=("windows", "smoothed"))
    bq = batch_quotes(spark, feed)
    order = ["seq", "close"]
    want = window_report(bq, "1 day", "12 hours", order=order).where(closed_until(bq)).toPandas()
    got = read_results(spark, root, "windows").drop("n_changes").toPandas()
    assert len(got) > 250 and compare(got, want) is None

    want_s = rsi_smoothed(bq, "1 day", "12 hours", order=order).where(closed_until(bq))
    got_s = read_results(spark, root, "smoothed").select("window_start", "symbol", F.round("rsi", 6).alias("rsi"))
    assert compare(got_s.toPandas(), want_s.select("window_start", "symbol", F.round("rsi", 6).alias("rsi")).toPandas(), rel=1e-9) is None
    # every key's last value, as intervals
    wc = window_changes(bq, "1 day", "12 hours", order=order).where(closed_until(bq))
    want_c = carry_intervals(want_s.select("symbol", "window_start", "rsi"), wc.select("symbol", "window_start"))
    assert compare(read_carried(spark, root).toPandas(), want_c.toPandas(), rel=1e-9) is None
    # states that no replay needs are gone
    assert len(os.listdir(os.path.join(root, "state", "smooth"))) <= 2


def test_state_is_bounded_and_a_far_date_is_kept_out(spark, feed, scratch):
    """One day a micro-batch, one of which has a quote of 2034: the state of the
    window aggregations does not grow, and no window is closed early."""
    folder = os.path.join(scratch, "incoming")
    os.makedirs(folder)
    for name in sorted(os.listdir(feed))[:20]:
        shutil.copy2(os.path.join(feed, name), folder)
    far = [{"symbol": "click", "timestamp": "2034-01-01 00:00:00", "priceData": {"open": 1, "close": 2, "volume": 3}}]
    with open(os.path.join(folder, "a-far.json"), "w") as f:
        f.write(json.dumps(far) + "\n")
    os.utime(os.path.join(folder, "a-far.json"), (1_710_000_090, 1_710_000_090))
    decoded = quote_stream(spark, folder, max_files_per_trigger=1, max_ahead="1 day")
    report = stream_window_report(decoded.quotes, "1 hour", "30 minutes", "1 hour")
    out = os.path.join(scratch, "out")
    query = start(report, os.path.join(scratch, "ckpt"), "append", sink=out, trigger=ONCE)
    run(query)
    states = [[s["numRowsTotal"] for s in p["stateOperators"]] for p in query.recentProgress if p["numInputRows"]]
    assert len(states) >= 20
    # A day's bars and windows at most, whatever came before.
    per_day = [max(s) for s in states]
    assert max(per_day[10:]) <= 1.5 * max(per_day[:10])
    bq = batch_quotes(spark, folder).where("ts < '2030-01-01'")
    latest = bq.agg(F.max("ts")).first()[0]
    want = window_report(bq, "1 hour", "30 minutes", order=["seq", "close"]).where(
        F.col("window_end") <= F.lit(latest) - F.expr("INTERVAL 1 hour"))
    assert compare(spark.read.parquet(out).drop("n_changes").toPandas(), want.toPandas()) is None
    bad = decode_quotes(read_lines(spark, folder, arrival_time=True), arrival="arrival_ts", max_ahead="1 day").quarantine
    assert [(r["pos"], r["reason"]) for r in bad.collect()] == [(0, "future_timestamp")]


def test_interval_micros():
    assert interval_micros("10 minutes") == 600_000_000
    assert interval_micros("1 day") == 86_400_000_000
    with pytest.raises(ValueError):
        interval_micros("3 fortnights")


def test_feed_app_all_outputs(spark, feed, scratch):
    from tickweave.app import main, run_feed

    assert main([]) == 1   # the input and output folders are required
    out = os.path.join(scratch, "app")
    assert main(["in", "out", "--unknown"]) == 1
    run_feed(spark, feed, out, "1 day", "12 hours", "12 hours", trigger=ONCE, max_files_per_trigger=10).awaitTermination()
    bq = batch_quotes(spark, feed)
    end_ok = closed_until(bq)
    got = spark.read.parquet(os.path.join(out, "windows")).select(
        "window_start", "window_end", "symbol", "n_quotes", "sma_close", "avg_gain", "total_volume",
        "int_avg_volume")
    want = window_metrics(bq, "1 day", "12 hours").where(end_ok)
    assert got.count() > 250 and compare(got.toPandas(), want.toPandas()) is None
    top = spark.read.parquet(os.path.join(out, "top_volume")).select(*want.columns, "rank")
    assert compare(top.toPandas(), top_k(want, "total_volume", 1).toPandas()) is None
    rsi_cols = spark.read.parquet(os.path.join(out, "windows")).select("window_start", "symbol", "rsi")
    want_rsi = rsi_window(bq, "1 day", "12 hours", order=["seq", "close"]).where(end_ok).select(
        "window_start", "symbol", "rsi")
    assert compare(rsi_cols.toPandas(), want_rsi.toPandas()) is None
    # Text files: one per output and task at most, however many windows a batch closes.
    for batch in os.listdir(os.path.join(out, "text")):
        for folder, _, names in os.walk(os.path.join(out, "text", batch)):
            assert len([n for n in names if n.startswith("part-")]) <= 8, folder
    text = read_window_text(spark, os.path.join(out, "text"))
    for name, column in (("rsi", want_rsi), ("sma_close", want), ("total_volume", want)):
        values = column.select("window_start", "symbol", F.col(name).cast("double").alias("value")).where("value IS NOT NULL")
        lines = text.where(F.col("output") == name).select("window_start", "symbol", "value")
        assert compare(lines.toPandas(), values.toPandas()) is None
    last = spark.read.parquet(os.path.join(out, "profit")).agg(F.max("batch_id")).first()[0]
    prof = spark.read.parquet(os.path.join(out, "profit")).where(F.col("batch_id") == last).drop("batch_id")
    assert compare(prof.toPandas(), cumulative_profit(bq).select("symbol", "n_quotes", "cumulative_profit").toPandas()) is None
    assert spark.read.parquet(os.path.join(out, "quarantine")).count() == 0


def test_restart_from_checkpoint_gives_same_state(spark, feed, scratch):
    """Stop after part of the files, add the rest, restart on the same checkpoint:
    the final results equal one uninterrupted run."""
    files = sorted(os.listdir(feed))
    part = os.path.join(scratch, "incoming")
    os.makedirs(part)
    for name in files[:12]:
        shutil.copy2(os.path.join(feed, name), part)
    outputs = ("windows", "smoothed", "text")
    root, _ = closed_stream(spark, part, scratch, per_trigger=6, outputs=outputs)
    before = read_results(spark, root, "windows").count()
    for name in files[12:]:
        shutil.copy2(os.path.join(feed, name), part)
    closed_stream(spark, part, scratch, per_trigger=6, outputs=outputs)
    assert read_results(spark, root, "windows").count() > before > 0
    whole, _ = closed_stream(spark, feed, scratch, "whole", 10, outputs=outputs)
    for name in ("windows", "smoothed"):
        a = read_results(spark, root, name).toPandas()
        b = read_results(spark, whole, name).toPandas()
        assert len(a) > 0 and compare(a, b, rel=1e-9) is None, name
    # A batch that is replayed overwrites its own output.
    lines = read_window_text(spark, os.path.join(root, "text"))
    n, last = lines.count(), max(int(x.removeprefix("batch_id=")) for x in os.listdir(os.path.join(root, "windows")))
    batch = spark.read.parquet(os.path.join(root, "windows", f"batch_id={last}"))
    batch = spark.createDataFrame(batch.collect(), batch.schema)
    ClosedWindows(root, outputs=("text", "smoothed"))(batch, last)
    assert read_window_text(spark, os.path.join(root, "text")).count() == n
    assert compare(read_results(spark, root, "smoothed").toPandas(), read_results(spark, whole, "smoothed").toPandas(), rel=1e-9) is None


def test_arrival_time_windows(spark, feed, scratch):
    """Windowing by file arrival (modification time) instead of quote time."""
    quotes = quote_stream(spark, feed, max_files_per_trigger=30, arrival_time=True).quotes
    out = os.path.join(scratch, "out")
    run(start(window_metrics(quotes.withWatermark("arrival_ts", "1 hour"), "10 minutes", "5 minutes",
                             time="arrival_ts"),
              os.path.join(scratch, "ckpt"), "complete", foreach_batch=per_batch_parquet(out), trigger=ONCE))
    got = latest_snapshot(spark, out)
    # the day files were stamped one minute apart: each file's quotes land in two windows
    total = batch_quotes(spark, feed).count()
    assert got.agg(F.sum("n_quotes")).first()[0] == 2 * total
    stamps = [int(os.path.getmtime(os.path.join(feed, f))) for f in os.listdir(feed)]
    starts = {(m // 300 - k) * 300 for m in stamps for k in (0, 1)}
    assert got.select("window_start").distinct().count() == len(starts)


def test_missing_state_is_an_error(spark, scratch):
    job = ClosedWindows(os.path.join(scratch, "rsi"), outputs=("smoothed",))
    closed = spark.createDataFrame([], "symbol string, window_start timestamp, window_end timestamp, n_changes long, gain double, loss double")
    with pytest.raises(RuntimeError, match="the state of batch 6"):
        job(closed, 7)


def test_window_text_round_trip(spark, scratch):
    rows = spark.createDataFrame([("A,B", "2024-01-02 00:00:00", 1.5, 7), ("C", "2024-01-02 12:00:00", None, 8)],
                                 "symbol string, t string, rsi double, volume long")
    write_window_text(rows.withColumn("window_start", F.to_timestamp("t")), os.path.join(scratch, "text"), ("rsi", "volume"))
    got = read_window_text(spark, os.path.join(scratch, "text")).collect()
    assert sorted((r["output"], str(r["window_start"]), r["symbol"], r["value"]) for r in got) == [
        ("rsi", "2024-01-02 00:00:00", "A,B", 1.5), ("volume", "2024-01-02 00:00:00", "A,B", 7.0),
        ("volume", "2024-01-02 12:00:00", "C", 8.0)]


@pytest.fixture(scope="module")
def two_weeks(spark, tmp_path_factory):
    """A folder with an ``events`` table of two weeks (a week begins on Thursday 2024-01-04):
    a window over the turn of the week, quotes of the last day, one without a time."""
    folder = str(tmp_path_factory.mktemp("two-weeks"))
    rows = [(1, "2024-01-02 10:01:00", "click", 10.0), (7, "2024-01-03 23:58:00", "click", 9.0), (6, "2024-01-03 23:59:00", "view", 4.0),
            (8, "2024-01-04 00:01:00", "view", 5.0), (9, "2024-01-04 00:02:00", "view", 6.5), (10, "2024-01-09 12:00:00", "click", 3.0),
            (11, "2024-01-10 11:59:30", "view", 8.0), (13, "2024-01-10 11:59:59", "click", 7.25), (20, None, "click", 100.0)]
    events = spark.createDataFrame([(i, t, i, k, v, '{"k": %d}' % i) for i, t, k, v in rows],
                                   "event_id long, t string, user_id long, event_type string, value double, props string")
    events.select("event_id", F.col("t").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value",
                  "props").coalesce(1).write.parquet(os.path.join(folder, "events.parquet"))
    return folder


def test_streamed_metrics_hold_every_window(spark, two_weeks):
    """also the windows that the watermark has not closed at the end of the feed."""
    got, want = q_stream_window_metrics(spark, two_weeks), q_window_metrics(spark, two_weeks)
    assert got.columns == want.columns
    assert want.count() == 13 and compare(got.toPandas(), want.toPandas()) is None


def test_streamed_top_gainer_holds_every_window(spark, two_weeks):
    """the best of the window over the turn of the week traded only before it."""
    got, want = q_stream_top_gainer(spark, two_weeks), q_top_gainer(spark, two_weeks)
    assert got.columns == want.columns
    assert want.count() == 9 and compare(got.toPandas(), want.toPandas()) is None
    assert [r["symbol"] for r in got.where("window_start = '2024-01-03 23:55:00'").collect()] == ["click"]


def test_streamed_profit_has_means_and_quotes_without_a_time(spark, two_weeks):
    """all columns of the batch query, over all quotes."""
    got, want = q_stream_profit(spark, two_weeks), q_profit(spark, two_weeks)
    assert got.columns == want.columns
    assert compare(got.toPandas(), want.toPandas()) is None
    assert {r["symbol"]: r["n_quotes"] for r in got.collect()} == {"click": 5, "view": 4}
