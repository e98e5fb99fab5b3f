"""Named queries over the test tables: each takes ``(spark, data_dir)`` and
returns a DataFrame (prices as double, timestamps as TIMESTAMP_NTZ) whose
column names match the SQL in ``tickweave.plans.oracle``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.functions.scalar import int_mean, render_quote
from tickweave.operators.aggregates import window_count_runs, window_counts, window_metrics
from tickweave.operators.changes import window_changes
from tickweave.operators.indicators import carry_forward, carry_intervals, rsi_smoothed, rsi_window, window_report
from tickweave.operators.profit import cumulative_profit, profit_parity, running_profit, running_profit_carried
from tickweave.operators.ranking import ranked, top_k
from tickweave.sinks.files import TEXT_OUTPUTS, read_window_text, write_window_text
from tickweave.sources.decode import decode_quotes
from tickweave.sources.lines import render_quote_lines
from tickweave.session import checkpoint_root, cut_lineage
from tickweave.sources.tables import bars_from_lineitem, load_quotes, read_table, with_high_low

# Window settings of the queries.  The feed's own setting is 10 minutes moved
# every 5; indicator queries use 1 day moved every 12 hours because the
# synthetic feed is sparse (most 10-minute windows hold a single bar).
FEED_WINDOW, FEED_SLIDE = "10 minutes", "5 minutes"
DAY_WINDOW, DAY_SLIDE = "1 day", "12 hours"
RSI_DIGITS = 6


def _double(*cols: str):
    return [F.col(c).cast("double").alias(c) for c in cols]


def q_quotes(spark: SparkSession, d: str) -> DataFrame:
    q = load_quotes(spark, d)
    return q.select("symbol", "ts", "seq", *_double("open", "close"), "volume")


def q_gain(spark: SparkSession, d: str) -> DataFrame:
    q = load_quotes(spark, d)
    return q.select("symbol", "ts", "seq", (F.col("close") - F.col("open")).cast("double").alias("gain"))


def q_window_metrics(spark: SparkSession, d: str) -> DataFrame:
    return window_metrics(load_quotes(spark, d), FEED_WINDOW, FEED_SLIDE)


def q_sma_close(spark: SparkSession, d: str) -> DataFrame:
    m = window_metrics(load_quotes(spark, d), FEED_WINDOW, FEED_SLIDE)
    return m.select("window_start", "window_end", "symbol", "sma_close", "total_volume")


def q_sma_close_users(spark: SparkSession, d: str) -> DataFrame:
    m = window_metrics(load_quotes(spark, d, key="user_id"), FEED_WINDOW, FEED_SLIDE)
    return m.select("window_start", "window_end", "symbol", "n_quotes", "sma_close", "total_volume")


def q_sma_hourly(spark: SparkSession, d: str) -> DataFrame:
    """One-hour windows moved every 5 minutes (12 windows per quote): summed
    per 5-minute bucket first, then per window."""
    m = window_metrics(load_quotes(spark, d), "1 hour", FEED_SLIDE)
    return m.select("window_start", "window_end", "symbol", "n_quotes", "sma_close", "avg_gain", "total_volume")


def q_avg_gain(spark: SparkSession, d: str) -> DataFrame:
    m = window_metrics(load_quotes(spark, d), FEED_WINDOW, FEED_SLIDE)
    return m.select("window_start", "window_end", "symbol", "avg_gain")


def q_quote_count(spark: SparkSession, d: str) -> DataFrame:
    return window_counts(load_quotes(spark, d), FEED_WINDOW, FEED_SLIDE)


def q_quote_count_filled(spark: SparkSession, d: str) -> DataFrame:
    """Quote count of every window from the first to the last, 0 where empty."""
    return window_counts(load_quotes(spark, d), FEED_WINDOW, FEED_SLIDE, fill_empty=True)


def q_int_avg_volume(spark: SparkSession, d: str) -> DataFrame:
    m = window_metrics(load_quotes(spark, d), FEED_WINDOW, FEED_SLIDE)
    return m.select("window_start", "window_end", "symbol", "int_avg_volume")


def q_top_gainer(spark: SparkSession, d: str) -> DataFrame:
    m = window_metrics(load_quotes(spark, d), FEED_WINDOW, FEED_SLIDE)
    return top_k(m, "avg_gain", 1).select("window_start", "window_end", "rank", "symbol", "avg_gain")


def q_top_volume(spark: SparkSession, d: str) -> DataFrame:
    m = window_metrics(load_quotes(spark, d), FEED_WINDOW, FEED_SLIDE)
    return top_k(m, "total_volume", 1).select("window_start", "window_end", "rank", "symbol", "total_volume")


def q_top10_gain(spark: SparkSession, d: str) -> DataFrame:
    m = window_metrics(load_quotes(spark, d, key="user_id"), DAY_WINDOW, DAY_SLIDE)
    return top_k(m, "avg_gain", 10).select("window_start", "window_end", "rank", "symbol", "avg_gain")


def q_top10_sma(spark: SparkSession, d: str) -> DataFrame:
    m = window_metrics(load_quotes(spark, d, key="user_id"), DAY_WINDOW, DAY_SLIDE)
    return top_k(m, "sma_close", 10).select("window_start", "window_end", "rank", "symbol", "sma_close")


def q_window_report(spark: SparkSession, d: str) -> DataFrame:
    """Metrics and RSI of every symbol and feed window from one aggregation."""
    return window_report(load_quotes(spark, d), FEED_WINDOW, FEED_SLIDE)


def q_rsi_window(spark: SparkSession, d: str) -> DataFrame:
    r = rsi_window(load_quotes(spark, d), DAY_WINDOW, DAY_SLIDE)
    return r.select("window_start", "window_end", "symbol", "n_bars", "gain", "loss", "rsi")


def q_rsi_window_skip_first(spark: SparkSession, d: str) -> DataFrame:
    r = rsi_window(load_quotes(spark, d), DAY_WINDOW, DAY_SLIDE)
    return r.select("window_start", "window_end", "symbol", "n_bars", "rsi_skip_first")


def q_rsi_feed_window(spark: SparkSession, d: str) -> DataFrame:
    """Stateless RSI at the feed's own 10-minute / 5-minute windows."""
    r = rsi_window(load_quotes(spark, d), FEED_WINDOW, FEED_SLIDE)
    return r.select("window_start", "window_end", "symbol", "n_bars", "gain", "loss", "rsi", "rsi_skip_first")


def q_rsi_hourly(spark: SparkSession, d: str) -> DataFrame:
    """Stateless RSI in one-hour windows moved every 5 minutes (12 windows per
    bar): changes are summed per bucket triple before the windows."""
    r = rsi_window(load_quotes(spark, d), "1 hour", FEED_SLIDE)
    return r.select("window_start", "window_end", "symbol", "n_bars", "gain", "loss", "rsi", "rsi_skip_first")


def q_rsi_users(spark: SparkSession, d: str) -> DataFrame:
    """Stateless RSI over many keys (one per user)."""
    r = rsi_window(load_quotes(spark, d, key="user_id"), DAY_WINDOW, DAY_SLIDE)
    return r.select("window_start", "window_end", "symbol", "n_bars", "gain", "loss", "rsi")


def _smoothed(spark: SparkSession, d: str, mode: str, key: str = "event_type") -> DataFrame:
    r = rsi_smoothed(load_quotes(spark, d, key=key), DAY_WINDOW, DAY_SLIDE, mode=mode)
    return r.select("window_start", "window_end", "symbol", "n_bars",
                    F.round("rsi", RSI_DIGITS).alias("rsi"))


def q_rsi_wilder(spark: SparkSession, d: str) -> DataFrame:
    return _smoothed(spark, d, "wilder")


def q_rsi_undivided(spark: SparkSession, d: str) -> DataFrame:
    return _smoothed(spark, d, "undivided")


def q_rsi_undivided_long(spark: SparkSession, d: str) -> DataFrame:
    """The undivided update over some 360 windows of a key, whose averages leave
    the range of doubles while their ratio does not."""
    r = rsi_smoothed(load_quotes(spark, d), "4 hours", "2 hours", mode="undivided")
    return r.select("window_start", "window_end", "symbol", "n_bars", F.round("rsi", RSI_DIGITS).alias("rsi"))


def q_rsi_carry_forward(spark: SparkSession, d: str) -> DataFrame:
    quotes = load_quotes(spark, d, key="user_id")
    summaries = cut_lineage(window_changes(quotes, DAY_WINDOW, DAY_SLIDE))
    smoothed = rsi_smoothed(quotes, mode="wilder", summaries=summaries).select(
        "symbol", "window_start", F.round("rsi", RSI_DIGITS).alias("rsi"))
    return carry_forward(smoothed, summaries.select("symbol", "window_start"), DAY_SLIDE, DAY_WINDOW)


def q_profit(spark: SparkSession, d: str) -> DataFrame:
    return cumulative_profit(load_quotes(spark, d))


def q_profit_running(spark: SparkSession, d: str) -> DataFrame:
    return running_profit(load_quotes(spark, d), FEED_SLIDE)


def q_profit_parity(spark: SparkSession, d: str) -> DataFrame:
    return profit_parity(load_quotes(spark, d), FEED_WINDOW, FEED_SLIDE)


def q_profit_running_carried(spark: SparkSession, d: str) -> DataFrame:
    return running_profit_carried(load_quotes(spark, d), FEED_SLIDE)


def q_profit_nulls(spark: SparkSession, d: str) -> DataFrame:
    """Cumulative profit where every third close and every fifth open is missing."""
    q = load_quotes(spark, d)
    return cumulative_profit(q.withColumn("close", F.when(F.col("seq") % 3 != 0, F.col("close")))
                             .withColumn("open", F.when(F.col("seq") % 5 != 0, F.col("open"))))


def q_int_avg_volume_large(spark: SparkSession, d: str) -> DataFrame:
    """Integer mean volume per symbol with sums beyond 2^53, also beyond bigint: scaled
    volumes and sums are exact decimals.  NULL where a sum has more than 38 digits
    or the mean is no bigint."""
    scaled = F.col("volume").cast("decimal(19,0)") * F.lit("10000000000000").cast("decimal(14,0)")
    q = load_quotes(spark, d).groupBy("symbol").agg(
        F.try_sum(scaled + F.col("seq")).alias("total"), F.count("volume").alias("n"))
    return q.select("symbol", int_mean("total", "n").alias("int_avg_volume"))


def q_volume_overflow(spark: SparkSession, d: str) -> DataFrame:
    """Windows whose total volume may be no bigint: the job goes on, the total is
    NULL with a reason, the exact sum is kept and the mean is right."""
    q = load_quotes(spark, d).withColumn("volume", F.col("volume") * F.lit(3_000_000_000_000_000) + F.col("seq"))
    m = window_metrics(q, DAY_WINDOW, DAY_SLIDE, exact_volume=True)
    return m.select("window_start", "window_end", "symbol", F.col("total_volume").cast("string").alias("total_volume"), "int_avg_volume",
                    F.col("exact_volume").cast("string").alias("exact_volume"), "reason")


def arrivals(spark: SparkSession, d: str) -> DataFrame:
    """Quotes that arrive up to 25 minutes after their time, out of order."""
    return load_quotes(spark, d).withColumn("arrival_ts", F.col("ts") + F.make_dt_interval(secs=(F.col("seq") * 37) % 1500))


def q_arrival_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Window metrics by arrival time."""
    return window_metrics(arrivals(spark, d), FEED_WINDOW, FEED_SLIDE, time="arrival_ts")


def q_arrival_rsi(spark: SparkSession, d: str) -> DataFrame:
    """RSI of the quotes that arrived in a window, in the order of their own times."""
    r = rsi_window(arrivals(spark, d), "6 hours", "2 hours", member="arrival_ts")
    return r.select("window_start", "window_end", "symbol", "n_bars", "gain", "loss", "rsi", "rsi_skip_first")


def q_carry_intervals(spark: SparkSession, d: str) -> DataFrame:
    """The smoothed RSI of every user as intervals of validity."""
    quotes = load_quotes(spark, d, key="user_id")
    summaries = cut_lineage(window_changes(quotes, DAY_WINDOW, DAY_SLIDE))
    smoothed = rsi_smoothed(quotes, mode="wilder", summaries=summaries).select("symbol", "window_start", F.round("rsi", RSI_DIGITS).alias("rsi"))
    return carry_intervals(smoothed, summaries.select("symbol", "window_start"))


def q_count_runs(spark: SparkSession, d: str) -> DataFrame:
    """Quote counts of all windows, each gap one row."""
    return window_count_runs(load_quotes(spark, d), FEED_WINDOW, FEED_SLIDE)


def q_top_profit(spark: SparkSession, d: str) -> DataFrame:
    """The best of all known symbols at the end of every slide."""
    p = running_profit_carried(load_quotes(spark, d), FEED_SLIDE)
    return top_k(p, "cumulative_profit", 1, per=("window_end",)).select(
        "window_end", "rank", "symbol", "cumulative_profit")


def q_render(spark: SparkSession, d: str) -> DataFrame:
    q = with_high_low(load_quotes(spark, d))
    return q.select("symbol", "ts", "seq", render_quote().alias("text"))


def quote_lines(spark: SparkSession, d: str) -> DataFrame:
    """The quote feed as JSON-array text lines, rendered from ``events``."""
    return render_quote_lines(with_high_low(load_quotes(spark, d)))


def q_json_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    decoded = decode_quotes(quote_lines(spark, d).select("value")).quotes
    return decoded.select("symbol", F.col("ts").cast("timestamp_ntz").alias("ts"),
                          *_double("open", "high", "low", "close"), "volume")


def q_json_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Decode a feed with broken lines: every rendered line, the same line cut
    short, and the events' ``props`` objects (valid JSON, but not an array)."""
    # Only whole lines are broken here, so the quote position is always NULL.
    return decode_quotes(broken_feed(spark, d)).quarantine.select("line", "reason")


def dirty_lines(spark: SparkSession, d: str) -> DataFrame:
    """The feed with the close price written as the volume text: integral
    texts ("29.00") must be read as whole volumes, fractional ones rejected."""
    q = with_high_low(load_quotes(spark, d)).withColumn("volume", F.col("close"))
    return render_quote_lines(q).select("value")


def q_json_dirty_quotes(spark: SparkSession, d: str) -> DataFrame:
    """Quotes of the dirty feed: all kept, volume NULL where its text is fractional."""
    decoded = decode_quotes(dirty_lines(spark, d)).quotes
    # volume is shown as double so its NULLs read the same in every client.
    return decoded.select("symbol", F.col("ts").cast("timestamp_ntz").alias("ts"),
                          F.col("close").cast("double").alias("close"),
                          F.col("volume").cast("double").alias("volume"))


def q_json_dirty_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Quarantine of the dirty feed: one ``bad_volume`` row per fractional volume,
    with the quote's position in its line."""
    return decode_quotes(dirty_lines(spark, d)).quarantine


def broken_feed(spark: SparkSession, d: str) -> DataFrame:
    """Every rendered line, the same line cut short (rendered once, emitted
    twice), and the events' ``props`` objects."""
    good_and_cut = quote_lines(spark, d).select(
        F.explode(F.array(F.col("value"), F.expr("substring(value, 1, length(value) - 2)"))).alias("value"))
    objects = read_table(spark, d, "events").select(F.col("props").alias("value"))
    return good_and_cut.unionByName(objects)


def _quote_text(symbol: str, ts: str | None, **prices: str) -> str:
    """SQL for the JSON text of a quote; the arguments are SQL texts (NULL: ``null``)."""
    body = ", ',', ".join(f"""'"{k}":', coalesce({v}, 'null')""" for k, v in prices.items())
    time = f"""'"timestamp":"', {ts}, '",',""" if ts else ""
    return f"""concat('{{"symbol":"', {symbol}, '",', {time} '"priceData":{{', {body}, '}}}}')"""


def q_json_precise_prices(spark: SparkSession, d: str) -> DataFrame:
    """Prices of 6 decimals (unquoted) through the text feed, shown as exact text."""
    bars = bars_from_lineitem(spark, d)
    text = _quote_text("symbol", "date_format(ts, 'yyyy-MM-dd HH:mm:ss')", open="cast(open AS string)", close="cast(close AS string)",
                       volume="cast(volume * 1000000000000000 + seq AS string)")
    lines = bars.select("seq", F.concat(F.lit("["), F.expr(text), F.lit("]")).alias("value")).withColumnRenamed("seq", "bar")
    return decode_quotes(lines, keep=("bar",)).quotes.select(
        "bar", "symbol", F.col("open").cast("string").alias("open"), F.col("close").cast("string").alias("close"), "volume")


def partial_lines(spark: SparkSession, d: str) -> DataFrame:
    """One quote per line with, by the event id, a missing close, a bad open, a
    bad or missing time, no volume, no price data, no symbol, or no fault."""
    def t(c: str) -> str:
        return f"cast({c} AS string)"

    time = "date_format(ts, 'yyyy-MM-dd HH:mm:ss')"
    good = {"open": t("open"), "close": t("close"), "volume": t("volume")}
    forms = [_quote_text("symbol", time, **{**good, "close": "cast(NULL AS string)"}),
             _quote_text("symbol", time, **{**good, "open": """'"x"'"""}), _quote_text("symbol", "'noon'", **good),
             _quote_text("symbol", None, **good), _quote_text("symbol", time, open=good["open"], close=good["close"]),
             """concat('{"symbol":"', symbol, '"}')""", """concat('{"priceData":{"close":', cast(close AS string), '}}')""",
             _quote_text("symbol", time, **good)]
    cases = " ".join(f"WHEN {k} THEN {form}" for k, form in enumerate(forms))
    return load_quotes(spark, d).select(F.col("seq").alias("event_id"), F.expr(f"concat('[', CASE seq % 8 {cases} END, ']')").alias("value"))


def q_json_partial_quotes(spark: SparkSession, d: str) -> DataFrame:
    """Quotes with a faulty field are used without that field."""
    q = decode_quotes(partial_lines(spark, d), keep=("event_id",)).quotes
    return q.select("event_id", "symbol", F.col("ts").cast("timestamp_ntz").alias("ts"), *_double("open", "close", "volume"))


def q_json_partial_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """How many faults of each kind the same lines have."""
    return decode_quotes(partial_lines(spark, d)).quarantine.groupBy("reason").agg(F.count("*").alias("n"))


def q_json_mixed_array(spark: SparkSession, d: str) -> DataFrame:
    """Lines of a quote, a number, a null, a text and the quote again: both quotes are used."""
    text = _quote_text("symbol", "date_format(ts, 'yyyy-MM-dd HH:mm:ss')", open="cast(open AS string)",
                       close="cast(close AS string)", volume="cast(volume AS string)")
    lines = load_quotes(spark, d).select(F.col("seq").alias("event_id"), F.expr(text).alias("q")).select(
        "event_id", F.concat(F.lit("["), "q", F.lit(',1,null,"x",'), "q", F.lit("]")).alias("value"))
    return decode_quotes(lines, keep=("event_id",)).quotes.select("event_id", F.col("seq").alias("pos"), "symbol", *_double("close"))


def q_json_broken_elements(spark: SparkSession, d: str) -> DataFrame:
    """Lines of a quote, one with a name twice, one that breaks off in a value, and
    the quote again: only the middle ones are lost, each with its place."""
    text = _quote_text("symbol", "date_format(ts, 'yyyy-MM-dd HH:mm:ss')", open="cast(open AS string)",
                       close="cast(close AS string)", volume="cast(volume AS string)")
    lines = load_quotes(spark, d).select(F.col("seq").alias("event_id"), F.expr(text).alias("q")).select(
        "event_id", F.concat(F.lit("["), "q", F.lit(',{"symbol":"[},","symbol":"C"},{"symbol":1.2.3},'), "q", F.lit("]")).alias("value"))
    decoded = decode_quotes(lines, keep=("event_id",))
    good = decoded.quotes.select("event_id", F.col("seq").alias("pos"), "symbol", F.lit(None).cast("string").alias("reason"))
    bad = decode_quotes(lines.select("value")).quarantine.groupBy("pos", "reason").agg(F.count("*").alias("event_id"))
    return good.unionByName(bad.select("event_id", "pos", F.lit(None).cast("string").alias("symbol"), "reason"))


def q_json_trailing_text(spark: SparkSession, d: str) -> DataFrame:
    """Lines with text, a bracket or a second array after their array are reported."""
    lines = quote_lines(spark, d).select(F.explode(F.array(
        F.col("value"), F.concat("value", F.lit(" and more")), F.concat("value", F.lit("]")), F.concat("value", "value"),
        F.concat("value", F.lit(","), "value"), F.concat("value", F.lit(',"end"],[')), F.concat("value", F.lit(',"end"] and more')))).alias("value"))
    return decode_quotes(lines).quarantine.select("line", "reason")


def q_sorted_gain(spark: SparkSession, d: str) -> DataFrame:
    """All users of each window in descending order of their average gain."""
    m = window_metrics(load_quotes(spark, d, key="user_id"), DAY_WINDOW, DAY_SLIDE)
    return ranked(m, "avg_gain").select("window_start", "window_end", "rank", "symbol", "avg_gain")


def q_sink_text(spark: SparkSession, d: str) -> DataFrame:
    """The four text outputs per window, written and read back."""
    folder = f"{checkpoint_root(spark).rstrip('/')}/tickweave-text/{uuid.uuid4().hex}"
    write_window_text(window_report(load_quotes(spark, d), DAY_WINDOW, DAY_SLIDE), folder, TEXT_OUTPUTS)
    return read_window_text(spark, folder).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


BAR_WINDOW, BAR_SLIDE = "14 days", "7 days"


def q_lineitem_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Window metrics of ``lineitem`` bars with prices of 6 decimals."""
    return window_metrics(bars_from_lineitem(spark, d), BAR_WINDOW, BAR_SLIDE)


def q_lineitem_top10(spark: SparkSession, d: str) -> DataFrame:
    """The ten suppliers with the largest average change in each window."""
    m = window_metrics(bars_from_lineitem(spark, d, "l_suppkey"), BAR_WINDOW, BAR_SLIDE)
    return top_k(m, "avg_gain", 10).select("window_start", "window_end", "rank", "symbol", "avg_gain")


def q_lineitem_rsi(spark: SparkSession, d: str) -> DataFrame:
    """RSI of ``lineitem`` bars, where every fifth close is missing.  Line keys
    repeat in this table: the close orders bars of equal time and key."""
    bars = bars_from_lineitem(spark, d).withColumn("close", F.when(F.col("seq") % 5 != 0, F.col("close")))
    return rsi_window(bars, BAR_WINDOW, BAR_SLIDE, order=("seq", "close")).select(
        "window_start", "window_end", "symbol", "n_bars", "gain", "loss", "rsi")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn for name, fn in globals().items() if name.startswith("q_") and callable(fn)
}
