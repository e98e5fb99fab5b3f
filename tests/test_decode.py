"""JSON-array line decoding and the quarantine table (malformed-line cases)."""

from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickweave.sources.decode import decode_quotes

GOOD = ('{"symbol":"AAA","timestamp":"2024-01-02 09:31:00","priceData":'
        '{"open":10.0,"high":10.6,"low":9.9,"close":10.5,"volume":1200}}')


def quote(symbol="AAA", ts="2024-01-02 09:31:00", price=None, **over):
    p = {"open": "10.0", "high": "10.6", "low": "9.9", "close": "10.5", "volume": "1200"}
    p.update(over)
    body = ",".join(f'"{k}":{v}' for k, v in p.items())
    return f'{{"symbol":"{symbol}","timestamp":"{ts}","priceData":{{{body}}}}}'


def decode(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    d = decode_quotes(df)
    return d.quotes.collect(), d.quarantine.collect()


def test_good_line_with_two_quotes(spark):
    q, bad = decode(spark, [f"[{GOOD},{quote('BBB', close='11.25')}]"])
    assert not bad
    assert [(r["symbol"], r["seq"], r["close"], r["volume"]) for r in q] == [
        ("AAA", 0, Decimal("10.50"), 1200), ("BBB", 1, Decimal("11.25"), 1200)]
    assert str(q[0]["ts"]) == "2024-01-02 09:31:00"


def test_line_level_cases(spark):
    lines = ['[{"symbol":"A"', GOOD, "[null]", "[]", "", "   "]
    q, bad = decode(spark, lines)
    assert q == []
    reasons = sorted((r["line"], r["reason"], r["pos"]) for r in bad)
    assert reasons == sorted([('[{"symbol":"A"', "malformed", None), (GOOD, "not_array", None),
                              ("[null]", "null_element", 0)])


def test_quoted_and_integral_numbers_are_accepted(spark):
    q, bad = decode(spark, [f'[{quote(close=chr(34) + "1.5" + chr(34), volume="10.0")}]'])
    assert not bad
    assert q[0]["close"] == Decimal("1.50") and q[0]["volume"] == 10


def test_fractional_volume_keeps_quote_and_reports(spark):
    q, bad = decode(spark, [f"[{quote(volume='10.5')},{quote('BBB')}]"])
    assert [(r["symbol"], r["volume"]) for r in q] == [("AAA", None), ("BBB", 1200)]
    assert [(r["pos"], r["reason"]) for r in bad] == [(0, "bad_volume")]


def test_missing_price_data_and_bad_timestamp(spark):
    no_price = '{"symbol":"AAA","timestamp":"2024-01-02 09:31:00"}'
    q, bad = decode(spark, [f"[{no_price},{quote(ts='bad')},{quote(ts='2024-01-02 13:05:00')}]"])
    assert [(r["pos"], r["reason"]) for r in sorted(bad, key=lambda r: r["pos"])] == [
        (0, "missing_price_data"), (1, "bad_timestamp")]
    # The quote without a usable time counts where no time is needed; 13:05 is afternoon (24-hour clock).
    assert [str(r["ts"]) for r in q] == ["None", "2024-01-02 13:05:00"]


def test_missing_symbol_and_bad_price(spark):
    no_sym = '{"timestamp":"2024-01-02 09:31:00","priceData":{"open":1,"close":2}}'
    q, bad = decode(spark, [f'[{no_sym},{quote(close=chr(34) + "x" + chr(34))}]'])
    assert [(r["close"], r["open"], r["volume"]) for r in q] == [(None, Decimal("10.0"), 1200)]
    assert sorted((r["pos"], r["reason"]) for r in bad) == [(0, "missing_symbol"), (1, "bad_price")]


def test_prices_and_volumes_are_exact(spark):
    line = (f"[{quote(close='120.3456', open='0.0049')},{quote(close='10000000001.5', volume='9007199254740993')},"
            f"{quote(close='0.123456789')},{quote(close='0.1234567800000000000000001')},{quote(close='1e-30')},{quote(volume='9223372036854775808')}]")
    q, bad = decode(spark, [line])
    assert [(r["close"], r["open"]) for r in q[:2]] == [(Decimal("120.3456"), Decimal("0.0049")), (Decimal("10000000001.5"), Decimal("10.0"))]
    assert q[1]["volume"] == 9007199254740993
    assert [r["close"] for r in q[2:5]] == [None] * 3 and q[5]["volume"] is None
    assert [(r["pos"], r["reason"]) for r in bad] == [(2, "bad_price"), (3, "bad_price"), (4, "bad_price"), (5, "bad_volume")]


def test_good_elements_survive_bad_ones(spark):
    q, bad = decode(spark, [f'[{GOOD},1,null,"x",[2],{{}},{quote("BBB")}]'])
    assert [(r["symbol"], r["seq"]) for r in q] == [("AAA", 0), ("BBB", 6)]
    assert [(r["pos"], r["reason"]) for r in bad] == [
        (1, "bad_element"), (2, "null_element"), (3, "bad_element"), (4, "bad_element"), (5, "missing_symbol")]


def test_text_after_the_array_is_reported(spark):
    lines = [f"[{GOOD}] more", f"[{GOOD}][{GOOD}]", f"[{GOOD}],[{GOOD}]", f"[{GOOD}]]", f'[{GOOD}],"end"']
    q, bad = decode(spark, lines)
    assert q == [] and sorted(r["line"] for r in bad) == sorted(lines) and {r["reason"] for r in bad} == {"trailing_text"}


def test_every_faulty_field_is_reported(spark):
    one = '{"symbol":"AAA","priceData":{"close":1.5,"open":"x","volume":"y"}}'
    q, bad = decode(spark, [f"[{one}]"])
    assert [(r["close"], r["open"], r["volume"], r["ts"]) for r in q] == [(Decimal("1.5"), None, None, None)]
    assert sorted(r["reason"] for r in bad) == ["bad_price", "bad_volume", "missing_timestamp"]


def test_times_with_single_digits_and_fractions(spark):
    q, bad = decode(spark, [f"[{quote(ts='2024-01-02 9:31:00')},{quote(ts='2024-01-02 09:31:00.500')}]"])
    assert not bad
    assert [str(r["ts"]) for r in q] == ["2024-01-02 09:31:00", "2024-01-02 09:31:00.500000"]


def test_one_scan_for_each_output(spark, scratch):
    spark.createDataFrame([(f"[{GOOD}]",)], "value string").write.mode("overwrite").text(scratch)
    d = decode_quotes(spark.read.text(scratch))
    for df in d:
        assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


_field = st.one_of(st.just('"1.5"'), st.just("2"), st.just("10.5"), st.just('"x"'), st.just("null"),
                   st.just("{}"), st.just("[1]"))
_ts = st.sampled_from(["2024-01-02 09:31:00", "2024-01-02 23:59:59", "bad", "", "2024-13-40 25:61:61"])
_quote = st.builds(lambda s, t, o, c, v: f'{{"symbol":{s},"timestamp":"{t}","priceData":'
                                          f'{{"open":{o},"close":{c},"volume":{v}}}}}',
                   st.sampled_from(['"A"', '"B"', "null", "7"]), _ts, _field, _field, _field)
_line = st.one_of(
    st.lists(_quote, min_size=1, max_size=4).map(lambda qs: "[" + ",".join(qs) + "]"),
    st.lists(_quote, min_size=1, max_size=3).map(lambda qs: "[" + ",".join(qs) + "]").map(lambda s: s[:-3]),
    _quote, st.text(max_size=30), st.just("[null]"), st.just("[]"), st.just("   "))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(lines=st.lists(_line, min_size=1, max_size=25))
def test_no_line_is_silently_lost(spark, lines):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "line_id long, value string")
    d = decode_quotes(df, keep=("line_id",))
    quoted = {r[0] for r in d.quotes.select("line_id").collect()}
    quarantined = {r[0] for r in d.quarantine.select("line").collect()}
    for i, text in enumerate(lines):
        if not text.strip() or text.strip().replace(" ", "") == "[]":
            continue
        assert i in quoted or text in quarantined, text
    # every emitted quote has a symbol and its line a report for each missing field
    assert d.quotes.where(F.col("symbol").isNull()).count() == 0
    odd = d.quotes.where(F.col("ts").isNull() | F.col("open").isNull() | F.col("close").isNull() | F.col("volume").isNull())
    assert {lines[r[0]] for r in odd.select("line_id").collect()} <= quarantined
