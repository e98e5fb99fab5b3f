"""Independent SQL (DuckDB dialect) for every query in ``tickweave.plans.catalog``.

Written from the query definitions, not from the Spark plans: sliding windows
are expanded with ``time_bucket`` (origin 1970-01-01, like Spark's
``window``), changes come from ``lag`` inside each window, the smoothed RSI
from a recursive CTE, carried values from a generated grid.
"""

from __future__ import annotations

QUOTES = """quotes AS (
  SELECT CAST({key} AS VARCHAR) AS symbol, ts, event_id AS seq,
         CAST(CAST(value AS DECIMAL(12,2)) + (CAST(event_id % 7 AS INTEGER) - 3) AS DECIMAL(12,2)) AS open,
         CAST(value AS DECIMAL(12,2)) AS close,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS volume
  FROM events)"""


def _quotes(key: str = "event_type") -> str:
    return QUOTES.format(key=key)


def _win(slide: str, ratio: int, src: str = "quotes") -> str:
    """Sliding-window expansion: each row once per window that contains it."""
    return f"""win AS (
  SELECT q.*, time_bucket(INTERVAL '{slide}', q.ts, TIMESTAMP '1970-01-01') - r.k * INTERVAL '{slide}' AS window_start
  FROM {src} q, range({ratio}) r(k))"""


FEED = ("5 minutes", 2, "10 minutes")
DAY = ("12 hours", 2, "1 day")


#: ``lineitem`` as bars of another shape, prices with 6 decimals.
BARS = """quotes AS (
  SELECT CAST({key} AS VARCHAR) AS symbol, l_shipdate AS ts, l_orderkey * 8 + l_linenumber AS seq,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(20,8)) AS open,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(1 - CAST(l_discount AS DECIMAL(3,2)) AS DECIMAL(3,2))
              * CAST(1 + CAST(l_tax AS DECIMAL(3,2)) AS DECIMAL(3,2)) AS DECIMAL(20,8)) AS close,
         CAST(l_quantity AS BIGINT) AS volume
  FROM lineitem)"""
BAR = ("7 days", 2, "14 days")


def _metrics(key: str = "event_type", w=FEED, quotes: str = QUOTES) -> str:
    slide, ratio, length = w
    return f"""WITH {quotes.format(key=key)}, {_win(slide, ratio)},
m AS (
  SELECT window_start, window_start + INTERVAL '{length}' AS window_end, symbol,
         count(*) AS n_quotes,
         CAST(sum(close) AS DOUBLE) / count(close) AS sma_close,
         CAST(sum(close - open) AS DOUBLE) / count(close - open) AS avg_gain,
         CAST(sum(volume) AS BIGINT) AS total_volume,
         CAST(sum(volume) // count(volume) AS BIGINT) AS int_avg_volume
  FROM win GROUP BY window_start, symbol)
"""


def _top(metric: str, k: int, key: str = "event_type", w=FEED, quotes: str = QUOTES) -> str:
    return _metrics(key, w, quotes) + f"""SELECT window_start, window_end, rank, symbol, {metric} FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY window_start, window_end
                                    ORDER BY {metric} DESC NULLS LAST, symbol) AS BIGINT) AS rank
  FROM m) t WHERE rank <= {k}"""


def _changes(key: str = "event_type", w=DAY) -> str:
    slide, ratio, length = w
    return f"""{_quotes(key)}, {_win(slide, ratio)},
{_changes_body(length)}"""


def _changes_body(length: str) -> str:
    """Changes inside each window of ``win`` and their per-window sums ``s``."""
    return f"""c AS (
  SELECT window_start, symbol, close - lag(close) OVER (PARTITION BY symbol, window_start ORDER BY ts, seq) AS change,
         row_number() OVER (PARTITION BY symbol, window_start ORDER BY ts, seq) AS i
  FROM win),
s AS (
  SELECT window_start, window_start + INTERVAL '{length}' AS window_end, symbol,
         count(*) AS n_bars, count(change) AS n_changes,
         CAST(sum(CASE WHEN change > 0 THEN change ELSE 0 END) AS DOUBLE) AS gain,
         CAST(sum(CASE WHEN change < 0 THEN -change ELSE 0 END) AS DOUBLE) AS loss,
         CAST(sum(CASE WHEN i >= 3 AND change > 0 THEN change ELSE 0 END) AS DOUBLE) AS gain2,
         CAST(sum(CASE WHEN i >= 3 AND change < 0 THEN -change ELSE 0 END) AS DOUBLE) AS loss2
  FROM c GROUP BY window_start, symbol)"""


def _rsi(g: str, l_: str) -> str:
    return (f"CASE WHEN {g} + {l_} > 0 AND NOT isnan({g} / ({g} + {l_})) "
            f"THEN 100.0 * ({g} / ({g} + {l_})) END")


def _rsi_window(key: str = "event_type", w=DAY, cols: str = "gain, loss, rsi") -> str:
    return f"""WITH {_changes(key, w)},
r AS (
  SELECT window_start, window_end, symbol, n_bars, gain, loss,
         CASE WHEN n_bars >= 2 THEN {_rsi('gain', 'loss')} END AS rsi,
         CASE WHEN n_bars >= 2 THEN {_rsi('gain2', 'loss2')} END AS rsi_skip_first
  FROM s)
SELECT window_start, window_end, symbol, n_bars, {cols} FROM r"""


def _smoothed(mode: str, key: str = "event_type", w=DAY) -> str:
    if mode == "wilder":
        first = "gain / (n_changes + 1), loss / (n_changes + 1)"
        step = ("(r.g * e.n_changes + e.gain) / (e.n_changes + 1)",
                "(r.l * e.n_changes + e.loss) / (e.n_changes + 1)")
    else:
        first = "gain, loss"
        step = ("r.g * e.n_changes + e.gain", "r.l * e.n_changes + e.loss")
    return f"""{_changes(key, w)},
e AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY window_start) AS k
  FROM s WHERE n_changes >= 1),
rec(symbol, k, g, l) AS (
  SELECT symbol, k, {first} FROM e WHERE k = 1
  UNION ALL
  SELECT e.symbol, e.k, {step[0]}, {step[1]}
  FROM rec r JOIN e ON e.symbol = r.symbol AND e.k = r.k + 1),
sm AS (
  SELECT e.window_start, e.window_end, e.symbol, e.n_changes + 1 AS n_bars,
         round({_rsi('rec.g', 'rec.l')}, 6) AS rsi
  FROM e JOIN rec USING (symbol, k))"""


def _undivided_scaled(w=("2 hours", 2, "4 hours")) -> str:
    """The undivided update with gain and loss brought to sum 1 after each step
    and the logarithm ``t`` of the factor taken out so far."""
    g, l_ = "(r.g * e.n_changes + e.gain * exp(-r.t))", "(r.l * e.n_changes + e.loss * exp(-r.t))"
    total = f"CASE WHEN {g} + {l_} > 0 THEN {g} + {l_} ELSE 1.0 END"
    return f"""WITH RECURSIVE {_changes(w=w)},
e AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY window_start) AS k
  FROM s WHERE n_changes >= 1),
rec(symbol, k, g, l, t) AS (
  SELECT symbol, k, gain, loss, CAST(0 AS DOUBLE) FROM e WHERE k = 1
  UNION ALL
  SELECT e.symbol, e.k, {g} / ({total}), {l_} / ({total}), r.t + ln({total})
  FROM rec r JOIN e ON e.symbol = r.symbol AND e.k = r.k + 1)
SELECT e.window_start, e.window_end, e.symbol, e.n_changes + 1 AS n_bars, round({_rsi('rec.g', 'rec.l')}, 6) AS rsi
FROM e JOIN rec USING (symbol, k)"""


def _carry(key: str = "user_id", w=DAY) -> str:
    slide, _, length = w
    return f"""WITH RECURSIVE {_smoothed('wilder', key, w)},
firsts AS (SELECT symbol, min(window_start) AS first_start FROM s GROUP BY symbol),
last AS (SELECT max(window_start) AS last_start FROM s),
grid AS (
  SELECT f.symbol, unnest(generate_series(f.first_start, l.last_start, INTERVAL '{slide}')) AS window_start
  FROM firsts f, last l)
SELECT g.symbol, g.window_start, g.window_start + INTERVAL '{length}' AS window_end,
       last_value(sm.rsi IGNORE NULLS) OVER (PARTITION BY g.symbol ORDER BY g.window_start
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rsi
FROM grid g LEFT JOIN sm ON sm.symbol = g.symbol AND sm.window_start = g.window_start"""


def _profit_running() -> str:
    return f"""WITH {_quotes()},
b AS (
  SELECT symbol, time_bucket(INTERVAL '5 minutes', ts, TIMESTAMP '1970-01-01') + INTERVAL '5 minutes' AS window_end,
         sum(close) AS sc, sum(open) AS so, count(*) AS n
  FROM quotes GROUP BY ALL),
r AS (
  SELECT symbol, window_end,
         CAST(sum(n) OVER w AS BIGINT) AS n_quotes,
         CAST(sum(sc) OVER w AS DOUBLE) / sum(n) OVER w - CAST(sum(so) OVER w AS DOUBLE) / sum(n) OVER w
           AS cumulative_profit
  FROM b WINDOW w AS (PARTITION BY symbol ORDER BY window_end ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""


def _profit_carried() -> str:
    """Every known symbol at every slide end, from its first slide on."""
    return _profit_running().rstrip() + """,
ends AS (
  SELECT symbol, unnest(generate_series(first_end, (SELECT max(window_end) FROM r), INTERVAL '5 minutes')) AS window_end
  FROM (SELECT symbol, min(window_end) AS first_end FROM r GROUP BY symbol)),
c AS (
  SELECT e.symbol, e.window_end,
         last_value(r.n_quotes IGNORE NULLS) OVER k AS n_quotes,
         last_value(r.cumulative_profit IGNORE NULLS) OVER k AS cumulative_profit
  FROM ends e LEFT JOIN r ON r.symbol = e.symbol AND r.window_end = e.window_end
  WINDOW k AS (PARTITION BY e.symbol ORDER BY e.window_end ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""


def _json_lines(volume: str = "CAST(volume AS VARCHAR)") -> str:
    obj = ("'{\"symbol\":\"' || symbol || '\",\"timestamp\":\"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || "
           "'\",\"priceData\":{\"open\":\"' || CAST(open AS VARCHAR) || '\",\"high\":\"' || "
           "CAST(greatest(open, close) AS VARCHAR) || '\",\"low\":\"' || CAST(least(open, close) AS VARCHAR) || "
           "'\",\"close\":\"' || CAST(close AS VARCHAR) || '\",\"volume\":\"' || " + volume + " || '\"}}'")
    return f"""{_quotes()},
lines AS (
  SELECT symbol, floor(seq / 64) AS b, '[' || string_agg({obj}, ',' ORDER BY seq) || ']' AS line
  FROM quotes GROUP BY symbol, floor(seq / 64))"""


def _fed(week: bool = True) -> str:
    """The streamed feed: times in seconds, and the place of a quote in its line."""
    by = "symbol, floor(seq / 64)" + (", datediff('day', DATE '1970-01-01', CAST(ts AS DATE)) // 7" if week else "")
    return f"""{_quotes()},
fed AS (
  SELECT symbol, date_trunc('second', ts) AS ts, row_number() OVER (PARTITION BY {by} ORDER BY seq) - 1 AS pos, seq, open, close, volume
  FROM quotes)"""


def _closed_windows(slide: str, ratio: int, length: str, delay: str, src: str = "fed", axis: str = "ts") -> str:
    """The windows of ``src`` that are closed ``delay`` after the latest time, with
    their metrics and the sums of their changes (bars ordered as decoded)."""
    return f"""{_win(slide, ratio, f"(SELECT * EXCLUDE (ts), ts AS quote_ts, {axis} AS ts FROM {src})")},
seen AS (
  SELECT * FROM win WHERE ts < window_start + INTERVAL '{length}'
  AND window_start + INTERVAL '{length}' <= (SELECT max({axis}) FROM {src}) - INTERVAL '{delay}'),
c AS (
  SELECT *, close - lag(close) OVER k AS change, row_number() OVER k AS i
  FROM seen WINDOW k AS (PARTITION BY symbol, window_start ORDER BY quote_ts, pos, close)),
s AS (
  SELECT window_start, window_start + INTERVAL '{length}' AS window_end, symbol,
         count(*) AS n_bars, count(change) AS n_changes,
         CAST(sum(close) AS DOUBLE) / count(close) AS sma_close, CAST(sum(close - open) AS DOUBLE) / count(close - open) AS avg_gain,
         CAST(sum(volume) AS BIGINT) AS total_volume, CAST(sum(volume) // count(volume) AS BIGINT) AS int_avg_volume,
         CAST(sum(CASE WHEN change > 0 THEN change ELSE 0 END) AS DOUBLE) AS gain,
         CAST(sum(CASE WHEN change < 0 THEN -change ELSE 0 END) AS DOUBLE) AS loss,
         CAST(sum(CASE WHEN i >= 3 AND change > 0 THEN change ELSE 0 END) AS DOUBLE) AS gain2,
         CAST(sum(CASE WHEN i >= 3 AND change < 0 THEN -change ELSE 0 END) AS DOUBLE) AS loss2
  FROM c GROUP BY window_start, symbol)"""


DAY_CLOSED = ("12 hours", 2, "1 day", "12 hours")
STREAM_METRICS = "window_start, window_end, symbol, n_bars AS n_quotes, sma_close, avg_gain, total_volume, int_avg_volume"


def _stream_metrics(w, more: str = "", fed: str = "", axis: str = "ts") -> str:
    return f"WITH {fed or _fed()}, {_closed_windows(*w, axis=axis)}\nSELECT {STREAM_METRICS}{more} FROM s"


def _stream_rsi(w=DAY_CLOSED, fed: str = "", axis: str = "ts") -> str:
    return f"""WITH {fed or _fed()}, {_closed_windows(*w, axis=axis)}
SELECT window_start, window_end, symbol, n_bars, gain, loss,
       CASE WHEN n_bars >= 2 THEN {_rsi('gain', 'loss')} END AS rsi,
       CASE WHEN n_bars >= 2 THEN {_rsi('gain2', 'loss2')} END AS rsi_skip_first
FROM s"""


def _stream_fold() -> str:
    return f"""WITH RECURSIVE {_fed()}, {_closed_windows(*DAY_CLOSED)},
e AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY window_start) AS k
  FROM s WHERE n_changes >= 1),
rec(symbol, k, g, l) AS (
  SELECT symbol, k, gain / (n_changes + 1), loss / (n_changes + 1) FROM e WHERE k = 1
  UNION ALL
  SELECT e.symbol, e.k, (r.g * e.n_changes + e.gain) / (e.n_changes + 1),
         (r.l * e.n_changes + e.loss) / (e.n_changes + 1)
  FROM rec r JOIN e ON e.symbol = r.symbol AND e.k = r.k + 1),
sm AS (
  SELECT e.window_start, e.window_end, e.symbol, e.n_changes + 1 AS n_bars, round({_rsi('rec.g', 'rec.l')}, 6) AS rsi
  FROM e JOIN rec USING (symbol, k))"""


#: The feed of the arrival queries: a block of 64 quotes a minute.
ARRIVED = _fed(week=False).replace("pos, seq,", "pos, seq, TIMESTAMP '2024-03-09 16:00:00' + CAST(floor(seq / 64) AS BIGINT) * INTERVAL '1 minute' AS arrival_ts,")
ARRIVED_CLOSED = ("5 minutes", 2, "10 minutes", "2 minutes")


#: Quotes with the time of their arrival, up to 25 minutes later.
ARRIVALS = f"""{_quotes()},
arrived AS (SELECT * EXCLUDE (ts), ts AS quote_ts, ts + ((seq * 37) % 1500) * INTERVAL '1 second' AS ts FROM quotes)"""


def _arrival_metrics() -> str:
    return f"""WITH {ARRIVALS}, {_win('5 minutes', 2, 'arrived')}
SELECT window_start, window_start + INTERVAL '10 minutes' AS window_end, symbol, count(*) AS n_quotes,
       CAST(sum(close) AS DOUBLE) / count(close) AS sma_close, CAST(sum(close - open) AS DOUBLE) / count(close - open) AS avg_gain,
       CAST(sum(volume) AS BIGINT) AS total_volume, CAST(sum(volume) // count(volume) AS BIGINT) AS int_avg_volume
FROM win GROUP BY window_start, symbol"""


def _arrival_rsi() -> str:
    changes = _changes_body("6 hours").replace("ORDER BY ts, seq", "ORDER BY quote_ts, seq")
    return f"""WITH {ARRIVALS}, {_win('2 hours', 3, 'arrived')},
{changes}
SELECT window_start, window_end, symbol, n_bars, gain, loss,
       CASE WHEN n_bars >= 2 THEN {_rsi('gain', 'loss')} END AS rsi,
       CASE WHEN n_bars >= 2 THEN {_rsi('gain2', 'loss2')} END AS rsi_skip_first
FROM s"""


def _carry_intervals(smoothed: str = "") -> str:
    return f"""{smoothed or f"WITH RECURSIVE {_smoothed('wilder', 'user_id', DAY)}"},
points AS (
  SELECT symbol, min(window_start) AS valid_from, CAST(NULL AS DOUBLE) AS rsi, 0 AS has FROM s GROUP BY symbol
  UNION ALL SELECT symbol, window_start, rsi, 1 FROM sm WHERE rsi IS NOT NULL),
spans AS (SELECT *, lead(valid_from) OVER (PARTITION BY symbol ORDER BY valid_from, has) AS valid_to FROM points)
SELECT symbol, valid_from, valid_to, rsi FROM spans WHERE valid_to IS NULL OR valid_from < valid_to"""


def _count_runs() -> str:
    return f"""WITH {_quotes()}, {_win('5 minutes', 2)},
n AS (SELECT window_start, count(*) AS n_quotes FROM win GROUP BY window_start),
g AS (SELECT *, datediff('minute', window_start, lead(window_start) OVER (ORDER BY window_start)) // 5 - 1 AS gap FROM n)
SELECT window_start, CAST(1 AS BIGINT) AS n_windows, n_quotes FROM g
UNION ALL SELECT window_start + INTERVAL '5 minutes', gap, 0 FROM g WHERE gap > 0"""


def _volume_overflow() -> str:
    return f"""WITH {_quotes()}, {_win('12 hours', 2)},
t AS (SELECT window_start, symbol, sum(CAST(volume AS HUGEINT) * 3000000000000000 + seq)::HUGEINT AS total, count(volume) AS n
      FROM win GROUP BY window_start, symbol)
SELECT window_start, window_start + INTERVAL '1 day' AS window_end, symbol,
       CASE WHEN total <= 9223372036854775807 THEN CAST(total AS VARCHAR) END AS total_volume, CAST(total // n AS BIGINT) AS int_avg_volume,
       CAST(total AS VARCHAR) AS exact_volume, CASE WHEN total > 9223372036854775807 THEN 'volume_overflow' END AS reason FROM t"""


ORACLE_SQL: dict[str, str] = {
    "q_arrival_metrics": _arrival_metrics(),
    "q_arrival_rsi": _arrival_rsi(),
    "q_carry_intervals": _carry_intervals(),
    "q_count_runs": _count_runs(),
    "q_volume_overflow": _volume_overflow(),
    "q_quotes": f"""WITH {_quotes()}
SELECT symbol, ts, seq, CAST(open AS DOUBLE) AS open, CAST(close AS DOUBLE) AS close, volume FROM quotes""",
    "q_gain": f"""WITH {_quotes()}
SELECT symbol, ts, seq, CAST(close - open AS DOUBLE) AS gain FROM quotes""",
    "q_window_metrics": _metrics() + "SELECT * FROM m",
    "q_sma_close": _metrics() + "SELECT window_start, window_end, symbol, sma_close, total_volume FROM m",
    "q_sma_close_users": _metrics("user_id")
    + "SELECT window_start, window_end, symbol, n_quotes, sma_close, total_volume FROM m",
    "q_sma_hourly": _metrics(w=("5 minutes", 12, "1 hour"))
    + "SELECT window_start, window_end, symbol, n_quotes, sma_close, avg_gain, total_volume FROM m",
    "q_avg_gain": _metrics() + "SELECT window_start, window_end, symbol, avg_gain FROM m",
    "q_quote_count": f"""WITH {_quotes()}, {_win('5 minutes', 2)}
SELECT window_start, window_start + INTERVAL '10 minutes' AS window_end, count(*) AS n_quotes
FROM win GROUP BY window_start""",
    "q_quote_count_filled": f"""WITH {_quotes()}, {_win('5 minutes', 2)},
c AS (SELECT window_start, count(*) AS n FROM win GROUP BY window_start),
g AS (SELECT unnest(generate_series((SELECT min(window_start) FROM c), (SELECT max(window_start) FROM c),
                                    INTERVAL '5 minutes')) AS window_start)
SELECT g.window_start, g.window_start + INTERVAL '10 minutes' AS window_end,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n_quotes
FROM g LEFT JOIN c USING (window_start)""",
    "q_int_avg_volume": _metrics() + "SELECT window_start, window_end, symbol, int_avg_volume FROM m",
    "q_top_gainer": _top("avg_gain", 1),
    "q_top_volume": _top("total_volume", 1),
    "q_top10_gain": _top("avg_gain", 10, "user_id", DAY),
    "q_top10_sma": _top("sma_close", 10, "user_id", DAY),
    "q_window_report": _metrics().rstrip() + f""",
{_changes_body('10 minutes')},
r AS (
  SELECT window_start, symbol, gain, loss,
         CASE WHEN n_bars >= 2 THEN {_rsi('gain', 'loss')} END AS rsi,
         CASE WHEN n_bars >= 2 THEN {_rsi('gain2', 'loss2')} END AS rsi_skip_first
  FROM s)
SELECT m.*, r.gain, r.loss, r.rsi, r.rsi_skip_first
FROM m JOIN r USING (window_start, symbol)""",
    "q_rsi_window": _rsi_window(),
    "q_rsi_window_skip_first": _rsi_window(cols="rsi_skip_first"),
    "q_rsi_feed_window": _rsi_window(w=FEED, cols="gain, loss, rsi, rsi_skip_first"),
    "q_rsi_hourly": _rsi_window(w=("5 minutes", 12, "1 hour"), cols="gain, loss, rsi, rsi_skip_first"),
    "q_rsi_users": _rsi_window("user_id"),
    "q_rsi_wilder": "WITH RECURSIVE " + _smoothed("wilder") + "\nSELECT * FROM sm",
    "q_rsi_undivided_long": _undivided_scaled(),
    "q_rsi_undivided": "WITH RECURSIVE " + _smoothed("undivided") + "\nSELECT * FROM sm",
    "q_rsi_carry_forward": _carry(),
    "q_profit": f"""WITH {_quotes()}
SELECT symbol, count(*) AS n_quotes, CAST(sum(close) AS DOUBLE) / count(*) AS avg_close,
       CAST(sum(open) AS DOUBLE) / count(*) AS avg_open,
       CAST(sum(close) AS DOUBLE) / count(*) - CAST(sum(open) AS DOUBLE) / count(*) AS cumulative_profit
FROM quotes GROUP BY symbol""",
    "q_profit_nulls": f"""WITH {_quotes()}
SELECT symbol, count(*) AS n_quotes, CAST(sum(c) AS DOUBLE) / count(c) AS avg_close, CAST(sum(o) AS DOUBLE) / count(o) AS avg_open,
       CAST(sum(c) AS DOUBLE) / count(c) - CAST(sum(o) AS DOUBLE) / count(o) AS cumulative_profit
FROM (SELECT symbol, CASE WHEN seq % 3 <> 0 THEN close END AS c, CASE WHEN seq % 5 <> 0 THEN open END AS o FROM quotes)
GROUP BY symbol""",
    "q_int_avg_volume_large": f"""WITH {_quotes()}
SELECT symbol, CAST(sum(volume * 10000000000000 + seq) // count(volume) AS BIGINT) AS int_avg_volume FROM quotes GROUP BY symbol""",
    "q_profit_running_carried": _profit_carried() + "SELECT * FROM c",
    "q_profit_running": _profit_running() + "SELECT * FROM r",
    "q_profit_parity": f"""WITH {_quotes()}, {_win('5 minutes', 2)},
p AS (
  SELECT symbol, window_start, sum(close) AS sc, sum(open) AS so, count(*) - 1 AS n
  FROM win GROUP BY ALL),
r AS (
  SELECT symbol, window_start, window_start + INTERVAL '10 minutes' AS window_end,
         CAST(sum(n) OVER w AS BIGINT) AS n_counted,
         CAST(sum(sc) OVER w AS DOUBLE) AS tc, CAST(sum(so) OVER w AS DOUBLE) AS tco
  FROM p WINDOW w AS (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT symbol, window_start, window_end, n_counted,
       CASE WHEN n_counted <> 0 THEN tc / n_counted - tco / n_counted END AS cumulative_profit
FROM r""",
    "q_top_profit": _profit_carried() + """SELECT window_end, rank, symbol, cumulative_profit FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY window_end
                                    ORDER BY cumulative_profit DESC NULLS LAST, symbol) AS BIGINT) AS rank
  FROM c) t WHERE rank = 1""",
    "q_render": f"""WITH {_quotes()}
SELECT symbol, ts, seq,
       symbol || ' - ' || strftime(ts, '%Y-%m-%d %H:%M:%S') || ' (' ||
       concat_ws(' - ', CAST(open AS VARCHAR), CAST(greatest(open, close) AS VARCHAR),
                 CAST(least(open, close) AS VARCHAR), CAST(close AS VARCHAR), CAST(volume AS VARCHAR)) || ')' AS text
FROM quotes""",
    "q_json_roundtrip": f"""WITH {_quotes()}
SELECT symbol, date_trunc('second', ts) AS ts, CAST(open AS DOUBLE) AS open,
       CAST(greatest(open, close) AS DOUBLE) AS high, CAST(least(open, close) AS DOUBLE) AS low,
       CAST(close AS DOUBLE) AS close, volume
FROM quotes""",
    "q_json_dirty_quotes": f"""WITH {_quotes()}
SELECT symbol, date_trunc('second', ts) AS ts, CAST(close AS DOUBLE) AS close,
       CASE WHEN close = floor(close) THEN CAST(CAST(close AS BIGINT) AS DOUBLE) END AS volume
FROM quotes""",
    "q_json_dirty_quarantine": f"""WITH {_json_lines("CAST(close AS VARCHAR)")},
pos AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY symbol, floor(seq / 64) ORDER BY seq) - 1 AS BIGINT) AS pos
  FROM quotes)
SELECT l.line, p.pos, 'bad_volume' AS reason
FROM pos p JOIN (SELECT symbol AS s, b, line FROM lines) l ON l.s = p.symbol AND l.b = floor(p.seq / 64)
WHERE p.close <> floor(p.close)""",
    "q_stream_sliding": _stream_metrics(("4 minutes", 3, "10 minutes", "1 hour"), f", CASE WHEN n_bars >= 2 THEN {_rsi('gain', 'loss')} END AS rsi"),
    "q_stream_rsi_window": _stream_rsi(),
    "q_stream_rsi_smoothed": _stream_fold() + "SELECT * FROM sm",
    "q_stream_carried": _carry_intervals(_stream_fold()),
    "q_stream_arrival_metrics": _stream_metrics(ARRIVED_CLOSED, fed=ARRIVED, axis="arrival_ts"),
    "q_stream_arrival_rsi": _stream_rsi(ARRIVED_CLOSED, ARRIVED, "arrival_ts"),
    "q_json_precise_prices": f"""WITH {BARS.format(key='l_returnflag')}
SELECT seq AS bar, symbol, CAST(open AS VARCHAR) AS open, CAST(close AS VARCHAR) AS close,
       volume * 1000000000000000 + seq AS volume FROM quotes""",
    "q_json_partial_quotes": f"""WITH {_quotes()}
SELECT seq AS event_id, symbol, CASE WHEN seq % 8 NOT IN (2, 3) THEN date_trunc('second', ts) END AS ts,
       CASE WHEN seq % 8 <> 1 THEN CAST(open AS DOUBLE) END AS open, CASE WHEN seq % 8 <> 0 THEN CAST(close AS DOUBLE) END AS close,
       CASE WHEN seq % 8 <> 4 THEN CAST(volume AS DOUBLE) END AS volume
FROM quotes WHERE seq % 8 NOT IN (5, 6)""",
    "q_json_partial_quarantine": """
SELECT reason, count(*) AS n FROM (
  SELECT CASE event_id % 8 WHEN 0 THEN 'missing_price' WHEN 1 THEN 'bad_price' WHEN 2 THEN 'bad_timestamp' WHEN 3 THEN 'missing_timestamp'
         WHEN 4 THEN 'missing_volume' WHEN 5 THEN 'missing_price_data' WHEN 6 THEN 'missing_symbol' END AS reason
  FROM events) t WHERE reason IS NOT NULL GROUP BY reason""",
    "q_json_mixed_array": f"""WITH {_quotes()}
SELECT seq AS event_id, CAST(p.pos AS BIGINT) AS pos, symbol, CAST(close AS DOUBLE) AS close FROM quotes, (VALUES (0), (4)) p(pos)""",
    "q_json_broken_elements": f"""WITH {_quotes()}
SELECT seq AS event_id, CAST(p.pos AS BIGINT) AS pos, symbol, CAST(NULL AS VARCHAR) AS reason FROM quotes, (VALUES (0), (3)) p(pos)
UNION ALL SELECT count(*), CAST(p.pos AS BIGINT), NULL, 'malformed_element' FROM quotes, (VALUES (1), (2)) p(pos) GROUP BY p.pos""",
    "q_json_trailing_text": f"""WITH {_json_lines()}
SELECT unnest([line || ' and more', line || ']', line || line, line || ',' || line, line || ',"end"],[', line || ',"end"] and more']) AS line, 'trailing_text' AS reason FROM lines""",
    "q_sorted_gain": _metrics("user_id", DAY) + """SELECT window_start, window_end, symbol, avg_gain,
  CAST(row_number() OVER (PARTITION BY window_start ORDER BY avg_gain DESC NULLS LAST, symbol) AS BIGINT) AS rank FROM m""",
    "q_sink_text": _metrics(w=DAY).rstrip() + f""",
{_changes_body('1 day')},
o AS (
  SELECT window_start, symbol, unnest(['sma_close', 'avg_gain', 'total_volume', 'rsi']) AS output,
         unnest([sma_close, avg_gain, CAST(total_volume AS DOUBLE), CASE WHEN s.n_bars >= 2 THEN {_rsi('gain', 'loss')} END]) AS value
  FROM m JOIN s USING (window_start, symbol))
SELECT * FROM o WHERE value IS NOT NULL""",
    "q_lineitem_metrics": _metrics("l_returnflag", BAR, BARS) + "SELECT * FROM m",
    "q_lineitem_top10": _top("avg_gain", 10, "l_suppkey", BAR, BARS),
    # Changes run from value to value: bars without a close are only counted.
    "q_lineitem_rsi": f"""WITH {BARS.format(key='l_returnflag')}, {_win('7 days', 2)},
n AS (SELECT window_start, symbol, count(*) AS n_bars FROM win GROUP BY ALL),
c AS (
  SELECT window_start, symbol, close - lag(close) OVER (PARTITION BY symbol, window_start ORDER BY ts, seq, close) AS change
  FROM win WHERE seq % 5 <> 0),
t AS (
  SELECT window_start, symbol, CAST(sum(CASE WHEN change > 0 THEN change ELSE 0 END) AS DOUBLE) AS gain,
         CAST(sum(CASE WHEN change < 0 THEN -change ELSE 0 END) AS DOUBLE) AS loss
  FROM c GROUP BY ALL)
SELECT window_start, window_start + INTERVAL '14 days' AS window_end, symbol, n_bars, coalesce(gain, 0) AS gain, coalesce(loss, 0) AS loss,
       CASE WHEN n_bars >= 2 THEN {_rsi('gain', 'loss')} END AS rsi
FROM n LEFT JOIN t USING (window_start, symbol)""",
    "q_json_quarantine": f"""WITH {_json_lines()}
SELECT substring(line, 1, length(line) - 2) AS line, 'malformed' AS reason FROM lines
UNION ALL
SELECT props AS line, 'not_array' AS reason FROM events""",
}
