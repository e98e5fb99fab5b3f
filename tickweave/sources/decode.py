"""Decode JSON-array quote lines into typed quotes plus a quarantine table.

A line is parsed once, as VARIANT, which keeps the digits of decimal numbers.
Only a line that cannot be parsed is cut into its top-level elements, which
are then parsed each alone.  One row per array element carries both the line's
and the element's faults, so quotes and quarantine are two views of the same
pass over the input.

* A line that is no single JSON array goes to quarantine whole.
* An element that is no quote (not JSON, a name that occurs twice, not an
  object, no symbol, no price data) is reported with its position; the other
  elements of its line are used.
* A quote with a faulty field is used with NULL in that field, and each such
  field is reported: a metric loses only the quotes whose own field is bad.
  Quotes without a time count in everything that needs none.

Prices are exact decimals (``price_type``).  A number that does not fit
exactly is reported as a bad price, never rounded.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.functions.scalar import bound, parse_quote_ts, to_price, to_volume
from tickweave.schema import FEED_PRICE_TYPE, PRICE_FIELDS

# Fixed reason codes of the quarantine table.  Line-level: the line is not
# used.  Element-level: the element is not used.  Field-level: the quote is
# used, with NULL in the field; it may have several.
LINE_REASONS = ("not_array", "malformed", "trailing_text")
ELEMENT_REASONS = ("malformed_element", "null_element", "bad_element", "missing_symbol", "missing_price_data")
FIELD_REASONS = ("missing_timestamp", "bad_timestamp", "future_timestamp", "missing_price", "bad_price", "missing_volume", "bad_volume")


# A text in double quotes, and what brackets hold, four deep (a quote has two).
# All loops are possessive: they neither go back nor nest with the input.
_TEXT = r'"(?:[^"\\]|\\.)*+"'
_INSIDE = rf'(?:[^\[\]{{}}"]++|{_TEXT})*+'
for _ in range(3):
    _INSIDE = rf'(?:[^\[\]{{}}"]++|{_TEXT}|[\[{{]{_INSIDE}[\]}}])*+'
ELEMENT = rf'(?:[^\[\]{{}}",]++|{_TEXT}|[\[{{]{_INSIDE}[\]}}])++'
ARRAY = rf"(?s)^\s*+\[({ELEMENT}(?:,{ELEMENT})*+)\]\s*+$"


class Decoded(NamedTuple):
    quotes: DataFrame
    quarantine: DataFrame


def parse_exact(text: Column) -> Column:
    """A JSON text as VARIANT; NULL when it is none or has anything behind it.

    The text is parsed as the first of two elements of an array.  The second is
    its own digest, which the text cannot contain: unless it comes right after
    the text's value, the text is not a single value.
    """
    def value(mark: Column) -> Column:
        both = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]')))
        return bound(both, lambda b: F.when(F.try_variant_get(b, "$[1]", "string") == mark, F.try_variant_get(b, "$[0]", "variant")))

    return bound(F.sha2(text.cast("binary"), 256), value)


def parse_lines(lines: DataFrame, line_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """``line``, the elements ``arr`` (array of variant; NULL for an element that
    is no JSON) and a line-level ``reason`` (NULL if readable, else ``arr`` is
    NULL).  Blank lines are dropped."""
    text = F.col(line_col)
    is_array = F.ltrim("line").startswith("[")
    inner = F.regexp_extract("line", ARRAY, 1)
    cut = F.transform(F.regexp_extract_all(inner, F.lit(ELEMENT), F.lit(0)), parse_exact)
    whole = F.when(is_array, F.try_variant_get(parse_exact(F.col("line")), "$", "array<variant>"))
    arr = F.when(F.col("_whole").isNotNull(), F.col("_whole")).when(is_array & (inner != ""), cut)
    reason = (F.when(~is_array, F.lit("not_array"))
              .when(F.col("arr").isNotNull(), F.lit(None))
              .when(F.try_parse_json("line").isNotNull(), F.lit("trailing_text"))
              .otherwise(F.lit("malformed")))
    return (lines.where(F.trim(text) != "").select(text.alias("line"), *keep)
            .select("line", *keep, whole.alias("_whole"))
            .select("line", *keep, arr.alias("arr")).select("line", *keep, "arr", reason.alias("reason")))


def _field(path: str) -> Column:
    return F.try_variant_get("q", f"$.{path}", "string")


def explode_quotes(parsed: DataFrame, keep: tuple[str, ...] = (), price_type: str = FEED_PRICE_TYPE,
                   arrival: str | None = None, max_ahead: str | None = None) -> DataFrame:
    """One row per array element, and one (``pos`` NULL) per line without any:
    typed fields, ``used`` (is it a quote) and the array ``reasons``."""
    el = parsed.select("line", *keep, F.col("reason").alias("_line"), F.posexplode_outer("arr").alias("pos", "q"))
    texts = el.select("line", *keep, "_line", F.col("pos").cast("bigint").alias("pos"), "q", _field("symbol").alias("symbol"),
                      _field("timestamp").alias("_ts"), *[_field(f"priceData.{f}").alias(f"_{f}") for f in PRICE_FIELDS])
    prices = [f for f in PRICE_FIELDS if f != "volume"]
    ts, future = parse_quote_ts("_ts"), F.lit(False)
    if arrival and max_ahead:
        # A quote cannot be later than its arrival by more than clocks differ.
        future = F.coalesce(ts > F.col(arrival) + F.expr(f"INTERVAL {max_ahead}"), F.lit(False))
    typed = texts.select("*", F.when(~future, ts).alias("ts"), future.alias("_future"), *[to_price(f"_{f}", price_type).alias(f) for f in prices],
                         to_volume("_volume").alias("volume"))
    element = (F.when(F.col("_line").isNotNull(), F.col("_line"))
               .when(F.col("pos").isNull(), F.lit(None))
               .when(F.col("q").isNull(), F.lit("malformed_element"))
               .when(F.is_variant_null("q"), F.lit("null_element"))
               .when(F.col("symbol").isNotNull() & F.coalesce(*[f"_{f}" for f in PRICE_FIELDS]).isNotNull(), F.lit(None))
               .when(~F.schema_of_variant("q").startswith("OBJECT"), F.lit("bad_element"))
               .when(F.col("symbol").isNull(), F.lit("missing_symbol"))
               .otherwise(F.lit("missing_price_data")))

    def bad(*names: str) -> Column:
        hit = F.lit(False)
        for n in names:
            hit = hit | (F.col("_ts" if n == "ts" else f"_{n}").isNotNull() & F.col(n).isNull())
        return hit

    faults = ((F.col("_ts").isNull(), "missing_timestamp"), (bad("ts") & ~F.col("_future"), "bad_timestamp"),
              (F.col("_future"), "future_timestamp"),
              (F.col("_open").isNull() | F.col("_close").isNull(), "missing_price"), (bad(*prices), "bad_price"),
              (F.col("_volume").isNull(), "missing_volume"), (bad("volume"), "bad_volume"))
    fields = F.array_compact(F.array(*(F.when(c, F.lit(name)) for c, name in faults)))
    used = F.col("pos").isNotNull() & F.col("_fault").isNull()
    return typed.withColumn("_fault", element).select(
        "line", *keep, "pos", "symbol", "ts", *PRICE_FIELDS, used.alias("used"),
        F.when(F.col("_fault").isNotNull(), F.array("_fault")).when(used, fields).alias("reasons"))


def decode_quotes(lines: DataFrame, line_col: str = "value", keep: tuple[str, ...] = (),
                  price_type: str = FEED_PRICE_TYPE, arrival: str | None = None, max_ahead: str | None = None) -> Decoded:
    """Split lines into ``quotes`` (symbol, ts, seq, open, high, low, close,
    volume, plus ``keep``) and ``quarantine`` (line, pos, reason: one row per fault).

    ``seq`` is the quote's position in its line: with the timestamp and the
    close it orders quotes of equal time.

    With ``arrival`` (a column of ``lines``, kept) and ``max_ahead`` (an interval)
    a quote whose time is later than its arrival by more than that has no time,
    with the reason ``future_timestamp``: it cannot move a stream's watermark.
    """
    if arrival and arrival not in keep:
        keep = (*keep, arrival)
    elements = explode_quotes(parse_lines(lines, line_col, keep), keep, price_type, arrival, max_ahead)
    quotes = elements.where("used").select("symbol", "ts", F.col("pos").alias("seq"), *PRICE_FIELDS, *keep)
    return Decoded(quotes, elements.select("line", "pos", F.explode("reasons").alias("reason")))
