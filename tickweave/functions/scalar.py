"""Column expressions shared by the operators (all JVM-side, no UDFs)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickweave.schema import FEED_PRICE_TYPE, PRICE_TYPE, TIMESTAMP_PATTERN, TIMESTAMP_READ


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bound(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of(value)`` with ``value`` computed once, however often ``of`` uses it."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def mean_of(total: str | Column, count: str | Column) -> Column:
    """``total / count`` as double, NULL when the count is 0.

    Sums are kept exact (decimal) until this division, so the result does not
    depend on the order in which partial sums were added.
    """
    return F.try_divide(col_(total).cast("double"), col_(count).cast("double"))


def exact_sum(x: str | Column) -> Column:
    """Sum of integers that cannot overflow: decimal(38,0) whatever their number."""
    return F.sum(col_(x).cast("decimal(28,0)"))


def int_mean(total: str | Column, count: str | Column) -> Column:
    """Truncating integer mean, like Java ``int / int`` (``7 / -2 = -3``); NULL for count 0.

    An integral division (``div``), exact for totals far beyond bigint; NULL
    where the mean itself is none.
    """
    t = col_(total).cast("decimal(38,0)")
    n = col_(count).cast("decimal(19,0)")
    return F.when((n != 0) & (F.abs(t) < F.abs(n) * F.lit(str(2 ** 63)).cast("decimal(19,0)")), F.call_function("div", t, n))


def positive_part(x: str | Column) -> Column:
    """``x`` when ``x >= 0`` else 0 (keeps the decimal type)."""
    x = col_(x)
    return F.when(x > 0, x).otherwise(F.lit(0).cast(PRICE_TYPE))


def negative_part(x: str | Column) -> Column:
    """``-x`` when ``x < 0`` else 0."""
    x = col_(x)
    return F.when(x < 0, -x).otherwise(F.lit(0).cast(PRICE_TYPE))


def rsi(gain: str | Column, loss: str | Column) -> Column:
    """Relative strength index ``100 - 100 / (1 + gain / loss)``.

    Written as ``100 * (gain / (gain + loss))``, which is equal for loss > 0,
    gives 100 for loss = 0 < gain and NULL (not NaN) when both are 0.
    """
    g = col_(gain).cast("double")
    l_ = col_(loss).cast("double")
    # g / (g + l) is a correctly rounded value <= 1, so the result stays in [0, 100].
    value = F.lit(100.0) * (g / (g + l_))
    # Overflowed sums give Inf / Inf = NaN: report NULL instead.
    return F.when((g + l_ > 0) & ~F.isnan(value), value)


def parse_quote_ts(text: str | Column, pattern: str = TIMESTAMP_READ) -> Column:
    """Quote timestamp text to TIMESTAMP; NULL (not an error) when unparseable."""
    return F.try_to_timestamp(col_(text), F.lit(pattern))


def exact_decimal(text: str | Column, dtype: str) -> Column:
    """Text (or number) to a decimal type (at most 20 digits before the point
    and 18 after it); NULL when it is not a number or would need rounding."""
    t = col_(text).cast("string")
    value, wide = t.try_cast(dtype), t.try_cast("decimal(38,18)")
    # Digits that the wide type itself rounds away.
    lost = t.rlike(r"\.[0-9]{18}[0-9]*[1-9]") | ((wide == 0) & (t.try_cast("double") != 0))
    return F.when((value == wide) & ~lost, value)


def to_price(text: str | Column, dtype: str = FEED_PRICE_TYPE) -> Column:
    """Price text (or number) to an exact decimal; NULL when it does not fit."""
    return exact_decimal(text, dtype)


def to_volume(text: str | Column) -> Column:
    """Volume text to bigint, exact for all of it.  ``"10"`` and ``"10.0"`` give 10;
    ``"10.5"`` and junk give NULL (a fractional volume is not silently truncated)."""
    return exact_decimal(text, "decimal(19,0)").try_cast("bigint")


def render_quote(symbol="symbol", ts="ts", open_="open", high="high", low="low",
                 close="close", volume="volume") -> Column:
    """Text form of a quote: ``SYM - yyyy-MM-dd HH:mm:ss (open - high - low - close - volume)``."""
    prices = F.concat_ws(" - ", *[col_(c).cast("string") for c in (open_, high, low, close, volume)])
    return F.concat(col_(symbol), F.lit(" - "), F.date_format(col_(ts), TIMESTAMP_PATTERN),
                    F.lit(" ("), prices, F.lit(")"))


def render_row(*cols: str | Column) -> Column:
    """Values joined by `` - `` (the text form of a state row, e.g. key - gain - loss - rsi)."""
    return F.concat_ws(" - ", *[col_(c).cast("string") for c in cols])
