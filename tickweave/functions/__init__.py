"""Column expressions (JVM-side built-ins only)."""

from tickweave.functions.scalar import (int_mean, mean_of, negative_part, parse_quote_ts, positive_part,
                                        render_quote, render_row, rsi, to_price, to_volume)

__all__ = ["int_mean", "mean_of", "negative_part", "parse_quote_ts", "positive_part", "render_quote",
           "render_row", "rsi", "to_price", "to_volume"]
