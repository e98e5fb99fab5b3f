"""The quote record and its typed columns."""

from __future__ import annotations

# Fixed values of the input format (must match the feed):
#   one text line = a JSON array of quote objects
#   object fields: symbol, timestamp, priceData{open, high, low, close, volume}
#   timestamp text pattern: yyyy-MM-dd HH:mm:ss (24-hour clock)
PRICE_FIELDS = ("open", "high", "low", "close", "volume")
TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"
# Read more widely than written: single digits and parts of a second.
TIMESTAMP_READ = "yyyy-M-d H:m:s[.SSSSSS]"

# Typed quote columns produced by every source.
PRICE_TYPE = "decimal(12,2)"
# Prices of the text feed, whose digits are not known beforehand.
FEED_PRICE_TYPE = "decimal(20,8)"
QUOTE_COLUMNS = ("symbol", "ts", "seq", "open", "high", "low", "close", "volume")

# Default parameters of the windowed queries (the feed's configuration):
# a 10-minute window moved every 5 minutes.
DEFAULT_WINDOW = "10 minutes"
DEFAULT_SLIDE = "5 minutes"
