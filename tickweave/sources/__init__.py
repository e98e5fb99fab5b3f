"""Inputs: parquet tables, text-line directories (batch or stream) and the JSON decoder."""

from tickweave.sources.decode import Decoded, decode_quotes
from tickweave.sources.lines import read_lines, render_quote_lines
from tickweave.sources.tables import load_quotes, quotes_from_events, read_table

__all__ = ["Decoded", "decode_quotes", "load_quotes", "quotes_from_events", "read_lines", "read_table",
           "render_quote_lines"]
