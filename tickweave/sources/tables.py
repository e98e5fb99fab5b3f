"""Parquet tables and the quote view derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.schema import FEED_PRICE_TYPE, PRICE_TYPE


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory (``<dir>/<name>.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quotes_from_events(events: DataFrame, key: str = "event_type") -> DataFrame:
    """Quote bars from the ``events`` table.

    ``symbol`` is ``key`` (``event_type``: few hot keys, ``user_id``: many
    keys), ``seq`` (the event id) breaks ties between equal timestamps,
    ``close`` is the value, ``open`` is shifted by ``event_id % 7 - 3`` and the
    volume is the ``k`` field of ``props``.  Only the projected columns are
    read from parquet.
    """
    close = F.col("value").cast(PRICE_TYPE)
    shift = (F.col("event_id") % 7).cast("int") - F.lit(3)
    return events.select(
        F.col(key).cast("string").alias("symbol"),
        F.col("ts"),
        F.col("event_id").alias("seq"),
        (close + shift).cast(PRICE_TYPE).alias("open"),
        close.alias("close"),
        F.get_json_object("props", "$.k").cast("bigint").alias("volume"),
    )


def bars_from_lineitem(spark: SparkSession, sf_dir: str, key: str = "l_returnflag") -> DataFrame:
    """Price bars of another shape, from the ``lineitem`` table: ``open`` is the
    extended price, ``close`` the price after discount and tax (6 decimals,
    exact), the time is the ship date."""
    price, discount, tax = (F.col(c).cast("decimal(12,2)") for c in ("l_extendedprice", "l_discount", "l_tax"))
    one = F.lit(1).cast("decimal(1,0)")
    close = price * (one - discount).cast("decimal(3,2)") * (one + tax).cast("decimal(3,2)")
    return read_table(spark, sf_dir, "lineitem").select(
        F.col(key).cast("string").alias("symbol"), F.col("l_shipdate").alias("ts"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("bigint").alias("seq"),
        price.cast(FEED_PRICE_TYPE).alias("open"), close.cast(FEED_PRICE_TYPE).alias("close"),
        F.col("l_quantity").cast("bigint").alias("volume"))


def with_high_low(quotes: DataFrame) -> DataFrame:
    """Add ``high``/``low`` bounds of a bar that has only open and close."""
    return quotes.withColumn("high", F.greatest("open", "close")).withColumn(
        "low", F.least("open", "close"))


def load_quotes(spark: SparkSession, sf_dir: str, key: str = "event_type") -> DataFrame:
    return quotes_from_events(read_table(spark, sf_dir, "events"), key)
