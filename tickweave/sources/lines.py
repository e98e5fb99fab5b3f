"""Text-line sources (a directory of JSON-array lines) and the line renderer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.schema import TIMESTAMP_PATTERN


def read_lines(spark: SparkSession, path: str, streaming: bool = False,
               max_files_per_trigger: int | None = None, arrival_time: bool = False) -> DataFrame:
    """Lines of the text files under ``path`` as column ``value``.

    ``streaming=True`` watches the directory (new files are picked up each
    trigger; files present at start are read too).  ``arrival_time`` adds
    ``arrival_ts``, the file's modification time, for arrival-time windows.
    """
    reader = spark.readStream if streaming else spark.read
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.text(path)
    if arrival_time:
        df = df.withColumn("arrival_ts", F.col("_metadata.file_modification_time"))
    return df


def quote_object(symbol="symbol", ts="ts", open_="open", high="high", low="low", close="close",
                 volume="volume") -> Column:
    """One quote as a JSON object text with string leaves."""
    price = F.struct(*[F.col(c).cast("string").alias(n) for c, n in
                       ((open_, "open"), (high, "high"), (low, "low"), (close, "close"), (volume, "volume"))])
    return F.to_json(F.struct(F.col(symbol).alias("symbol"),
                              F.date_format(ts, TIMESTAMP_PATTERN).alias("timestamp"),
                              price.alias("priceData")))


def render_quote_lines(quotes: DataFrame, per_line: int = 64, key: str = "symbol", seq: str = "seq",
                       extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Quotes as JSON-array lines: column ``value``, quotes of one key ordered by ``seq``.

    A line holds the quotes of one key whose ``seq`` falls in one block of
    ``per_line`` numbers, so no line (and no group) exceeds ``per_line``
    quotes however hot the key is.  ``extra_keys`` are kept as columns (e.g. a
    day to write one file per day).
    """
    objs = quotes.select(key, *extra_keys, F.floor(F.col(seq) / per_line).alias("_blk"), F.col(seq),
                         quote_object().alias("_obj"))
    line = F.concat(F.lit("["),
                    F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(seq, "_obj"))),
                                             lambda x: x["_obj"]), ","),
                    F.lit("]"))
    return (objs.groupBy(key, *extra_keys, "_blk")
            .agg(line.alias("value"), F.min(seq).alias("first_seq"))
            .select(key, *extra_keys, "first_seq", "value"))
