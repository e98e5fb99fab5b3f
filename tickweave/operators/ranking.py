"""Descending rankings and top-k per window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def top_k(df: DataFrame, by: str, k: int = 1, per: Sequence[str] = ("window_start", "window_end"),
          tie: Sequence[str] = ("symbol",), rank_name: str = "rank") -> DataFrame:
    """The ``k`` rows with the largest ``by`` in each ``per`` group, with their rank.

    Ties are broken by ``tie`` ascending, so the output is deterministic.  The
    ``row_number() <= k`` filter lets Spark insert a window group limit before
    the shuffle, so at most ``k`` rows per group and map task are exchanged.
    NULL metrics rank last.  With ``per=()`` it is one global top ``k``.
    """
    order = [F.col(by).desc_nulls_last(), *[F.col(t).asc() for t in tie]]
    if not per:
        # One global top k: each task keeps its k best rows, the driver merges
        # them (TakeOrderedAndProject); only the k survivors are numbered.
        best = df.orderBy(*order).limit(k)
        return best.withColumn(rank_name, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    w = Window.partitionBy(*per).orderBy(*order)
    return (df.withColumn(rank_name, F.row_number().over(w))
            .where(F.col(rank_name) <= k)
            .withColumn(rank_name, F.col(rank_name).cast("bigint")))


def ranked(df: DataFrame, by: str, per: Sequence[str] = ("window_start", "window_end"),
           tie: Sequence[str] = ("symbol",), rank_name: str = "rank") -> DataFrame:
    """Every row with its place in the descending ``by`` order of its ``per`` group
    (ties as in ``top_k``, NULL last): the whole listing of each window."""
    w = Window.partitionBy(*per).orderBy(F.col(by).desc_nulls_last(), *[F.col(t).asc() for t in tie])
    return df.withColumn(rank_name, F.row_number().over(w).cast("bigint"))


def sorted_desc(df: DataFrame, by: str, tie: Sequence[str] = ("symbol",)) -> DataFrame:
    """The whole result in descending ``by`` order (a total, range-partitioned sort)."""
    return df.orderBy(F.col(by).desc_nulls_last(), *[F.col(t).asc() for t in tie])


def first_rows(df: DataFrame, k: int = 10) -> DataFrame:
    """A preview: any ``k`` rows, without an order (as few tasks run as it takes)."""
    return df.limit(k)
