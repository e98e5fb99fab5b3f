"""Exact duplicates by progressive refinement: length, prefix hash, full hash.

Texts are equal when identical without white space.  A first pass over the
texts keeps only numbers of each row: the length of the text as compared, a
hash of its first characters, and the code points of the whole text.  Rows are
grouped by length, the rows of lengths that occur twice by prefix hash, and
only the rows of groups that are still shared are read in full for the SHA-256
that decides.  Rows of a group are never gathered: groups are counts, and a
row is found again by its id and its numbers, so a group that a third of all
rows belong to is spread like any others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import SPACE_CHARS, same, text_col, unused, written

#: Characters of the compared text that the prefix hash covers.
PREFIX = 256


def compared(text: str = "text") -> Column:
    """The text without white space, null as empty."""
    return F.translate(text_col(text), SPACE_CHARS, "")


def digest(text: str = "text") -> Column:
    return F.sha2(compared(text).cast("binary"), 256)


def _marks(text: str) -> list[Column]:
    return [F.octet_length(compared(text)), F.xxhash64(F.substring(compared(text), 1, PREFIX)), F.char_length(text_col(text))]


def shared_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows whose length and prefix another row shares, read in full:
    ``doc_id``, the numbers ``bytes``, ``prefix``, ``points``, and ``sha``.
    The result is a written table."""
    names = ["bytes", "prefix", "points"]
    rows = docs.select(F.col(doc_id).alias("doc_id"), *(c.alias(n) for n, c in zip(names, _marks(text))))
    rows = written(rows, "lengths")
    lengths = rows.groupBy("bytes").agg(F.count("*").alias("n")).where("n > 1").select("bytes")
    rows = rows.join(lengths, "bytes", "left_semi")
    prefixes = rows.groupBy("bytes", "prefix").agg(F.count("*").alias("n")).where("n > 1").select("bytes", "prefix")
    wanted = rows.join(prefixes, ["bytes", "prefix"], "left_semi").select(
        F.col("doc_id").alias("w_id"), *(F.col(n).alias(f"w_{n}") for n in names)).distinct()
    full = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *(c.alias(n) for n, c in zip(names, _marks(text))))
    keys = [same(F.col("doc_id"), F.col("w_id")), *(F.col(n) == F.col(f"w_{n}") for n in names)]
    full = full.join(wanted.hint("shuffle_hash"), keys, "left_semi")
    return written(full.select("doc_id", *names, digest("text").alias("sha")), "shared")


def duplicate_groups(shared: DataFrame) -> DataFrame:
    """The groups of equal texts among ``shared_rows``: ``sha``, ``group_size``,
    and ``keep_id`` and ``keep_points`` of the row that stays: the most code
    points, then the smallest id (a null id after all others)."""
    # min() on (minus the code points, has no id, the id) picks that row with partial aggregation before the shuffle; ids of any type.
    best = F.min(F.struct((-F.col("points")).alias("minus"), F.col("doc_id").isNull().alias("unknown"), "doc_id")).alias("best")
    return shared.groupBy("sha").agg(F.count("*").alias("group_size"), best).where("group_size > 1").select(
        "sha", "group_size", F.col("best.doc_id").alias("keep_id"), (-F.col("best.minus")).alias("keep_points"))


def _staying(row_id: Column, points: Column) -> Column:
    return same(row_id, F.col("keep_id")) & (points == F.col("keep_points"))


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256``.

    Null texts are empty and equal to each other.  Rows that agree in id and
    text are copies too, and exactly one of them is kept.
    """
    from pyspark.sql import Window

    groups = duplicate_groups(shared_rows(docs, doc_id, text))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.char_length(text_col(text)).alias("points"), digest(text).alias("text_sha256"))
    joined = rows.join(groups, F.col("text_sha256") == F.col("sha"), "left")
    alone = F.col("sha").isNull()
    staying = joined.withColumn("stays", alone | _staying(F.col("doc_id"), F.col("points")))
    # Rows that agree in everything are numbered, so that one of them stays.
    again = F.row_number().over(Window.partitionBy("text_sha256", "doc_id", "points").orderBy("points"))
    return staying.withColumn("again", again).select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("stays") & (F.col("again") == 1)).alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    shared = shared_rows(docs, doc_id, text)
    rows = shared.join(duplicate_groups(shared), "sha")
    marks = [unused(docs, n) for n in ("bytes", "prefix", "points")]
    marked = docs.withColumns(dict(zip(marks, _marks(text))))
    # Per row key: does it go, or stay once although it occurs again?
    fate = rows.groupBy("doc_id", "bytes", "prefix", "points", "sha").agg(
        F.first(_staying(F.col("doc_id"), F.col("points"))).alias("stays"), F.count("*").alias("n")).where("NOT stays OR n > 1")
    fate = written(fate.select(F.col("doc_id").alias("w_id"), F.col("bytes").alias("w_bytes"), F.col("prefix").alias("w_prefix"),
                               F.col("points").alias("w_points"), F.col("sha").alias("w_sha"), F.col("stays").alias("w_stays")), "fate")
    keys = [same(marked[doc_id], F.col("w_id")), *(marked[m] == F.col(f"w_{n}") for m, n in zip(marks, ("bytes", "prefix", "points")))]
    gone = fate.hint("shuffle_hash")
    out = marked.join(gone, [*keys, digest(text) == F.col("w_sha")], "left_anti").select(*docs.columns)
    once = fate.where("w_stays")
    if once.limit(1).count():
        repeated = marked.join(once.hint("shuffle_hash"), [*keys, digest(text) == F.col("w_sha")], "inner")
        out = out.unionByName(repeated.dropDuplicates(["w_id", "w_bytes", "w_prefix", "w_points", "w_sha"]).select(*docs.columns))
    return out
