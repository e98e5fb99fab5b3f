"""Line dedup by a tree of line templates, with DataFrame functions only.

A line's tokens are its parts between white space, with every token that has a
digit replaced by ``<*>``.  The tree has a fixed depth: the number of tokens,
then the leading ``DEPTH`` tokens.  Inside a leaf a later token is constant at
its place if at least ``MIN_DOCS`` documents have it there; other tokens vary and
are replaced by ``<*>`` too.  What remains is the line's template.  A template
that at least ``MIN_DOCS`` documents have, with at least half of the tokens after
the leading ones constant, is boilerplate, and its lines are dropped.  A line of
fewer than ``MIN_TOKENS`` tokens has nothing that could vary: it is dropped if at
least ``MIN_DOCS`` documents have it as it stands, without a ``<*>``.

Documents are counted, not lines: a document with many lines of a form counts
once.  A sum over the distinct lines of a form decides most cases (too few
together, or one line that enough documents have); only where neither holds the
documents themselves are compared.

The first pass keeps only numbers (document, line number, hash of the leaf).
Only lines of leaves that enough documents share are looked at again, and equal
lines are counted before their tokens are exploded, so a line that a third of
all documents have is one row there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import same, text_col, unused, written

DEPTH = 3
MIN_TOKENS = 5
MIN_DOCS = 5
#: At least this share of a template's tokens after the leading ones must be constant.
MIN_CONSTANT = 0.5
WILD = "<*>"


def _plain(line: Column) -> Column:
    # Most lines have single spaces only and need no pattern.
    odd = F.contains(line, F.lit("  "))
    for c in "\t\x0b\f\r":
        odd = odd | F.contains(line, F.lit(c))
    return F.trim(F.when(odd, F.regexp_replace(line, r"[ \t\x0B\f\r]+", " ")).otherwise(line))


def _masked(plain: Column) -> Column:
    # From the start of a token, nothing but its other characters up to a digit.
    return F.when(plain.rlike("[0-9]"), F.regexp_replace(plain, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*", WILD)).otherwise(plain)


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _line_sets(lines: DataFrame, name: str) -> DataFrame:
    """The line numbers of each document.  The narrow rows are dealt out by
    document first: sets of a few lines each would be far larger to shuffle."""
    return lines.select("doc_id", "mark", "line").repartition("doc_id", "mark").groupBy("doc_id", "mark").agg(F.collect_set("line").alias(name))


def _recurring(forms: DataFrame, keys: list[str], holders: DataFrame, min_docs: int) -> DataFrame:
    """The ``keys`` that at least ``min_docs`` documents have.  ``forms``: ``id`` (of
    a distinct line), ``n_docs`` (documents that have this line) and the keys;
    ``holders``: ``id`` and ``holder``, one row per distinct line and document."""
    counts = forms.groupBy(*keys).agg(F.sum("n_docs").alias("sum"), F.max("n_docs").alias("max")).where(F.col("sum") >= min_docs)
    # Lines of few documents each, which may be the same ones.
    unclear = forms.join(counts.where(F.col("max") < min_docs).select(*keys), keys, "left_semi")
    proven = unclear.join(holders, "id").select(*keys, "holder").distinct().groupBy(*keys).agg(F.count("*").alias("n"))
    return counts.where(F.col("max") >= min_docs).select(*keys).unionByName(proven.where(F.col("n") >= min_docs).select(*keys))


def recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS, depth: int = DEPTH,
                    min_constant: float = MIN_CONSTANT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``mark`` (a hash of the text, which tells rows with equal ids
    apart), ``line`` (from 0) and ``template`` of every line to drop.  Rows that
    agree in id and text are one document.  ``min_tokens`` is above ``depth``."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text_col(text)).alias("mark"), text_col(text).alias("text"))
    every = rows.select("doc_id", "mark", F.posexplode(_lines(F.col("text"))).alias("line", "body"))
    plain = every.select("doc_id", "mark", "line", _plain(F.col("body")).alias("plain"))
    n_tokens = F.octet_length("plain") - F.octet_length(F.replace("plain", F.lit(" "), F.lit(""))) + 1
    # A short line with a digit stays in any case.
    wanted = (F.col("plain") != "") & ((n_tokens >= min_tokens) | ~F.col("plain").rlike("[0-9]"))
    leaf = F.xxhash64(n_tokens, _masked(F.substring_index("plain", " ", depth)))
    places = written(plain.where(wanted).select("doc_id", "mark", "line", leaf.alias("leaf")), "leaves")
    full = places.select("leaf", "doc_id", "mark").distinct().groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs)
    wanted = _line_sets(places.join(full.select("leaf"), "leaf", "left_semi"), "w_lines").withColumnsRenamed({"doc_id": "w_id", "mark": "w_mark"})
    chosen = rows.join(wanted.hint("shuffle_hash"), same(F.col("doc_id"), F.col("w_id")) & (F.col("mark") == F.col("w_mark")))
    again = chosen.select("doc_id", "mark", "w_lines", F.posexplode(_lines(F.col("text"))).alias("line", "body")).where(
        F.array_contains("w_lines", F.col("line")))
    lines = written(again.select("doc_id", "mark", "line", _masked(_plain(F.col("body"))).alias("masked")).withColumn(
        "id", F.unhex(F.md5(F.col("masked").cast("binary")))), "lines")

    # Equal lines have an id of 16 bytes, so that their text is shuffled just once.
    holders = lines.select("id", F.xxhash64("doc_id", "mark").alias("holder")).distinct()
    counted = holders.groupBy("id").agg(F.count("*").alias("n_docs"))
    bodies = lines.groupBy("id").agg(F.first("masked").alias("masked"))
    tokens = F.split("masked", " ", -1)
    tree = written(counted.join(bodies, "id").select(
        "id", "n_docs", tokens.alias("tokens"), F.size(tokens).alias("n_tokens"), F.substring_index("masked", " ", depth).alias("lead")), "tree")
    short = tree.where((F.col("n_tokens") < min_tokens) & (F.col("n_docs") >= min_docs) & ~F.array_contains("tokens", WILD))
    short = short.select("id", F.array_join("tokens", " ").alias("template"))

    long = tree.where(F.col("n_tokens") >= min_tokens)
    exploded = long.select("id", "n_docs", "n_tokens", "lead", F.posexplode("tokens").alias("place", "token"))
    exploded = exploded.where((F.col("place") >= depth) & (F.col("token") != WILD))
    at = ["n_tokens", "lead", "place", "token"]
    constant = _recurring(exploded, at, holders, min_docs)
    # Only the constant places of a line come together; all others vary.
    fields = exploded.select("id", *at).join(constant, at, "left_semi").repartition("id").groupBy("id").agg(F.collect_list("place").alias("places"))
    enough = long.join(fields, "id").where(F.size("places") >= min_constant * (F.col("n_tokens") - depth))
    field = F.transform("tokens", lambda t, i: F.when((i < depth) | F.array_contains("places", i), t).otherwise(WILD))
    templates = written(enough.select("id", "n_docs", F.array_join(field, " ").alias("template")), "templates")
    drop = templates.join(_recurring(templates, ["template"], holders, min_docs), "template", "left_semi").select("id", "template")
    return lines.select("doc_id", "mark", "line", "id").join(drop.unionByName(short), "id").select("doc_id", "mark", "line", "template")


def drop_recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS, depth: int = DEPTH,
                         min_constant: float = MIN_CONSTANT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with the lines that ``recurring_lines`` names left out, and
    the counts ``n_lines`` and ``n_dropped``.

    A null text is empty: one line, kept.  All columns stay; a column of the
    input with the name of a count is replaced.  Repeated rows stay and are
    treated alike.
    """
    dropped = _line_sets(recurring_lines(docs, min_docs, min_tokens, depth, min_constant, doc_id, text), "d_lines").withColumnsRenamed({"doc_id": "d_id", "mark": "d_mark"})
    mark, gone = unused(docs, "mark"), F.col("d_lines")
    joined = docs.withColumn(mark, F.xxhash64(text_col(text))).join(
        dropped.hint("shuffle_hash"), same(F.col(doc_id), F.col("d_id")) & (F.col(mark) == F.col("d_mark")), "left")
    lines = _lines(text_col(text))
    left = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(gone, i)), "\n")
    return joined.withColumns({
        "n_lines": F.size(lines).cast("long"), "n_dropped": F.coalesce(F.size(gone), F.lit(0)).cast("long"),
        text: F.when(gone.isNull(), text_col(text)).otherwise(left)}).select(
            *(c for c in docs.columns if c not in ("n_lines", "n_dropped")), "n_lines", "n_dropped")
