"""Ranked lexical search with Block-Max MaxScore over shards of documents.

The index has one row per shard and term: the documents that hold the term, in
ascending order of their ids, in blocks of ``BLOCK`` postings packed at the byte
widths that a block needs.  Beside the packed bytes every block has its first
and last document, its largest term frequency and its shortest document.  From
these and the corpus statistics comes a bound of the score of any of its
postings, so a block that cannot matter is never unpacked.  A shard is what a
task read of the table, up to ``SHARD_CHARS`` characters; every document and
every term is indexed.

A query's lists are ordered by their bounds.  The lists whose bounds together
stay at or below the score of the worst document found so far can't make a new
result by themselves: they are non-essential.  Candidates come from the other,
essential lists only, a range of documents at a time.  For the non-essential
lists, from the one with the largest bound down, a candidate is rejected
by the bounds of the remaining lists, then by the bound of the block that it
would be in, before that block is unpacked.

Each (shard, block of queries) is a group that one task reads as a stream: the
shard's documents, the queries, the lists of their terms.  The best ``k`` of each
shard are merged per query by rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickweave.llm.common import map_arrow, steps, text_col, written
from tickweave.llm.pieces import distinct, runs, text_edges

BLOCK = 128
SHARD_CHARS, SHARD_DOCS = 32_000_000, 60_000
#: Documents of a shard that are looked at in one step.
RANGE = 1024
#: Queries that are searched together in a shard.
QUERIES = 256
#: Partitions of a search at most.
MOST_PARTITIONS = 20_000
#: Fixed values of the score: see ``score_bound``.
SCALE, HALF = 1_000_000_000, 50
BLOCK_ENTRY = np.dtype([("first", "<u2"), ("last", "<u2"), ("n", "<u2"), ("gap_width", "u1"), ("tf_width", "u1"),
                        ("start", "<u4"), ("max_tf", "<u4"), ("min_len", "<u4")])
INDEX = "shard string, term string, df long, entries binary, data binary"


def terms(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct terms of some texts, the number of each term in order, and
    the text of each."""
    joined = "".join(texts)
    code = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    upper = (code >= 0x41) & (code <= 0x5A)
    inside = upper | (code >= 0x80) | (code >= 0x30) & (code <= 0x39) | (code >= 0x61) & (code <= 0x7A)
    edges = text_edges(texts)
    starts, stops = runs(inside, edges)
    code = code + upper.astype(np.uint32) * np.uint32(32)
    names, index = distinct(code.tobytes().decode("utf-32-le"), code, starts, stops)
    return names, index, np.searchsorted(edges, starts, "right") - 1


def _counted(index: np.ndarray, owner: np.ndarray, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, term and frequency of every posting."""
    key, tf = np.unique(owner.astype(np.int64) * max(1, n_terms) + index, return_counts=True)
    doc, term = np.divmod(key, max(1, n_terms))
    return doc, term, tf


class Shard:
    """Collects the postings of documents and packs them."""

    def __init__(self):
        self.numbers: dict[str, int] = {}
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.ids: list[int | None] = []
        self.sizes: list[np.ndarray] = []
        self.chars = 0

    def add(self, ids: list[int | None], texts: list[str]) -> None:
        names, index, owner = terms(texts)
        doc, term, tf = _counted(index, owner, len(names))
        own = np.array([self.numbers.setdefault(t, len(self.numbers)) for t in names], np.int64)
        self.parts.append((doc + len(self.ids), own[term] if len(names) else term, tf))
        self.sizes.append(np.bincount(owner, minlength=len(texts)))
        self.ids += ids
        self.chars += sum(map(len, texts))

    def packed(self, name: str) -> Iterator[pa.RecordBatch]:
        """The index rows: first the documents (``term`` null), then the terms."""
        size = np.concatenate(self.sizes)
        known = np.array([i is not None for i in self.ids], bool)
        ids = np.array([i or 0 for i in self.ids], np.int64)
        # Ascending ids, unknown ones last: of equal scores the earlier document wins.
        order = np.lexsort((ids, ~known))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        docs = np.zeros(len(order), [("id", "<i8"), ("known", "u1"), ("size", "<u4")])
        docs["id"], docs["known"], docs["size"] = ids[order], known[order], size[order]
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.nulls(1, pa.string()), pa.array([len(docs)], pa.int64()),
                                          pa.array([b""]), pa.array([docs.tobytes()])], names=["shard", "term", "df", "entries", "data"])
        doc, term, tf = (np.concatenate(x) for x in zip(*self.parts))
        if not len(doc):
            return
        doc = rank[doc]
        order = np.lexsort((doc, term))
        doc, term, tf = doc[order], term[order], tf[order]
        heads = np.flatnonzero(np.diff(term, prepend=-1))  # the first posting of each term
        counts = np.diff(np.append(heads, len(doc)))
        inside = np.arange(len(doc)) - np.repeat(heads, counts)
        first = np.flatnonzero(inside % BLOCK == 0)  # the first posting of each block
        n = np.diff(np.append(first, len(doc)))
        gap = np.diff(doc, prepend=0)
        gap[first] = 0
        length = size[np.argsort(rank)][doc]
        entries = np.zeros(len(first), BLOCK_ENTRY)
        entries["first"], entries["last"], entries["n"] = doc[first], doc[first + n - 1], n
        entries["max_tf"], entries["min_len"] = np.maximum.reduceat(tf, first), np.minimum.reduceat(length, first)
        entries["gap_width"] = np.where(np.maximum.reduceat(gap, first) < 256, 1, 2)
        entries["tf_width"] = np.select([entries["max_tf"] < 1 << 8, entries["max_tf"] < 1 << 16], [1, 2], 4)
        data_size = n * (entries["gap_width"].astype(np.int64) + entries["tf_width"])
        begin = np.cumsum(data_size) - data_size
        term_first = np.searchsorted(first, heads)  # the first block of each term
        term_blocks = np.diff(np.append(term_first, len(first)))
        entries["start"] = begin - np.repeat(begin[term_first], term_blocks)
        out = np.zeros(int(data_size.sum()), np.uint8)
        block = np.repeat(np.arange(len(first)), n)
        place = np.arange(len(doc)) - first[block]
        wide_gap, wide_tf = entries["gap_width"].astype(np.int64)[block], entries["tf_width"].astype(np.int64)[block]
        at = begin[block] + place * wide_gap
        tf_at = begin[block] + n[block] * wide_gap + place * wide_tf
        for values, places, widths in ((gap, at, wide_gap), (tf, tf_at, wide_tf)):
            for k in range(4):
                some = widths > k
                out[places[some] + k] = values[some] >> 8 * k & 255
        names = list(self.numbers)
        ends = np.append(begin[term_first], len(out))
        yield pa.RecordBatch.from_arrays([
            pa.array([name] * len(heads)), pa.array([names[t] for t in term[heads].tolist()], pa.string()), pa.array(counts, pa.int64()),
            _slices(entries.tobytes(), np.append(term_first, len(first)) * BLOCK_ENTRY.itemsize), _slices(out.tobytes(), ends)],
            names=["shard", "term", "df", "entries", "data"])


def _slices(data: bytes, edges: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(data)])


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The index of all documents, a written table of (shard, term) rows and one
    row per shard (``term`` null) with its documents: id and number of terms.

    ``doc_id`` is read as a long and may be null or repeated; a null text has no
    terms.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, shard = TaskContext.get().partitionId(), 0, Shard()
        for batch, texts in steps(batches):
            if shard.ids and (shard.chars + sum(map(len, texts)) > SHARD_CHARS or len(shard.ids) + len(texts) > SHARD_DOCS):
                yield from shard.packed(f"{part}-{n}")
                n, shard = n + 1, Shard()
            shard.add(batch.column("doc_id").to_pylist(), texts)
        if shard.ids:
            yield from shard.packed(f"{part}-{n}")

    return written(map_arrow(rows, run, INDEX), "lexical-index")


class Lists:
    """The packed lists of a shard that a block of queries needs; a block of
    postings is unpacked when it is first asked for."""

    def __init__(self, size: np.ndarray, n_docs: int, n_terms: int):
        self.m = 100 - HALF + (HALF * size.astype(np.int64) * n_docs) // max(1, n_terms)
        self._n, self._l, self._lists, self._open = n_docs, n_terms, {}, {}
        self.opened = 0

    def add(self, term: str, entries: bytes, data: bytes) -> None:
        entries = np.frombuffer(entries, BLOCK_ENTRY)
        tf = entries["max_tf"].astype(np.int64)
        m = 100 - HALF + (HALF * entries["min_len"].astype(np.int64) * self._n) // max(1, self._l)
        # The score grows with the frequency and falls with the length.
        self._lists[term] = (entries, data, SCALE * tf // (1000 * tf + 20 * m))

    def __contains__(self, term: str) -> bool:
        return term in self._lists

    def bounds(self, term: str) -> np.ndarray:
        return self._lists[term][2]

    def entries(self, term: str) -> np.ndarray:
        return self._lists[term][0]

    def block(self, term: str, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and unweighted scores of a block of postings."""
        got = self._open.get((term, b))
        if got is None:
            entries, data, _ = self._lists[term]
            e = entries[b]
            n, start = int(e["n"]), int(e["start"])
            gw, tw = int(e["gap_width"]), int(e["tf_width"])
            gap = np.frombuffer(data, f"<u{gw}", n, start).astype(np.int64)
            tf = np.frombuffer(data, f"<u{tw}", n, start + n * gw).astype(np.int64)
            doc = np.cumsum(gap) + int(e["first"])
            got = self._open[(term, b)] = doc, SCALE * tf // (1000 * tf + 20 * self.m[doc])
            self.opened += 1
        return got


def search_shard(lists: Lists, query: list[tuple[str, int]], n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents and scores of the ``k`` best of a shard, scores above 0; of equal
    scores the earlier documents.  ``query``: terms and weights."""
    query = [(t, w) for t, w in query if w > 0 and t in lists]
    bound = np.array([w * int(lists.bounds(t).max()) for t, w in query], np.int64)
    order = np.argsort(bound, kind="stable")
    query, total = [query[i] for i in order], np.cumsum(bound[order])
    found, score, worst = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    for low in range(0, n_docs, RANGE):
        high = min(n_docs, low + RANGE)
        essential = int(np.searchsorted(total, worst, "right"))  # the lists before it can't pass ``worst`` together
        if essential == len(query):
            break
        sums = np.zeros(high - low, np.int64)
        for term, weight in query[essential:]:
            entries = lists.entries(term)
            a = int(np.searchsorted(entries["last"], low))
            b = int(np.searchsorted(entries["first"], high))
            for i in range(a, b):
                doc, part = lists.block(term, i)
                if doc[0] < low or doc[-1] >= high:
                    some = (doc >= low) & (doc < high)
                    doc, part = doc[some], part[some]
                sums[doc - low] += weight * part
        cand = np.flatnonzero(sums)
        for i in range(essential - 1, -1, -1):
            cand = cand[sums[cand] + total[i] > worst]
            if not len(cand):
                break
            term, weight = query[i]
            entries, doc = lists.entries(term), cand + low
            block = np.searchsorted(entries["last"], doc)
            there = block < len(entries)
            there[there] = entries["first"][block[there]] <= doc[there]
            part = np.zeros(len(cand), np.int64)
            part[there] = weight * lists.bounds(term)[block[there]]
            rest = total[i - 1] if i else 0
            some = sums[cand] + part + rest > worst
            cand, block, there = cand[some], block[some], there[some]
            for b in np.unique(block[there]).tolist():
                has, values = lists.block(term, b)
                mine = cand[there & (block == b)]
                place = np.searchsorted(has, mine + low)
                hit = has[np.minimum(place, len(has) - 1)] == mine + low
                sums[mine[hit]] += weight * values[place[hit]]
        cand = cand[sums[cand] > worst]
        if len(cand):
            found, score = np.append(found, cand + low), np.append(score, sums[cand])
            best = np.lexsort((found, -score))[:k]
            found, score = found[best], score[best]
            worst = int(score[-1]) if len(score) == k else 0
    return found, score


def search(index: DataFrame, items: DataFrame, k: int = 50, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score`` of the ``k`` best
    documents of each item: highest scores first, of equal scores the smaller id
    (a null id last).  Scores are above 0, so an item may have fewer rows, or none.

    Items that agree in id and text are one; items with one id and different texts
    are ranked each for itself.  A null text has no terms.
    """
    corpus = index.where("term IS NULL").select("shard", "data")

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [np.frombuffer(x, [("id", "<i8"), ("known", "u1"), ("size", "<u4")])["size"] for x in batch.column("data").to_pylist()]
            yield pa.RecordBatch.from_pydict({"n": pa.array([int((s > 0).sum()) for s in got], pa.int64()),
                                              "l": pa.array([int(s.sum(dtype=np.int64)) for s in got], pa.int64())})

    n_docs, n_terms = map_arrow(corpus.select("data"), sizes, "n long, l long").agg(F.sum("n"), F.sum("l")).first()
    n_docs, n_terms = n_docs or 0, n_terms or 0

    rows = items.select(F.col(item_id).alias("item"), text_col(text).alias("text")).distinct()
    rows = rows.withColumn("key", F.sha2(F.concat(F.coalesce(F.col("item").cast("string"), F.lit("")), F.lit("|"), "text").cast("binary"), 256))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in steps(batches):
            names, index_, owner = terms(texts)
            doc, term, _ = _counted(index_, owner, len(names))
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(doc)), pa.array([names[t] for t in term.tolist()], pa.string())],
                                             names=["key", "term"])

    rows = written(rows, "lexical-items")
    n_items = rows.count()
    found = written(map_arrow(rows.select("key", "text"), cut, "key string, term string"), "lexical-terms")
    wanted = found.select("term").distinct()
    lists = written(index.join(wanted, "term", "left_semi"), "lexical-lists")
    df = lists.groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((F.lit(2.0) * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    blocks = max(1, -(-n_items // QUERIES))
    query = written(found.join(df, "term").select("key", "term", weight.alias("weight"),
                                                  F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int").alias("block")), "lexical-queries")
    # A group per (shard, block of queries) that share a term; its rows in the order documents, queries, lists.
    lists = lists.join(query.select("block", "term").distinct(), "term")
    groups = lists.select("shard", "block").distinct()
    none = F.lit(None)
    asked = query.groupBy("block", "key").agg(F.collect_list(F.struct("term", "weight")).alias("query"))
    parts = [groups.join(corpus, "shard").select("shard", "block", F.lit(0).alias("kind"), none.cast("string").alias("key"),
                                                 none.cast("array<struct<term:string,weight:bigint>>").alias("query"),
                                                 none.cast("string").alias("term"), none.cast("binary").alias("entries"), "data"),
             lists.select("shard", "block", F.lit(1).alias("kind"), none.alias("key"), none.alias("query"), "term", "entries", "data"),
             groups.join(asked, "block").select("shard", "block", F.lit(2).alias("kind"), "key", "query", none.alias("term"),
                                                none.alias("entries"), none.alias("data"))]
    # The work lies in the search, not in the bytes: a partition per group, up to a bound.
    n_groups = max(1, min(corpus.count() * blocks, MOST_PARTITIONS))
    dealt = parts[0].unionByName(parts[1]).unionByName(parts[2]).repartition(n_groups, "shard", "block").sortWithinPartitions("shard", "block", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = held = None
        for batch in batches:
            kinds = batch.column("kind").to_pylist()
            for i, kind in enumerate(kinds):
                if kind == 0:
                    docs = np.frombuffer(batch.column("data")[i].as_py(), [("id", "<i8"), ("known", "u1"), ("size", "<u4")])
                    held = Lists(docs["size"], n_docs, n_terms)
                elif kind == 1:
                    held.add(batch.column("term")[i].as_py(), batch.column("entries")[i].as_py(), batch.column("data")[i].as_py())
                else:
                    query = [(q["term"], q["weight"]) for q in batch.column("query")[i].as_py()]
                    doc, score = search_shard(held, query, len(docs), k)
                    if len(doc):
                        yield pa.RecordBatch.from_pydict({
                            "key": [batch.column("key")[i].as_py()] * len(doc),
                            "doc_id": pa.array(docs["id"][doc], pa.int64(), mask=docs["known"][doc] == 0),
                            "score": pa.array(score, pa.int64())})

    best = map_arrow(dealt, run, "key string, doc_id long, score long")
    order = Window.partitionBy("key").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(rows.select("key", "item"), "key").select(F.col("item").alias(item_id), "rank", "doc_id", "score")
