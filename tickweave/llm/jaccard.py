"""Similarity join on word shingles with a token-group matrix.

A document is the set of its distinct shingles, kept as 64-bit hashes.  Equal
sets are one class.  Similar classes are put into groups of about
``GROUP_CLASSES``: those with the same commonest shared shingle and like size; a
larger group is split by hash.  The matrix says which groups hold which shingle.
A class can only be similar to a member of a group if it shares enough shingles
with the union of the group: of its ``n`` shingles at least
``ceil(SIMILARITY * n)``.  Only groups that pass are opened, and only there sets
are compared.

Not all columns of the matrix are read.  Of a class the first
``n - ceil(SIMILARITY * n) + c`` shingles are enough, if all classes choose them by
one order: two similar classes share at least ``c`` of those (the smaller ``c`` of
the two, which grows with ``n``).  A class that shares fewer with all others
together, or with a group, is out before any set is moved.  The order puts shingles that many classes have
last, so that passages which thousands of documents share bring no candidates
unless a document has hardly anything else.  Shingles are counted over all
classes, by 40 bits of their hash; the list of frequent ones that the tasks get
has at most ``FREQUENT`` entries, because its threshold grows with the corpus.

The join has two rounds.  First each class is compared with its own group and
with the first part of the group it was split from; that connects clusters of
near copies, however large, with work in proportion to their size.  Then the
matrix gives the remaining candidates; of two components only the smaller one's
classes ask for the groups of the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickweave.llm.common import map_arrow, same, steps, text_col, written
from tickweave.llm.components import components, local_roots
from tickweave.llm.pieces import span_hashes, words

SHINGLE = 4
#: Least similarity, in percent.
PERCENT = 85
GROUP_CLASSES = 128
#: Tasks that the classes of a split group are dealt over.
SALTS = 32
#: Shingles of a group's sets together, about.
GROUP_SHINGLES = 1 << 18
#: One of so many shingles is read beyond those that a candidate needs, so that chance matches don't count.
SPARE = 16
#: Classes that are compared with a group in one task.
QUERIES = 512
#: Least number of classes that have a frequent shingle, and most entries of that list.
FREQUENT_FROM, FREQUENT = 64, 1 << 22
#: Rows up to which the narrow table of where sets go is broadcast to the scan of the sets (24 bytes each).
BROADCAST_KEYS = 1 << 20
#: Sets that a task remembers to have written.
SEEN = 1 << 20
SETS = "doc_id long, key long, n long, tokens binary"


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit value of each number."""
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ x >> np.uint64(33)


def shingles(texts: list[str], shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of all texts, ascending, one text after the other,
    and the offsets of the texts.  A text of fewer words has one, all its words."""
    _, code, starts, stops, first, _ = words(texts)
    code = code + ((code >= 0x41) & (code <= 0x5A)).astype(np.uint32) * np.uint32(32)
    word = span_hashes(code, starts, stops)[0]
    size = np.diff(first)
    owner = np.repeat(np.arange(len(texts)), size)
    values, docs = [], []
    for length in range(1, shingle + 1):
        # All runs of ``shingle`` words, or the whole of a shorter text.
        n = len(word) - length + 1
        if n < 1:
            break
        at = np.flatnonzero(owner[:n] == owner[length - 1:]) if length == shingle else first[:-1][size == length]
        value = np.full(len(at), length, np.uint64)
        for k in range(length):
            value = _mixed(value * np.uint64(0x9E3779B97F4A7C15) + word[at + k])
        values.append(value)
        docs.append(owner[at])
    value, doc = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (values, docs))
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order].astype(np.int64)
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    value, doc = value[fresh], doc[fresh]
    return value, np.searchsorted(doc, np.arange(len(texts) + 1))


def _slices(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> pa.Array:
    """The runs between the offsets as binary; null where not kept."""
    ends = offsets.astype(np.int64) * data.itemsize
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(keep), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])
    return pa.array([x if k else None for x, k in zip(column.to_pylist(), keep.tolist())], pa.binary())


def shingle_sets(docs: DataFrame, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``key`` (a hash of the set, the same for equal sets), ``n``
    (its size) and ``tokens`` (ascending, little-endian unsigned 64-bit) of every
    row; ``tokens`` is null where the task wrote that set before.  A written table."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch, texts in steps(batches):
            value, offsets = shingles(texts, shingle)
            n = np.diff(offsets)
            sums = np.concatenate([[np.uint64(0)], np.cumsum(_mixed(value ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
            key = _mixed(sums[offsets[1:]] - sums[offsets[:-1]] + n.astype(np.uint64)).view(np.int64)
            keep = np.zeros(len(n), bool)
            for i, (k, size) in enumerate(zip(key.tolist(), n.tolist())):
                if size and k not in seen:
                    keep[i] = True
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(k)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(key), pa.array(n.astype(np.int64)),
                                              _slices(value, offsets, keep)], names=["doc_id", "key", "n", "tokens"])

    return written(map_arrow(rows, run, SETS), "shingle-sets")


def _needed(n: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that a similar set must share with a set of ``n``."""
    return -(-percent * n // 100)


def _common(n):
    """Shingles that two similar sets share among the first ones (of the smaller
    set; a number, an array or a column)."""
    return n // SPARE + 1 if not isinstance(n, Column) else F.floor(n / SPARE) + 1


def _first(n: np.ndarray, percent: int) -> np.ndarray:
    """How many first shingles of a set of ``n`` decide about its candidates."""
    return np.minimum(n, n - _needed(n, percent) + _common(n))


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens of a batch's sets, the row of each, and its place in its set."""
    parts = [np.frombuffer(x, "<u8") for x in batch.column("tokens").to_pylist()]
    size = np.array([len(p) for p in parts], np.int64)
    row = np.repeat(np.arange(len(parts)), size)
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)


def frequent_shingles(sets: DataFrame, percent: int = PERCENT) -> np.ndarray:
    """The 40-bit hashes, ascending, of the shingles that many classes have among
    the first ones of their order by hash, twice as many as they need.

    At most FREQUENT of them, as each takes a share of all that are counted.
    """
    total = sets.agg(F.sum("n")).first()[0] or 0
    bits = max(8, (total >> 22).bit_length())  # about four million shingles to a bucket
    counted = 2 * (total * (100 - percent) // 100 + total // SPARE + 2 * sets.count())
    least = max(FREQUENT_FROM, counted // FREQUENT)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            token, row, place = _flat(batch)
            n = np.array(batch.column("n").to_pylist(), np.int64)
            value, times = np.unique(token[place < 2 * _first(n, percent)[row]] >> np.uint64(24), return_counts=True)
            bucket = (value >> np.uint64(40 - bits)).astype(np.int64)
            heads = np.flatnonzero(np.diff(bucket, prepend=-1))
            ends = np.append(heads, len(value))
            low = (value & np.uint64((1 << 40 - bits) - 1)).astype("<u4")
            yield pa.RecordBatch.from_arrays([
                pa.array(bucket[heads]), pa.array([low[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary()),
                pa.array([times[a:b].astype("<u2").tobytes() for a, b in zip(ends, ends[1:])], pa.binary())], names=["bucket", "low", "times"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, low, times, held = -1, [], [], 0

        def merged():
            value, index = np.unique(np.concatenate(low), return_inverse=True)
            return value, np.bincount(index, np.concatenate(times)).astype(np.int64)

        def done():
            if not low:
                return
            value, n = merged()
            often = (value[n >= least].astype(np.int64)) | (bucket << 40 - bits)
            yield pa.RecordBatch.from_arrays([pa.array(often)], names=["value"])

        for batch in batches:
            for b, x, t in zip(*(batch.column(c).to_pylist() for c in ("bucket", "low", "times"))):
                if b != bucket:
                    yield from done()
                    bucket, low, times, held = b, [], [], 0
                low.append(np.frombuffer(x, "<u4"))
                times.append(np.frombuffer(t, "<u2").astype(np.int64))
                held += len(low[-1])
                if held > 1 << 23:
                    value, n = merged()
                    low, times, held = [value], [n], 0
        yield from done()

    dealt = map_arrow(sets.where("tokens IS NOT NULL").select("n", "tokens"), deal, "bucket long, low binary, times binary")
    found = map_arrow(dealt.repartition("bucket").sortWithinPartitions("bucket"), count, "value long")
    return np.sort(np.array([r["value"] for r in found.collect()], np.uint64))


def _prefixes(sets: DataFrame, frequent: np.ndarray, percent: int) -> DataFrame:
    """``token``, ``key``, ``n``: the shingles of each class that decide about its candidates."""
    held = sets.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = held.value
        for batch in batches:
            token, row, _ = _flat(batch)
            short = token >> np.uint64(24)
            hot = np.zeros(len(token), bool)
            if len(often):
                hot = often[np.minimum(np.searchsorted(often, short), len(often) - 1)] == short
            order = np.lexsort((token, hot, row))
            token, row = token[order], row[order]
            n = np.array(batch.column("n").to_pylist(), np.int64)
            first = np.searchsorted(row, row)
            some = np.arange(len(row)) - first < _first(n, percent)[row]
            key = np.array(batch.column("key").to_pylist(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(token[some].view(np.int64)), pa.array(key[row[some]]), pa.array(n[row[some]])],
                                             names=["token", "key", "n"])

    return map_arrow(sets.where("tokens IS NOT NULL").select("key", "n", "tokens"), run, "token long, key long, n long")


class Group:
    """The sets of a group, one row of the token-group matrix."""

    def __init__(self, keys: list[int], sets: list[bytes]):
        parts = [np.frombuffer(x, "<u8") for x in sets]
        self.keys = np.array(keys, np.int64)
        self.size = np.array([len(p) for p in parts], np.int64)
        self._parts, self._members = parts, None
        self.union = np.unique(np.concatenate(parts))
        self.opened = 0

    def bound(self, tokens: np.ndarray) -> np.ndarray:
        """The places in the union of those tokens that are in it."""
        at = np.minimum(np.searchsorted(self.union, tokens), len(self.union) - 1)
        return at[self.union[at] == tokens]

    def links(self, key: int, tokens: np.ndarray, percent: int) -> np.ndarray:
        """The keys of the members that are similar to a set."""
        at, n = self.bound(tokens), len(tokens)
        if len(at) < _needed(n, percent):
            return np.zeros(0, np.int64)
        if self._members is None:
            # Opened for the first time: the members that have each token of the union.
            place = np.searchsorted(self.union, np.concatenate(self._parts))
            order = np.argsort(place, kind="stable")
            self._members = np.repeat(np.arange(len(self.size)), self.size)[order]
            self._first = np.searchsorted(place[order], np.arange(len(self.union) + 1))
        self.opened += 1
        begin, count = self._first[at], self._first[at + 1] - self._first[at]
        some = np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())
        shared = np.bincount(self._members[some], minlength=len(self.size))
        return self.keys[(100 * shared >= percent * (n + self.size - shared)) & (self.keys != key)]


def _verified(pairs: DataFrame, placed: DataFrame, sets: DataFrame, percent: int, within: bool) -> DataFrame:
    """Links (``a``, ``b``) that connect all classes that are similar, among the
    candidates ``pairs`` (``key``, ``gid``) and, if ``within``, inside each group.

    ``placed`` has the group of each class.  Where each set goes is decided with
    narrow rows; the sets themselves are shuffled just once for each group that
    they go to, and not at all for a class that is alone in its group and that
    nobody asks for.
    """
    asked = pairs.groupBy("gid").agg(F.count("*").alias("asked"))
    sizes = placed.groupBy("gid").agg(F.count("*").alias("size"))
    wanted = sizes.join(asked, "gid", "left").select(
        F.col("gid").alias("to"), "size", F.coalesce("asked", F.lit(0)).alias("asked"),
        F.greatest(F.ceil(F.coalesce("asked", F.lit(0)) / QUERIES), F.lit(1)).cast("int").alias("parts"))
    wanted = wanted.where((F.col("asked") > 0) | (F.lit(within) & (F.col("size") > 1)))
    # The queries of a group are dealt over parts, each with a copy of the group.
    members = placed.join(wanted, F.col("gid") == F.col("to")).select(
        "key", "gid", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"))
    queries = pairs.withColumnRenamed("gid", "to").join(wanted, "to").select(
        "key", F.col("to").alias("gid"), F.pmod(F.xxhash64("key"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("kind"))
    routes = written(members.unionByName(queries), "set-routes")
    routes = F.broadcast(routes) if routes.count() <= BROADCAST_KEYS else routes
    dealt = sets.where("tokens IS NOT NULL").select("key", "tokens").join(routes, "key")
    dealt = dealt.repartition("gid", "part").sortWithinPartitions("gid", "part", "kind", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, keys, tokens, group, a, b = None, [], [], None, [], []

        def ask(key: int, own: bytes) -> None:
            linked = group.links(key, np.frombuffer(own, "<u8"), percent)
            if len(linked):
                a.append(np.full(len(linked), key))
                b.append(linked)

        def complete() -> Group:
            nonlocal group
            group = Group(keys, tokens)
            if within and last[1] == 0 and len(keys) > 1:
                for k, own in zip(keys, tokens):
                    ask(k, own)
            return group

        def connected() -> pa.RecordBatch:
            node, root = local_roots(np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64),) * 2
            a.clear()
            b.clear()
            return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(root, pa.int64())], names=["a", "b"])

        for batch in batches:
            for gid, part, kind, key, own in zip(*(batch.column(c).to_pylist() for c in ("gid", "part", "kind", "key", "tokens"))):
                if (gid, part) != last:
                    if keys and group is None:
                        complete()
                    last, keys, tokens, group = (gid, part), [], [], None
                if kind == 0:
                    # A set that several tasks wrote comes again.
                    if not keys or keys[-1] != key:
                        keys.append(key)
                        tokens.append(own)
                else:
                    group or complete()
                    ask(key, own)
            if sum(map(len, a)) > 1 << 20:
                yield connected()
        if keys and group is None:
            complete()
        yield connected()

    return map_arrow(dealt, run, "a long, b long")


def similar_classes(sets: DataFrame, percent: int = PERCENT, group_classes: int = GROUP_CLASSES) -> DataFrame:
    """``node`` and ``root``: the classes (keys of ``shingle_sets``) that are
    connected by similarity with a smaller one, the smallest of their component."""
    prefixes = _prefixes(sets, frequent_shingles(sets, percent), percent)
    token = Window.partitionBy("token")
    shared = prefixes.repartition("token").withColumns(
        {"low": F.min("key").over(token), "high": F.max("key").over(token), "times": F.count("*").over(token)})
    shared = written(shared.where("low <> high").select("token", "key", "n", "times"), "shared-shingles")

    # Groups: the commonest shared shingle and the size within the factor that similarity allows.
    band = F.floor(F.log("n") / F.log(F.lit(100 / percent))).cast("int")
    alive = shared.groupBy("key").agg(F.first("n").alias("n"), F.max_by("token", F.struct("times", "token")).alias("common"), F.count("*").alias("k")).withColumn("band", band)
    # The smallest set that a class can be similar to has percent of its shingles.
    alive = written(alive.where(F.col("k") >= _common(F.ceil(percent * F.col("n") / 100))).drop("k"), "shared-classes")
    sizes = alive.groupBy("common", "band").agg(F.greatest(F.ceil(F.count("*") / group_classes), F.ceil(F.sum("n") / GROUP_SHINGLES)).alias("parts"))
    # Only split groups are joined; each is dealt over salts, so that the classes of a large one don't meet in one task.
    spread = sizes.where("parts > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    placed = alive.withColumn("salt", F.pmod(F.xxhash64("key", F.lit("salt")), F.lit(SALTS)).cast("int")).join(spread, ["common", "band", "salt"], "left")
    placed = placed.withColumn("part", F.pmod(F.xxhash64("key"), F.coalesce("parts", F.lit(1))))
    placed = written(placed.select("key", "n", F.xxhash64("common", "band", "part").alias("gid"),
                                   F.xxhash64("common", "band", F.lit(0).cast("bigint")).alias("head")), "shared-groups")

    heads = placed.where("head <> gid").select("key", F.col("head").alias("gid"))
    links = written(_verified(heads, placed, sets, percent, True), "near-links")
    joined = components(links).select(F.col("node").alias("key"), "root")
    known = written(placed.join(joined, "key", "left").select("key", "n", "gid", F.coalesce("root", "key").alias("comp")), "near-components")
    # Of two components the smaller one asks: the classes of a large cluster don't ask for each other's groups.
    weight = known.groupBy("comp").agg(F.count("*").alias("size"))
    known = written(known.join(weight, "comp").select("key", "n", "gid", "comp", F.struct("size", "comp").alias("weight")), "near-classes")

    # The matrix, without shingles whose classes are all connected already.
    rows = shared.select("token", "key").distinct().join(known, "key").repartition("token").withColumns(
        {"low": F.min("comp").over(token), "high": F.max("comp").over(token)})
    rows = written(rows.where("low <> high").select("token", "key", "n", "gid", "weight"), "open-shingles")
    limits = known.groupBy("gid").agg(F.min("n").alias("m_low"), F.max("n").alias("m_high"), F.max("weight").alias("m_weight"))
    matrix = rows.select(F.col("token").alias("m_token"), F.col("gid").alias("m_gid")).distinct().join(
        limits.withColumnRenamed("gid", "l_gid"), F.col("m_gid") == F.col("l_gid"))
    fits = (100 * F.col("m_high") >= percent * F.col("n")) & (percent * F.col("m_low") <= 100 * F.col("n"))
    pairs = rows.join(matrix, (F.col("token") == F.col("m_token")) & fits & (F.col("m_weight") > F.col("weight")))
    matched = pairs.groupBy("key", F.col("m_gid").alias("gid")).agg(F.count("*").alias("k"), F.first("n").alias("n"), F.first(F.col("m_low")).alias("low"))
    pairs = written(matched.where(F.col("k") >= _common(F.least("n", "low"))).select("key", "gid"), "candidate-groups")
    return components(written(links.unionByName(_verified(pairs, placed, sets, percent, False)), "all-links"))


def similar_documents(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, group_classes: int = GROUP_CLASSES,
                      doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles`` (the size of its set) and
    ``component_id``: the smallest id that links reach, its own included.

    Documents are linked if ``100 * |A & B| >= percent * |A | B|``.  A text
    without words (or null) has an empty set and is linked with nothing.  A null
    id is no component's smallest unless there is no other.  Repeated rows are
    linked like any others.
    """
    sets = shingle_sets(docs, shingle, doc_id, text)
    rows = sets.select("doc_id", "key", "n")
    roots = similar_classes(sets, percent, group_classes)
    classes = rows.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("least"))
    classes = classes.join(roots, F.col("key") == F.col("node"), "left").select("key", "least", F.coalesce("root", "key").alias("comp"))
    classes = written(classes, "classes")
    least = classes.groupBy("comp").agg(F.min("least").alias("component_id"))
    found = classes.join(least, "comp").select(F.col("key").alias("c_key"), "component_id")
    joined = rows.join(found, same(F.col("key"), F.col("c_key")) & (F.col("n") > 0), "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
