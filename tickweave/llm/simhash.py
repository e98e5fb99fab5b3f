"""SimHash near-duplicates, linked by Golay-code fuzzy hashing.

A fingerprint has a bit set where more than half of the document's shingle
hashes have it.  Distinct fingerprints are linked at ``MAX_BITS`` (4) or fewer
differing bits.  A fingerprint is cut into two segments of 23 bits and one of
18; the four errors can't be large in all of them (pigeonhole).  With errors
(x, y, z) of the segments one of these always holds, and gives join keys:

* x = 0 and y <= 2: the first segment and a Golay key of the second;
  likewise y = 0 and x <= 2
* x = 0 and z <= 1: the first segment and two of the three 6-bit blocks of the
  third; likewise y = 0
* z = 0 and x <= 2 or y <= 2: the third segment and a Golay key of one other
* x, y and z from 1 to 2: Golay keys of the first two and one of the three blocks

Golay keys of segments with at most two errors share one (``golay``), so no
link is lost.  That is about 110 keys of 30 to 35 bits per distinct fingerprint:
the rows grow in proportion to the fingerprints, and unrelated ones rarely meet.
All that meet under a key are verified; a key with more than ``BLOCK``
fingerprints is cut into blocks, and each pair of blocks is a row of its own
(no group is ever gathered whole).  A task hands on a spanning star of the links
it finds, never all pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import map_arrow, same, steps, text_col, unused, written
from tickweave.llm.components import components, local_roots
from tickweave.llm.golay import BITS, fuzzy_keys

SHINGLE = 4
MAX_BITS = 4
#: Fixed value: the seed of the shingle hash.
SEED = 42
#: Fingerprints under one key that are compared in one place.
BLOCK = 2048
#: Narrow rows per Arrow batch, and fingerprints whose keys are made in one step.
KEY_ROWS = 100_000
_KEY_STEP = 500
_WORD = re.compile(rb"[^\x20\x09-\x0d]+")
LINKS = "a long, b long, key long, block int, members binary"


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The SimHash of a text: A-Z lower-cased, shingles with repeats."""
    import xxhash

    words, digest = _WORD.findall(text.encode().lower()), xxhash.xxh64_intdigest
    if not words:
        return 0
    if len(words) < shingle:
        parts = [words]
    else:
        parts = zip(*(words[k:] for k in range(shingle)))
    hashes = np.array([digest(b" ".join(p), SEED) for p in parts], "<u8")
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[k: k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _mark(text: str) -> Column:
    """A digest of the text: with the id it tells rows apart."""
    return F.unhex(F.sha2(text_col(text), 256))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text", marked: bool = False) -> DataFrame:
    """``doc_id`` and ``print`` (the 64 bits as a signed number) of every row,
    and with ``marked`` a digest of its text, ``mark``."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_col(text).alias("text"), *([_mark(text).alias("mark")] if marked else []))
    names = ["doc_id", "mark"] if marked else ["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in steps(batches):
            prints = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(prints)], names=[*names, "print"])

    return map_arrow(rows, run, f"doc_id long, {'mark binary, ' if marked else ''}print long")


def join_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys of fingerprints (uint64) and, for each key, its fingerprint."""
    one, two, three = ((prints >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in ((0, BITS), (BITS, BITS), (46, 18)))
    blocks = [three >> 6 * k & 63 for k in range(3)]
    pairs = [(blocks[a] << 6 | blocks[b]) << 2 | a + b for a, b in ((0, 1), (0, 2), (1, 2))]
    (g1, f1), (g2, f2) = fuzzy_keys(one), fuzzy_keys(two)
    rows1, cols1 = np.nonzero(f1)
    rows2, cols2 = np.nonzero(f2)
    k1, k2 = g1[rows1, cols1], g2[rows2, cols2]
    n = np.arange(len(prints))
    made = [(one[rows2] << 12 | k2, rows2), (two[rows1] << 12 | k1, rows1),
            (three[rows1] << 12 | k1, rows1), (three[rows2] << 12 | k2, rows2)]
    made += [(segment << 14 | pair, n) for segment in (one, two) for pair in pairs]
    # Every key of the first segment with every key of the second.
    count2 = np.bincount(rows2, minlength=len(prints))
    begin2 = np.cumsum(count2) - count2
    times = count2[rows1]
    both = np.repeat(rows1, times)
    second = np.arange(len(both)) - np.repeat(np.cumsum(times) - times, times) + begin2[both]
    joint = np.repeat(k1, times) << 12 | k2[second]
    made += [((joint << 6 | block[both]) << 2 | k, both) for k, block in enumerate(blocks)]
    kinds = [0, 1, 2, 3, 4, 4, 4, 5, 5, 5, 6, 6, 6]
    keys = np.concatenate([key | kind << 40 for kind, (key, _) in zip(kinds, made)])
    return keys, prints[np.concatenate([rows for _, rows in made])]


def _close(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    return np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)) <= max_bits


def _links(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    member, root = local_roots(a, b)
    return pa.RecordBatch.from_pydict({
        "a": pa.array(member, pa.int64()), "b": pa.array(root, pa.int64()), "key": pa.nulls(len(member), pa.int64()),
        "block": pa.nulls(len(member), pa.int32()), "members": pa.nulls(len(member), pa.binary())})


def _blocks(key: int, first: int, members: np.ndarray) -> pa.RecordBatch:
    parts = [members[k: k + BLOCK] for k in range(0, len(members), BLOCK)]
    n = len(parts)
    return pa.RecordBatch.from_pydict({
        "a": pa.nulls(n, pa.int64()), "b": pa.nulls(n, pa.int64()), "key": pa.array([key] * n, pa.int64()),
        "block": pa.array(range(first, first + n), pa.int32()), "members": pa.array([p.tobytes() for p in parts], pa.binary())})


def _verify(keys: np.ndarray, prints: np.ndarray, max_bits: int) -> Iterator[pa.RecordBatch]:
    """Links among the fingerprints of each key; ``keys`` ascend."""
    at, step, a, b = np.arange(len(keys)), 1, [], []
    while True:
        at = at[at + step < len(keys)]
        at = at[keys[at] == keys[at + step]]
        if not len(at):
            break
        hit = at[_close(prints[at], prints[at + step], max_bits)]
        a.append(prints[hit])
        b.append(prints[hit + step])
        step += 1
    if sum(map(len, a)):
        yield _links(np.concatenate(a), np.concatenate(b))


def _meet_closed(keys: np.ndarray, owners: np.ndarray, max_bits: int) -> Iterator[pa.RecordBatch]:
    """Whole groups: the links of small ones, the blocks of large ones."""
    if not len(keys):
        return
    begin = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
    size = np.diff(np.append(begin, len(keys)))
    for k in np.flatnonzero(size > BLOCK):
        yield _blocks(int(keys[begin[k]]), 0, owners[begin[k]: begin[k] + size[k]])
    few = np.repeat((size > 1) & (size <= BLOCK), size)
    yield from _verify(keys[few], owners[few], max_bits)


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """A written table of pairs ``a``, ``b`` whose components are those of all
    pairs of distinct fingerprints (column ``print``, no repeats) within ``max_bits`` (up to 4)."""
    if max_bits > MAX_BITS:
        raise ValueError(f"the keys cover up to {MAX_BITS} bits")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column("print").to_numpy()
            for k in range(0, len(every), _KEY_STEP):
                keys, owners = join_keys(every[k: k + _KEY_STEP].view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(owners.view(np.int64))], names=["key", "print"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, owners = np.zeros(0, np.int64), np.zeros(0, np.int64)
        hot, cut = None, 0  # the key whose fingerprints go out in blocks, and its blocks so far
        for batch in chain(batches, [None]):
            if batch is not None:
                keys = np.concatenate([keys, batch.column("key").to_numpy()])
                owners = np.concatenate([owners, batch.column("print").to_numpy()])
            # The last key may go on in the next batch.
            stop = int(np.searchsorted(keys, keys[-1])) if batch is not None and len(keys) else len(keys)
            if hot is not None and stop:
                rest = int(np.searchsorted(keys[:stop], hot, "right"))
                if rest:
                    yield _blocks(hot, cut, owners[:rest])
                hot = None
            else:
                rest = 0
            yield from _meet_closed(keys[rest:stop], owners[rest:stop], max_bits)
            keys, owners = keys[stop:], owners[stop:]
            full = len(keys) // BLOCK * BLOCK
            if full > BLOCK:
                if hot is None:
                    hot, cut = int(keys[0]), 0
                yield _blocks(hot, cut, owners[:full])
                cut += full // BLOCK
                keys, owners = keys[full:], owners[full:]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                one, other = (np.frombuffer(row[c], np.int64) for c in ("members", "others"))
                found = [(k + i, j) for k in range(0, len(one), 256)
                         for i, j in [np.nonzero(_close(one[k: k + 256, None], other[None, :], max_bits))]]
                i, j = (np.concatenate(x) for x in zip(*found))
                yield _links(one[i], other[j]).select(["a", "b"])

    keyed = map_arrow(prints.select("print"), make, "key long, print long")
    met = map_arrow(keyed.repartition("key").sortWithinPartitions("key"), meet, LINKS)
    met = written(met, "links", batch_rows=KEY_ROWS)
    out, blocks = met.where("a IS NOT NULL").select("a", "b"), met.where("members IS NOT NULL").select("key", "block", "members")
    if blocks.limit(1).count():
        others = blocks.toDF("key", "other", "others")
        pairs = blocks.join(others, "key").where("block <= other").select("members", "others").repartition()
        out = out.union(written(map_arrow(pairs, compare, "a long, b long"), "block-links"))
    return out


def _classes(rows: DataFrame, max_bits: int) -> DataFrame:
    """Add ``root`` (a fingerprint that names the component, never null) and
    ``component_id`` to the rows of ``fingerprints``, a written table."""
    distinct = written(rows.groupBy("print").agg(F.min("doc_id").alias("first_id")), "distinct-prints")
    star = components(links(distinct, max_bits))
    owned = distinct.join(star, F.col("print") == F.col("node"), "left").select("print", "first_id", F.coalesce("root", "print").alias("root"))
    named = owned.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = owned.select("print", F.col("root").alias("of")).join(named, F.col("of") == F.col("root")).select("print", "root", "component_id")
    return rows.join(classes, "print")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``print`` and ``component_id`` (the smallest id that links
    reach) of every row.

    A text without words (null, empty) has the fingerprint zero and links like
    any other.  Repeated rows are equal.  A component without any id has a null.
    """
    rows = written(fingerprints(docs, shingle, doc_id, text), "prints")
    return _classes(rows, max_bits).select("doc_id", "print", "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component stays, the one with the smallest id, with
    all its columns.  Of rows that repeat that id in the component one stays; of
    a component without any id one row stays.  An id that several components
    have as their smallest stays once in each."""
    rows = written(fingerprints(docs, shingle, doc_id, text, marked=True), "prints")
    # Equal texts have one fingerprint, so an id and a mark belong to one component.
    least = _classes(rows, max_bits).where(same(F.col("doc_id"), F.col("component_id")))
    found = least.groupBy("root", "doc_id", "mark").agg(F.count("*").alias("n"))
    mark, k_id, k_mark = (unused(docs, c) for c in ("mark", "k_id", "k_mark"))
    stay = written(found.groupBy("root", "doc_id").agg(F.min(F.struct("mark", "n")).alias("first")).select(
        F.col("doc_id").alias(k_id), F.col("first.mark").alias(k_mark), F.col("first.n").alias("n")), "stay")
    kept = docs.withColumn(mark, _mark(text)).join(
        stay.hint("shuffle_hash"), same(F.col(doc_id).cast("long"), F.col(k_id)) & (F.col(mark) == F.col(k_mark)), "left_semi")
    if stay.where("n > 1").limit(1).count():
        kept = kept.dropDuplicates([doc_id, mark])  # partial per task: equal rows never meet in one place in full
    return kept.select(*docs.columns)
