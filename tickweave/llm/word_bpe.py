"""Byte-level BPE, encoding each distinct word of the corpus once.

Texts are exploded into pre-tokens with their positions block by block: a block
(an Arrow step of documents) has a list of its distinct words and, for each
document, the places of its words in that list.  The lists are cut by a hash of
the word into ``buckets``, and a shuffle brings all blocks' words of a bucket
together, where each distinct word is encoded once.  The ids go back to their
block, where they are put in place of the positions.  So what is shuffled per
word is proportional to the distinct words of a block, not to the words of the
corpus, a frequent word is one entry per block, and no bucket or block depends
on a hot key.  The positions are shuffled once, by block; both the words and the
last step read that shuffle.  Decoding looks every id up in the token-byte table
of the vocabulary, whose size is fixed.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import map_arrow, steps, text_col
from tickweave.llm.pieces import number, rank_encoder, rank_table, spread

#: Characters of a block: enough that its words repeat, and bounds what a task holds.
BLOCK_CHARS = 4_000_000
#: A row is either the documents of a block (bucket -1: their ids, ends and the
#: places of their words) or its words of a bucket (later: their ids and counts).
EXPLODED = "block string, bucket int, doc_ids array<long>, ends binary, data binary"
_SEPARATOR = b"\xff"  # no byte of UTF-8


def _squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=6).compress(data)


def _expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _pack(array: np.ndarray) -> bytes:
    """Numbers with their bytes of equal rank together, compressed."""
    return _squeeze(np.ascontiguousarray(array, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(_expand(data), np.uint8).reshape(4, -1).T.copy().view("<u4")[:, 0]


def _explode_block(doc_ids: list, texts: list[str], buckets: int, at: tuple[int, int]) -> pa.RecordBatch:
    words, index, ends = number(texts)
    raw = [w.encode() for w in words]
    which = np.array([zlib.crc32(w) % buckets for w in raw], np.int64)
    # Words are numbered by bucket, then by their bytes: the order in which their ids come back.
    order = sorted(range(len(raw)), key=lambda k: (which[k], raw[k]))
    place = np.empty(len(raw), np.int64)
    place[order] = np.arange(len(raw))
    # The content, and the place (partition, number in it), which tells equal blocks apart: a task that runs again gives the same name.
    name = hashlib.sha256(repr((at, doc_ids)).encode() + _SEPARATOR.join(t.encode() for t in texts)).hexdigest()
    rows = [(name, -1, doc_ids, _pack(ends[1:]), _pack(place[index]))]
    ordered = which[order]
    edges = np.flatnonzero(np.diff(ordered, prepend=-1, append=buckets))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        rows.append((name, int(ordered[a]), None, None, _squeeze(_SEPARATOR.join(raw[k] for k in order[a:b]))))
    return _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary())
    columns = zip(*rows) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["block", "bucket", "doc_ids", "ends", "data"])


def explode_words(rows: DataFrame, buckets: int, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per block one row with the documents and the places of their words, and
    per bucket one row with the block's words of that bucket (ascending)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids, held, size, part, k = [], [], 0, TaskContext.get().partitionId(), 0
        for batch, texts in steps(batches, block_chars):
            n = sum(map(len, texts))
            if held and size + n > block_chars:
                yield _explode_block(doc_ids, held, buckets, (part, k))
                doc_ids, held, size, k = [], [], 0, k + 1
            doc_ids += batch.column("doc_id").to_pylist()
            held += texts
            size += n
        if held:
            yield _explode_block(doc_ids, held, buckets, (part, k))

    return map_arrow(rows, run, EXPLODED)


def encode(docs: DataFrame, ranks: str, pattern: str, buckets: int | None = None, block_chars: int = BLOCK_CHARS,
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit) of every row.

    ``ranks`` is a rank file, ``pattern`` its pre-token pattern (the one of
    ``pieces.cut``).  Special tokens are ordinary text.  Null or empty texts
    have no ids; repeated rows are repeated.  ``buckets`` defaults to the
    session's shuffle partitions.
    """
    buckets = buckets or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_col(text).alias("text"))
    # Both readers take all rows of this shuffle (and choose theirs in Python), so that it is made once.
    exploded = explode_words(rows, buckets, block_chars).repartition(buckets, "block")

    def only_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(batch.column("bucket").to_numpy() >= 0))

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, kept, now = rank_encoder(ranks, pattern), {}, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["bucket"] != now:
                    now, kept = row["bucket"], {}  # each word of the bucket is encoded once
                ids, counts = [], []
                for w in _expand(row["data"]).split(_SEPARATOR):
                    found = kept.get(w)
                    if found is None:
                        found = kept[w] = encoder.raw(w)
                    ids += found
                    counts.append(len(found))
                out.append((row["block"], now, None, _pack(np.array(counts)), _pack(np.array(ids))))
            yield _batch(out)

    def put_together(block: pa.Table, encoded: pa.Table) -> pa.Table:
        words = sorted(encoded.to_pylist(), key=lambda r: r["bucket"])
        counts, ids = [_unpack(r["ends"]) for r in words], [_unpack(r["data"]) for r in words]
        done = [b for row in block.filter(pa.array(block.column("bucket").to_numpy() < 0)).to_pylist() for b in _documents(row, counts, ids)]
        if not done:
            raise ValueError("a block has words but no documents")
        return pa.Table.from_batches(done)

    words = map_arrow(exploded, only_words, EXPLODED).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    encoded = map_arrow(words, encode_words, EXPLODED)
    return exploded.groupBy("block").cogroup(encoded.groupBy("block")).applyInArrow(put_together, "doc_id long, ids binary")


def _documents(row: dict, counts: list[np.ndarray], ids: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The ids of a block's documents, a few documents at a time."""
    places, ends = _unpack(row["data"]), _unpack(row["ends"]).astype(np.int64)
    lengths = np.concatenate(counts).astype(np.int64) if counts else np.zeros(0, np.int64)
    flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    if len(places) and (int(places.max()) + 1 != len(lengths) or int(lengths.sum()) != len(flat)):
        raise ValueError(f"block {row['block']} did not get the ids of all its words")
    begin = np.concatenate([[0], ends])
    first = 0
    while first < len(ends):
        last = max(first + 1, int(np.searchsorted(ends, begin[first] + 500_000, "right")))
        got, count = spread(places[begin[first]: ends[last - 1]], flat, lengths)
        bounds = np.concatenate([[0], np.cumsum(count)])[np.concatenate([[0], ends[first:last] - begin[first]])]
        data = got.astype("<u4").tobytes()
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.array(row["doc_ids"][first:last], pa.int64()),
            "ids": pa.array([data[4 * a: 4 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.binary())})
        first = last


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """Add ``decoded`` (bytes) to rows with ``ids``: each id's bytes from the
    token-byte table, one after the other.  An id that the table lacks is an error."""
    names = list(encoded.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = {i: b for b, i in rank_table(ranks).items()}
        for batch in batches:
            done = [b"".join(map(table.__getitem__, np.frombuffer(x or b"", "<u4").tolist())) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(done, pa.binary())], names=[*names, "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return map_arrow(encoded, run, f"{fields}, decoded binary")
