"""Token-id files: patched frame-of-reference blocks with a block index.

A file holds the ids of a run of documents, one after the other, in blocks of
``BLOCK`` ids.  A block stores the differences to its smallest id at the bit
width that ``PERCENTILE`` percent of them need; a wider difference is an
exception, kept with its place behind the packed bits.  The footer has one
entry per block (its start in the file, smallest id, width, exceptions, ids)
and one per document (id, end of its ids), so that any document can be read by
itself.  All numbers are little-endian:

    magic | blocks: packed bits, exception places (u2), exception values (u4) |
    block entries | document entries | footer start (u8), blocks (u8), documents (u8), magic

Each task writes one file under a name of its own and reports it; only files
of tasks that ended well are in the list (the manifest), so a task that ran
twice leaves a file nobody reads and nothing is counted double.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickweave.llm.common import filesystem, map_arrow, shared_path, steps, text_col, written
from tickweave.llm.pieces import json_encoder

BLOCK = 1024
PERCENTILE = 90
#: Blocks that are coded or decoded in one numpy step.
STEP_BLOCKS = 512
MAGIC = b"TWPFOR01"
BLOCK_ENTRY = np.dtype([("start", "<u8"), ("low", "<u4"), ("width", "u1"), ("exceptions", "<u2"), ("ids", "<u4")])
DOC_ENTRY = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("end", "<u8")])
MANIFEST = "part int, file string, n_docs long, n_tokens long"


def _bits(width: int):
    """For 64 numbers of a bit width packed into ``width`` 64-bit words: number,
    word and shift of each, and whether it goes on in the next word."""
    for k in range(64):
        word, shift = divmod(k * width, 64)
        yield k, word, np.uint64(shift), shift + width > 64


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bits of each number, little-endian, row by row as bytes;
    rows of a multiple of 64 numbers."""
    v = np.ascontiguousarray((values & np.uint32((1 << width) - 1)).reshape(-1, 64).T.astype(np.uint64))
    words = np.zeros((width, v.shape[1]), np.uint64)
    for k, word, shift, crosses in _bits(width):
        words[word] |= v[k] << shift
        if crosses:
            words[word + 1] |= v[k] >> (np.uint64(64) - shift)
    return np.ascontiguousarray(words.T).astype("<u8", copy=False).view(np.uint8).reshape(len(values), -1)


def unpack_bits(data: np.ndarray, width: int, n: int) -> np.ndarray:
    """The inverse of ``pack_bits``: rows of ``n`` numbers."""
    words = np.ascontiguousarray(np.ascontiguousarray(data).view("<u8").reshape(-1, width).T)
    v = np.empty((64, words.shape[1]), np.uint64)
    for k, word, shift, crosses in _bits(width):
        v[k] = words[word] >> shift
        if crosses:
            v[k] |= words[word + 1] << (np.uint64(64) - shift)
    return (np.ascontiguousarray(v.T) & np.uint64((1 << width) - 1)).astype(np.uint32).reshape(-1, n)


def pack_blocks(values: np.ndarray, percentile: float = PERCENTILE) -> tuple[list[bytes], np.ndarray]:
    """The bytes and entries (starts unset) of full blocks, ``values`` being
    uint32 of shape (blocks, BLOCK)."""
    low = values.min(axis=1)
    diff = values - low[:, None]
    need = np.frexp(diff.astype(np.float64))[1].astype(np.uint8)  # bits of each difference
    rank = max(0, int(np.ceil(values.shape[1] * percentile / 100)) - 1)
    width = np.partition(need, rank, axis=1)[:, rank]
    entries = np.zeros(len(values), BLOCK_ENTRY)
    entries["low"], entries["width"], entries["ids"] = low, width, values.shape[1]
    out: list[bytes] = [b""] * len(values)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        packed = pack_bits(diff[rows], int(w)) if w else np.zeros((len(rows), 0), np.uint8)
        for row, data in zip(rows, packed):
            wide = np.flatnonzero(need[row] > w)
            entries["exceptions"][row] = len(wide)
            out[row] = data.tobytes() + wide.astype("<u2").tobytes() + diff[row, wide].astype("<u4").tobytes()
    return out, entries


def unpack_blocks(data: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The ids of blocks one after the other; ``data`` (bytes) begins at the first block."""
    starts = (entries["start"] - entries["start"][0]).astype(np.int64)
    values = np.zeros((len(entries), BLOCK), "<u4")
    for w in np.unique(entries["width"]):
        rows, size = np.flatnonzero(entries["width"] == w), BLOCK * int(w) // 8
        if w:
            values[rows] = unpack_bits(data[starts[rows][:, None] + np.arange(size)], int(w), BLOCK)
    for row in np.flatnonzero(entries["exceptions"]):
        at, n = starts[row] + BLOCK * int(entries["width"][row]) // 8, int(entries["exceptions"][row])
        places = data[at: at + 2 * n].view("<u2")
        values[row, places] = np.frombuffer(data[at + 2 * n: at + 6 * n].tobytes(), "<u4")
    values += entries["low"][:, None].astype(np.uint32)
    keep = np.arange(BLOCK) < entries["ids"][:, None]
    return values[keep]


class FileWriter:
    """Writes ids as they come; holds at most STEP_BLOCKS blocks of ids."""

    def __init__(self, out, percentile: float = PERCENTILE):
        self._out, self._percentile, self._held, self._n = out, percentile, [], 0
        self._at, self._blocks, self._docs, self.tokens = len(MAGIC), [], [], 0
        out.write(MAGIC)

    def add(self, doc_ids: list[int | None], ids: np.ndarray, ends: np.ndarray) -> None:
        docs = np.zeros(len(doc_ids), DOC_ENTRY)
        docs["doc_id"], docs["known"] = [d or 0 for d in doc_ids], [d is not None for d in doc_ids]
        docs["end"] = ends + self.tokens
        self._docs.append(docs)
        self.tokens += len(ids)
        self._held.append(ids)
        self._n += len(ids)
        if self._n >= STEP_BLOCKS * BLOCK:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self._held) if self._held else np.zeros(0, np.uint32)
        full, rest = divmod(len(ids), BLOCK)
        if last and rest:
            ids = np.concatenate([ids, np.full(BLOCK - rest, ids[full * BLOCK:].min(), np.uint32)])
            full += 1
        for k in range(0, full, STEP_BLOCKS):
            blocks, entries = pack_blocks(ids[k * BLOCK: min(full, k + STEP_BLOCKS) * BLOCK].reshape(-1, BLOCK), self._percentile)
            sizes = np.array([len(b) for b in blocks])
            entries["start"] = self._at + np.cumsum(sizes) - sizes
            if last and rest and k + STEP_BLOCKS >= full:
                entries["ids"][-1] = rest
            self._out.write(b"".join(blocks))
            self._at += int(sizes.sum())
            self._blocks.append(entries)
        self._held = [ids[full * BLOCK:]]
        self._n = len(self._held[0])

    def close(self) -> None:
        self._flush(True)
        for entries in (*self._blocks, *self._docs):
            self._out.write(entries.tobytes())
        tail = (self._at, sum(map(len, self._blocks)), sum(map(len, self._docs)))
        self._out.write(np.array(tail, "<u8").tobytes() + MAGIC)


class FileReader:
    """Reads a file of FileWriter; ``source`` has ``size()`` and ``read_at(n, at)``."""

    def __init__(self, source):
        self._source, size = source, source.size()
        tail = source.read_at(24 + len(MAGIC), size - 24 - len(MAGIC))
        if tail[24:] != MAGIC:
            raise ValueError("not a token file, or cut off")
        at, blocks, docs = (int(x) for x in np.frombuffer(tail[:24], "<u8"))
        self._end = at
        self.blocks = np.frombuffer(source.read_at(blocks * BLOCK_ENTRY.itemsize, at), BLOCK_ENTRY)
        self.docs = np.frombuffer(source.read_at(docs * DOC_ENTRY.itemsize, at + blocks * BLOCK_ENTRY.itemsize), DOC_ENTRY)

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids at places first to last (exclusive) of the file."""
        if first >= last:
            return np.zeros(0, np.uint32)
        a, b = first // BLOCK, (last - 1) // BLOCK + 1
        begin = int(self.blocks["start"][a])
        end = int(self.blocks["start"][b]) if b < len(self.blocks) else self._end
        data = np.frombuffer(self._source.read_at(end - begin, begin), np.uint8)
        return unpack_blocks(data, self.blocks[a:b])[first - a * BLOCK: last - a * BLOCK]

    def documents(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Document entries, the ids of these documents, and where each begins in
        the file, in steps of about STEP_BLOCKS blocks."""
        ends = self.docs["end"].astype(np.int64)
        begin = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        first = 0
        while first < len(ends):
            last = max(first + 1, int(np.searchsorted(ends, begin[first] + STEP_BLOCKS * BLOCK, "right")))
            yield self.docs[first:last], self.ids(int(begin[first]), int(ends[last - 1])), begin[first:last]
            first = last


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = None,
                      percentile: float = PERCENTILE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode all texts, append ``end_id`` to each, write the ids in ascending
    ``doc_id`` order and return the manifest (one row per file, ``part`` ascending
    with the ids).

    Null ids come first.  Rows with the same id are ordered by their text.  An
    empty text has just the end id (or nothing).  An empty table gives no file.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_col(text).alias("text"))
    sorted_rows = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer, n, part = json_encoder(tokenizer), None, 0, TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.ids"
        out = None
        for batch, texts in steps(batches):
            if writer is None:
                files, root = filesystem(folder)
                files.create_dir(root, recursive=True)
                out = files.open_output_stream(f"{root}/{name}")
                writer = FileWriter(out, percentile)
            ids, offsets = encoder.texts(texts)
            if end_id is not None:
                ids = np.insert(ids, offsets[1:], np.uint32(end_id))
                offsets = offsets + np.arange(len(offsets))
            writer.add(batch.column("doc_id").to_pylist(), ids, offsets[1:])
            n += len(texts)
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "file": [f"{folder}/{name}"],
                "n_docs": pa.array([n], pa.int64()), "n_tokens": pa.array([writer.tokens], pa.int64())})

    return written(map_arrow(sorted_rows, write, MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Every document of the files: ``doc_id``, ``start`` (ids of all documents
    before it), ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit)."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = manifest.withColumn("first", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long"))
    n = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, path = filesystem(row["file"])
                with files.open_input_file(path) as source:
                    for docs, ids, begin in FileReader(source).documents():
                        ends = docs["end"].astype(np.int64) - begin[0]
                        yield pa.RecordBatch.from_pydict({
                            "doc_id": pa.array(docs["doc_id"], pa.int64(), mask=docs["known"] == 0),
                            "start": pa.array(begin + row["first"], pa.int64()),
                            "n_tokens": pa.array(docs["end"].astype(np.int64) - begin, pa.int64()),
                            "ids": binary_slices(ids, ends)})

    return map_arrow(files.repartition(n), read, "doc_id long, start long, n_tokens long, ids binary")


def binary_slices(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The ids up to each end as a binary column, without a copy per row."""
    offsets = np.concatenate([[0], ends]).astype(np.int32) * 4
    data = np.ascontiguousarray(ids, "<u4")
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def token_files_of(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int | None = None) -> DataFrame:
    """Write the files to a new shared folder and read them back."""
    return read_token_files(write_token_files(docs, shared_path(spark, "token-files"), tokenizer, end_id))
