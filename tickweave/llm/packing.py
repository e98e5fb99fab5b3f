"""Best-fit packing by minimum bin slack.

Documents are encoded; only longer ones than a sequence are cut.  The pieces
are known to the planner by their lengths alone: a histogram with at most
``capacity`` entries, whatever the size of the corpus.  Per bin, the longest
remaining piece is taken and a subset-sum table (the bits of one integer: which
sums can be reached) over the available lengths gives the fullest feasible
filling of the rest, which is then removed.  A filling is used at once as often
as the counts allow, so the number of steps depends on the lengths, not on the
pieces.  The plan gives ranges of ranks of each length; pieces get their rank
per length by a window over (length, salt) and the counts of the salts before,
so that a length which a third of all pieces have is spread over the tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickweave.llm.common import map_arrow, steps, text_col, written
from tickweave.llm.pieces import json_encoder

CAPACITY = 2048
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` ids: whole sequences, the first
    piece shorter if they don't divide evenly."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = False,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of all documents, optionally with their ids (little-endian
    unsigned 32-bit).  An empty or null text is one piece, the end id alone."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_col(text).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = json_encoder(tokenizer)
        for batch, texts in steps(batches):
            ids, offsets = encoder.texts(texts)
            data = np.insert(ids, offsets[1:], np.uint32(end_id)).astype("<u4").tobytes()
            offsets = offsets + np.arange(len(offsets))
            out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            for d, a, b in zip(batch.column("doc_id").to_pylist(), offsets.tolist(), offsets[1:].tolist()):
                for k, (start, length) in enumerate(piece_bounds(b - a, capacity)):
                    part = data[4 * (a + start): 4 * (a + start + length)]
                    for name, value in zip(out, (d, k, start, length, zlib.crc32(part), part if with_ids else None)):
                        out[name].append(value)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(out["doc_id"], pa.int64()), "piece": pa.array(out["piece"], pa.int32()),
                **{k: pa.array(out[k], pa.int64()) for k in ("start", "length", "ids_crc32")},
                **({"ids": pa.array(out["ids"], pa.binary())} if with_ids else {})})

    return map_arrow(rows, cut, PIECES + (", ids binary" if with_ids else ""))


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Which lengths, how often each, fill ``room`` as far as ``counts`` allow
    (longer ones first); subset sums as bits of an integer."""
    mask, reach = (1 << room + 1) - 1, 1
    tried: list[tuple[int, int, int]] = []  # sums reachable before, length, copies
    for length in sorted((x for x in counts if x <= room and counts[x]), reverse=True):
        left, copies = min(counts[length], room // length), 1
        while left > 0 and not reach >> room & 1:
            copies = min(copies, left)
            tried.append((reach, length, copies))
            reach |= reach << length * copies & mask
            left -= copies
            copies *= 2
        if reach >> room & 1:
            break
    total, out = reach.bit_length() - 1, {}
    for before, length, copies in reversed(tried):
        if not before >> total & 1:
            total -= length * copies
            out[length] = out.get(length, 0) + copies
    return out


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, sequences, first sequence, offset), ordered by
    length and rank: of the pieces of a length, the ranks from ``first rank`` on
    go to the ``sequences`` from ``first sequence`` on, one each, then to the
    same ones again a length further, and so on to the next row's first rank."""
    counts = {k: v for k, v in histogram.items() if v}
    used, rows, sequence = dict.fromkeys(counts, 0), [], 0
    while counts:
        longest = max(counts)
        counts[longest] -= 1
        filling = fullest(counts, capacity - longest)
        counts[longest] += 1
        filling[longest] = filling.get(longest, 0) + 1
        times = min(counts[x] // k for x, k in filling.items())
        offset = 0
        for length in sorted(filling, reverse=True):
            k = filling[length]
            rows.append((length, used[length], times, sequence, offset))
            used[length] += times * k
            offset += length * k
            counts[length] -= times * k
            if not counts[length]:
                del counts[length]
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (column ``length``, 1 to
    ``capacity``).  ``pieces`` is read more than once: give a written table.
    Repeated rows are pieces of their own.  The order among equal lengths is
    free, so which of them meet in a sequence is too."""
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if histogram and not 1 <= min(histogram) <= max(histogram) <= capacity:
        raise ValueError(f"piece lengths must be 1 to {capacity}")
    plan = plan_bins(histogram, capacity)
    salts = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    first = salted.groupBy("length", "salt").agg(F.count("*").alias("n")).select(
        F.col("length").alias("l"), F.col("salt").alias("s"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece")) - 1
    ranked = salted.withColumn("rank", within).join(first, (F.col("length") == F.col("l")) & (F.col("salt") == F.col("s")))
    ranked = ranked.select(*pieces.columns, (F.col("first") + F.col("rank")).cast("long").alias("rank"))

    names = list(pieces.columns)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (plan[:, 0] << 48) + plan[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            row = plan[np.searchsorted(key, (length << 48) + rank, "right") - 1]
            copy, which = np.divmod(rank - row[:, 1], row[:, 2]) if len(row) else (rank, rank)
            arrays = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(row[:, 3] + which), pa.array(row[:, 4] + copy * length)],
                names=[*names, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return map_arrow(ranked, place, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """Place every document: one row per piece (``doc_id``, ``piece``, ``start``,
    ``length``, ``ids_crc32``, ``sequence_id``, ``offset``)."""
    return pack_pieces(written(token_pieces(docs, tokenizer, end_id, capacity), "pieces"), capacity)


def sequences(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences themselves: ``sequence_id``, ``n_ids`` and ``ids``
    (little-endian unsigned 32-bit), at most ``capacity`` ids in each."""
    packed = pack_pieces(written(token_pieces(docs, tokenizer, end_id, capacity, with_ids=True), "pieces"), capacity)
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.expr("aggregate(parts, 0L, (n, p) -> n + p.length)").alias("n_ids"),
        F.expr("aggregate(parts, X'', (b, p) -> concat(b, p.ids))").alias("ids"))
