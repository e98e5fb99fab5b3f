"""Merkle manifest of a data set by time-forward processing.

A leaf is the digest of a row's fields.  Leaves of one tree (say, a language)
are in a fixed order; every two consecutive nodes become the digest of their
digests, the last one alone if nothing follows it, until one node remains.
The roots of all trees are the leaves of one more tree.

Nodes are processed in the order of their labels (level, place).  A node sends
its digest forward to its parent through a priority queue ordered by label, so
a node finds the digests of its children at the head of the queue when its turn
comes.  A second sweep in the reversed order starts at the root: each node
receives its proof (the siblings from it to the root), puts the sibling of each
child before it and sends it down, until the leaves have theirs.

A tree of any size is cut into subtrees of ``2^SPAN`` leaves, which are swept
side by side; their roots are the leaves of the next tier.  Between tiers the
messages go through Spark's sorted shuffle, which is the part of the queue that
lies outside of a task; inside a task the queue spills sorted runs beyond
``HELD`` messages.  No tree, however large, meets in one task.

Places in a tree come from a range sort of narrow rows (order, digest): counts
per sorted partition, summed over the partitions before it.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.llm.common import map_arrow, written

#: Levels of a subtree that one task sweeps at a time.
SPAN = 12
#: Messages that a queue holds in memory.
HELD = 1 << 16
LEFT, RIGHT, ALONE = "L", "R", "="


def field(value: Column) -> Column:
    """A field as it goes into a digest: ``-`` for null, else the number of its
    UTF-8 bytes, a colon and its text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


class LabelQueue:
    """A priority queue of (label, value); beyond ``held`` messages the ones in
    memory are written to a temporary file as a sorted run."""

    def __init__(self, held: int = HELD):
        self._held, self._heap, self._heads = held, [], []

    def push(self, label: tuple, value) -> None:
        heapq.heappush(self._heap, (label, value))
        if len(self._heap) > self._held:
            run = self._read(sorted(self._heap))
            self._heap = []
            heapq.heappush(self._heads, (*next(run), id(run), run))

    @staticmethod
    def _read(entries: list) -> Iterator:
        with tempfile.TemporaryFile() as f:
            for e in entries:
                pickle.dump(e, f)
            n = len(entries)
            del entries
            f.seek(0)
            for _ in range(n):
                yield pickle.load(f)

    def head(self) -> tuple | None:
        """The smallest label."""
        labels = [q[0][0] for q in (self._heap, self._heads) if q]
        return min(labels) if labels else None

    def pop(self):
        """The value of the smallest label."""
        if not self._heads or self._heap and self._heap[0][:2] <= self._heads[0][:2]:
            return heapq.heappop(self._heap)[1]
        label, value, _, run = self._heads[0]
        following = next(run, None)
        if following is None:
            heapq.heappop(self._heads)
        else:
            heapq.heapreplace(self._heads, (*following, id(run), run))
        return value


def levels_of(n: int, span: int) -> int:
    """Levels that a subtree rises when its tree has ``n`` nodes in this tier."""
    return span if n > 1 << span else (max(n, 1) - 1).bit_length()


def sweep(leaves: Sequence[str], levels: int, held: int = HELD) -> list[list[str]]:
    """The digests of all nodes, level by level, after ``levels`` levels."""
    queue, nodes = LabelQueue(held), [[] for _ in range(levels + 1)]
    for place, leaf in enumerate(leaves):
        queue.push((0, place, 0), leaf)
    while (label := queue.head()) is not None:
        level, place = label[:2]
        got = [queue.pop()]
        while (label := queue.head()) is not None and label[:2] == (level, place):
            got.append(queue.pop())
        node = hashlib.sha256("".join(got).encode()).hexdigest() if level else got[0]
        nodes[level].append(node)
        if level < levels:
            queue.push((level + 1, place // 2, place % 2), node)
    return nodes


def sweep_back(nodes: list[list[str]], proof: tuple, held: int = HELD) -> list[tuple]:
    """The proofs of the lowest nodes from the proof of the topmost one."""
    queue, out = LabelQueue(held), [()] * len(nodes[0])
    queue.push((1 - len(nodes), 0), proof)
    while (label := queue.head()) is not None:
        level, place = -label[0], -label[1]
        proof = queue.pop()
        if not level:
            out[place] = proof
            continue
        below = nodes[level - 1]
        a, b = 2 * place, 2 * place + 1
        if b < len(below):
            queue.push((1 - level, -b), ((LEFT + below[a]), *proof))
            queue.push((1 - level, -a), ((RIGHT + below[b]), *proof))
        else:
            queue.push((1 - level, -a), (ALONE, *proof))
    return out


def _groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys; batches come sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = list(zip(*(batch.column(k).to_pylist() for k in keys)))
        start = 0
        for i, mark in enumerate(marks):
            if mark != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], i, mark
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def _placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` (with ``tree``, never null) and their place ``pos`` in the tree
    by the columns ``order`` (nulls first), and the tree's size ``n``."""
    by = [F.col("tree"), *(F.col(c).asc_nulls_first() for c in order)]
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    # After the sort: partition number above bit 33, place in the partition below it.
    dealt = written(dealt.withColumn("at", F.monotonically_increasing_id()), "merkle-order").withColumn("part", F.shiftright("at", 33))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("k"))
    parts = parts.select(F.col("tree").alias("p_tree"), F.col("part").alias("p_part"), "first",
                         F.coalesce(F.sum("k").over(before), F.lit(0)).alias("start"),
                         F.sum("k").over(Window.partitionBy("tree")).alias("n"))
    found = dealt.join(parts, (F.col("tree") == F.col("p_tree")) & (F.col("part") == F.col("p_part")))
    return found.withColumn("pos", F.col("at") - F.col("first") + F.col("start")).drop("at", "part", "p_tree", "p_part", "first", "start")


def _dealt(nodes: DataFrame, span: int) -> DataFrame:
    """The rows of each subtree together, in the order of their places."""
    return nodes.withColumn("block", F.shiftright("pos", span)).repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")


def _climb(leaves: DataFrame, span: int) -> list[DataFrame]:
    """The tiers: the leaves, the roots of their subtrees, and so on to one node
    per tree (``tree``, ``pos``, ``n``, ``digest``)."""
    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ("tree", "block")):
            n = group.column("n")[0].as_py()
            root = sweep(group.column("digest").to_pylist(), levels_of(n, span))[-1][0]
            yield pa.RecordBatch.from_pydict({
                "tree": [group.column("tree")[0].as_py()], "pos": pa.array([group.column("block")[0].as_py()], pa.int64()),
                "n": pa.array([-(-n >> span) if n > 1 << span else 1], pa.int64()), "digest": [root]})

    tiers = [leaves]
    largest = leaves.agg(F.max("n")).first()[0] or 0
    while True:
        nodes = tiers[-1].select("tree", "pos", "n", "digest")
        tiers.append(written(map_arrow(_dealt(nodes, span), up, "tree string, pos long, n long, digest string"), "merkle-tier"))
        if largest <= 1 << span:
            return tiers
        largest = -(-largest >> span)


def _descend(tiers: list[DataFrame], messages: DataFrame, span: int) -> DataFrame:
    """The rows of the lowest tier with ``proof``, ``subroot`` and ``root``, from
    one message per tree: ``tree``, ``proof``, ``subroot``, ``root``."""
    extra = "proof array<string>, subroot string, root string"
    names = ["proof", "subroot", "root"]
    messages = messages.withColumn("block", F.lit(0).cast("long"))
    for k in range(len(tiers) - 2, -1, -1):
        kept = [f for f in tiers[k].schema.fields if f.name not in ("n", "digest")]
        schema = T.StructType([*kept, *T._parse_datatype_string(extra).fields])

        def down(batches: Iterator[pa.RecordBatch], kept=[f.name for f in kept]) -> Iterator[pa.RecordBatch]:
            for group in _groups(batches, ("tree", "block")):
                # The message of the subtree's root comes before its nodes.
                head, group = group.slice(0, 1), group.slice(1)
                size = group.num_rows
                nodes = sweep(group.column("digest").to_pylist(), levels_of(group.column("n")[0].as_py(), span))
                proofs = sweep_back(nodes, tuple(head.column("proof")[0].as_py()))
                table = group.select(kept)
                table = table.append_column("proof", pa.array([list(p) for p in proofs], pa.list_(pa.string())))
                for c in names[1:]:
                    table = table.append_column(c, pa.array([head.column(c)[0].as_py()] * size, pa.string()))
                yield from table.combine_chunks().to_batches()

        nodes = tiers[k].withColumn("block", F.shiftright("pos", span))
        both = nodes.unionByName(messages.withColumn("pos", F.lit(-1).cast("long")), allowMissingColumns=True)
        dealt = both.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")
        out = map_arrow(dealt, down, schema)
        if k:
            messages = written(out.select("tree", F.col("pos").alias("block"), *names), "merkle-proofs")
    return out


def manifest(rows: DataFrame, tree: Column, order: Sequence[str], leaf: str = "leaf", span: int = SPAN) -> DataFrame:
    """``rows`` (narrow: all columns are sorted and shuffled) with ``subroot``
    (the root of the row's tree), ``root`` (of the tree over all subroots, ordered
    by ``tree``, null first) and ``proof``: one step per level from the leaf to the
    root, ``L`` or ``R`` and the digest of the sibling on that side, or ``=`` where
    the node had none.

    ``leaf`` has the leaf digests, ``tree`` the name of the row's tree, ``order``
    the columns that order a tree's leaves (nulls first; ties by the digest, so
    only equal rows are interchangeable).  An empty table has no rows.
    """
    # Null before every name; the order of the names stays.
    name = F.when(tree.isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), tree.cast("string")))
    packed = rows.select(name.alias("tree"), F.col(leaf).alias("digest"), F.struct(*rows.columns).alias("row"),
                         *(F.col(c).alias(f"o{i}") for i, c in enumerate(order)))
    keys = [*(f"o{i}" for i in range(len(order))), "digest"]
    leaves = written(_placed(written(packed, "merkle-leaves"), keys).drop(*keys[:-1]), "merkle-places")
    tiers = _climb(leaves, span)
    subroots = tiers[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    tops = written(_placed(subroots, ["name"]), "merkle-subroots")
    top_tiers = _climb(tops, span)
    root = top_tiers[-1].select("tree", F.array().cast("array<string>").alias("proof"), F.lit(None).cast("string").alias("subroot"),
                                F.col("digest").alias("root"))
    trees = _descend(top_tiers, root, span).select(F.col("name").alias("tree"), "proof", "root")
    trees = trees.join(tiers[-1].select("tree", F.col("digest").alias("subroot")), "tree")
    messages = written(trees.select("tree", "proof", "subroot", "root"), "merkle-trees")
    done = _descend(tiers, messages, span)
    return done.select(*(F.col("row")[c].alias(c) for c in rows.columns), "subroot", "root", "proof")


def siblings(proof: Column) -> Column:
    """The digests of a proof one after the other."""
    return F.translate(F.array_join(proof, ""), LEFT + RIGHT + ALONE, "")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof give."""
    def step(node: Column, s: Column) -> Column:
        other = F.substring(s, 2, 64)
        both = F.when(F.substring(s, 1, 1) == LEFT, F.concat(other, node)).when(
            F.substring(s, 1, 1) == RIGHT, F.concat(node, other)).otherwise(node)
        return F.sha2(both.cast("binary"), 256)

    return F.aggregate(proof, leaf, step)


def document_leaf(n_chars: Column | None = None) -> Column:
    """The digest of a row of ``documents``; ``n_chars`` replaces that field."""
    return digest(*(field(F.col(c)) for c in ("doc_id", "source", "lang")),
                  field(F.col("n_chars") if n_chars is None else n_chars), field(F.col("text")))


def tamper_check(docs: DataFrame, modulus: int = 7, span: int = SPAN) -> DataFrame:
    """The manifest of ``documents`` by language, and what its proofs say of a
    copy of the table in which ``n_chars`` is one too high in the rows whose
    crc32 of the id's decimal text is divisible by ``modulus``: ``folded_root``
    from the row as it is there, and ``verified``.

    Null fields are part of the digest as ``-``; a null id or a null ``n_chars``
    is never tampered with.  Repeated rows have a leaf and a proof each.
    """
    # As a decimal: the largest long has a successor.
    one_more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == 0) & F.col("n_chars").isNotNull()
    rows = docs.select("doc_id", "lang", document_leaf().alias("leaf"), F.when(hit, document_leaf(one_more)).alias("tampered"))
    proofs = manifest(rows, F.col("lang"), ["doc_id"], span=span)
    fold = folded(F.coalesce("tampered", "leaf"), F.col("proof"))
    out = proofs.select("doc_id", "lang", "leaf", "subroot", "root", "proof", fold.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
