"""Quality rules: repetition inside a document by suffix arrays over its words.

The alphabet are the words; of a word of over ``LONG_WORD`` code points (a text
without spaces) each code point is a unit of its own, so repeats inside it count.
All suffixes of all documents of a step are sorted at once by prefix doubling
(the document is part of the first key, so texts never match each other).
Only suffixes that still share their class go on to the next doubling.  The
classes of the doublings also give the longest common prefix of neighbours in
the sorted order.  The intervals of these prefixes whose members are not all
preceded by the same unit are the maximal repeated substrings, each with its
number of occurrences.  The union of the spans of those of at least
``repeat_words`` units is the part of the text that occurs more than once.

A document fails if it has few words, if words in repeated 3-word windows are
more than half (the base rules), if more than ``max_covered`` of its word
characters are covered, or if its longest repeat is over ``max_longest`` units.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import SPACE_CHARS, map_arrow, steps, text_col
from tickweave.llm.pieces import distinct, words

#: Fixed value: the symbols that are counted.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A repeat of this many words or more counts as covered text.
REPEAT_WORDS = 8
#: Most of the word characters that repeats may cover: the published limit on duplicate lines and paragraphs.
MAX_COVERED = 0.3
MAX_LONGEST = 50
#: Code points of a word from which on it is taken apart.
LONG_WORD = 64
RESULT = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "covered_chars long, longest_repeat long, spans array<struct<start:long,end:long>>, "
          "repeats array<struct<start:long,end:long,count:long>>, base_failed boolean, kept boolean")


def common_prefixes(word: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places in the order of their suffixes, and the longest common prefix of
    each with the next.  ``doc`` ascends; a suffix ends with its document."""
    n = len(word)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.searchsorted(doc, doc, "right")  # the end of the place's document
    order = np.lexsort((word, doc))
    rank, levels, h = np.zeros(n, np.int64), [], 0
    active = order  # places whose class has several members, in sorted order
    same = np.zeros(n, bool)
    same[1:] = (word[order][1:] == word[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    heads = np.flatnonzero(~same)
    rank[order] = np.repeat(heads, np.diff(np.append(heads, n)))
    while True:
        levels.append(rank.copy())
        h = 2 * h or 1
        size = np.bincount(rank[active], minlength=n)
        active = active[size[rank[active]] > 1]
        if not len(active):
            break
        # The next h words, none (0) after the end of the document.
        after = active + h
        key = np.where(after < ends[active], rank[np.minimum(after, n - 1)] + 1, 0)
        base = rank[active]
        by = np.lexsort((key, base))
        active, key, base = active[by], key[by], base[by]
        fresh = np.ones(len(active), bool)
        fresh[1:] = base[1:] != base[:-1]
        member = np.arange(len(active)) - np.maximum.accumulate(np.where(fresh, np.arange(len(active)), 0))
        fresh[1:] |= key[1:] != key[:-1]
        rank[active] = base + np.maximum.accumulate(np.where(fresh, np.arange(len(active)), 0)) - (np.arange(len(active)) - member)
    # Common prefixes of neighbours: the largest doubling at which both are in a class, then the rest after it.
    sorted_places = np.empty(n, np.int64)
    sorted_places[rank] = np.arange(n)
    left, right = sorted_places[:-1].copy(), sorted_places[1:].copy()
    common = np.zeros(n - 1, np.int64)
    where = np.flatnonzero(levels[0][left] == levels[0][right])
    for k in range(len(levels) - 1, -1, -1):
        step = 1 << k
        able = where[np.maximum(left[where], right[where]) + step <= ends[sorted_places[where]]]
        hit = able[levels[k][left[able]] == levels[k][right[able]]]
        common[hit] += step
        left[hit] += step
        right[hit] += step
        where = where[np.maximum(left[where], right[where]) < ends[sorted_places[where]]]
    return sorted_places, common


def longest_repeats(places: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For each place the number of units from there on that also occur at
    another place of the same document: the deepest interval that holds it."""
    out = np.zeros(len(places), np.int64)
    out[places[:-1]] = common
    out[places[1:]] = np.maximum(out[places[1:]], common)
    return out


def maximal_repeats(word: np.ndarray, doc: np.ndarray, places: np.ndarray, common: np.ndarray, least: int) -> np.ndarray:
    """The maximal repeated substrings of at least ``least`` units, a row each: the
    place of one occurrence, the length, and the number of occurrences."""
    at = np.flatnonzero(common >= least)
    # How often the unit before changes along the order; the begin of a document differs from all.
    begins = np.diff(doc, prepend=-1) != 0
    before = np.where(begins, -1, np.concatenate([[0], word[:-1]])) if len(word) else word
    changes = np.cumsum((before[places] != before[np.roll(places, 1)]) | begins[places]) if len(word) else word
    found: list[tuple[int, int, int]] = []
    stack: list[tuple[int, int]] = []  # the open intervals: prefix, first member
    last = -2

    def close(above: int, right: int, left: int) -> int:
        while stack and stack[-1][0] > above:
            length, left = stack.pop()
            if changes[right] > changes[left]:
                found.append((int(places[left]), length, right - left + 1))
        return left

    for k, length in zip(at.tolist(), common[at].tolist()):
        if k != last + 1:
            close(0, last + 1, 0)
        left = close(length, k, k)
        if not stack or stack[-1][0] < length:
            stack.append((length, left))
        last = k
    close(0, last + 1, 0)
    return np.array(found, np.int64).reshape(-1, 3)


def repeated_windows(word: np.ndarray, doc: np.ndarray, size: int = 3) -> np.ndarray:
    """Which places begin a run of ``size`` words that the document has again."""
    n = len(word) - size + 1
    out = np.zeros(len(word), bool)
    if n < 1:
        return out
    value = doc[:n]
    for k in range(size):
        value = np.unique(value * (int(word.max()) + 1) + word[k: k + n], return_inverse=True)[1].astype(np.int64)
    whole = doc[:n] == doc[size - 1:]
    out[:n] = whole & (np.bincount(value[whole], minlength=int(value.max()) + 1)[value] > 1)
    return out


def covered(length: np.ndarray) -> np.ndarray:
    """Which places lie in a span of ``length`` places from a place on."""
    n = len(length)
    change = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(length)
    np.add.at(change, at, 1)
    np.add.at(change, at + length[at], -1)
    return np.cumsum(change[:n]) > 0


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(np.int64)


def dup_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(SPACE_CHARS)]
    return len(lines) - len(set(lines))


def measures(texts: list[str], repeat_words: int = REPEAT_WORDS) -> dict[str, list | np.ndarray]:
    """The counts of each text; see ``repetition``."""
    joined, code, starts, stops, offsets, edges = words(texts)
    index = distinct(joined, code, starts, stops)[1].astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
    size = stops - starts
    # Units: words, and the code points of long words.
    n_units = np.where(size > LONG_WORD, size, 1)
    long = (n_units > 1).any()
    unit, u_doc, u_starts, u_stops = index, doc, starts, stops
    if long:
        inner = np.arange(n_units.sum()) - np.repeat(np.cumsum(n_units) - n_units, n_units)
        apart = np.repeat(n_units > 1, n_units)
        u_doc, u_starts = np.repeat(doc, n_units), np.repeat(starts, n_units) + inner
        u_stops = np.where(apart, u_starts + 1, np.repeat(stops, n_units))
        unit = np.where(apart, len(index) + code[np.minimum(u_starts, len(code) - 1)].astype(np.int64), np.repeat(index, n_units))
    places, common = common_prefixes(unit, u_doc)
    repeat = longest_repeats(places, common)
    u_size = u_stops - u_starts
    in_window = covered(np.where(repeated_windows(index, doc) if long else repeat >= 3, 3, 0))
    in_repeat = covered(np.where(repeat >= repeat_words, repeat, 0))
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, u_doc, repeat)
    repeats: list[list[dict]] = [[] for _ in texts]
    for p, length, times in maximal_repeats(unit, u_doc, places, common, repeat_words).tolist():
        d = int(u_doc[p])
        repeats[d].append({"start": int(u_starts[p] - edges[d]), "end": int(u_stops[p + length - 1] - edges[d]), "count": times})
    u_offsets = np.searchsorted(u_doc, np.arange(len(texts) + 1))
    symbol = np.zeros(128, bool)
    symbol[[ord(c) for c in SYMBOLS]] = True
    spans: list[list[dict]] = [[] for _ in texts]
    head = in_repeat & ~(np.concatenate([[False], in_repeat[:-1]]) & (np.diff(u_doc, prepend=-1) == 0))
    tail = in_repeat & ~(np.concatenate([in_repeat[1:], [False]]) & (np.diff(u_doc, append=-1) == 0))
    for d, a, b in zip(u_doc[head].tolist(), u_starts[head].tolist(), u_stops[tail].tolist()):
        spans[d].append({"start": a - int(edges[d]), "end": b - int(edges[d])})
    return {"n_words": np.diff(offsets), "word_chars": _sums(size, offsets),
            "n_symbols": _sums(symbol[np.minimum(code, 127)], edges), "n_dup_lines": [dup_lines(t) for t in texts],
            "n_repeat_words": _sums(in_window, offsets), "covered_chars": _sums(np.where(in_repeat, u_size, 0), u_offsets),
            "longest_repeat": longest, "spans": spans, "repeats": repeats}


def verdicts(m: dict, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT,
             max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> tuple[np.ndarray, np.ndarray]:
    """Which texts fail the base rules, and which pass these and the limits on repeats."""
    failed = (m["n_words"] < min_words) | (100 * m["n_repeat_words"] > max_repeat_percent * m["n_words"])
    return failed, ~failed & (m["covered_chars"] <= max_covered * m["word_chars"]) & (m["longest_repeat"] <= max_longest)


def repetition(docs: DataFrame, repeat_words: int = REPEAT_WORDS, doc_id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """The measures of every document, ``base_failed`` and ``kept`` (``limits``: see
    ``verdicts``); ``spans`` is the covered part, ``repeats`` has the maximal
    repeated substrings with one occurrence and their count.  One row per row of
    ``docs``; a text without words (null, empty) fails the base rules."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_col(text).alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = [("start", pa.int64()), ("end", pa.int64())]
        kinds = {"spans": pa.list_(pa.struct(span)), "repeats": pa.list_(pa.struct([*span, ("count", pa.int64())]))}
        for batch, texts in steps(batches):
            m = measures(texts, repeat_words)
            failed, kept = verdicts(m, **limits)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id")} | {
                k: pa.array(v, kinds.get(k, pa.int64())) for k, v in m.items()} | {"base_failed": pa.array(failed), "kept": pa.array(kept)})

    return map_arrow(rows, measure, RESULT)


def drop_repetitive(docs: DataFrame, repeat_words: int = REPEAT_WORDS, **limits) -> DataFrame:
    """The documents (text in column ``text``) that ``repetition`` keeps, with all
    their columns; no shuffle."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in steps(batches):
            yield batch.filter(pa.array(verdicts(measures(texts, repeat_words), **limits)[1]))

    return map_arrow(docs, keep, docs.schema)
