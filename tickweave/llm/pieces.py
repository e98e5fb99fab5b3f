"""Pre-tokens of byte-level BPE vocabularies, cut and numbered with numpy.

``cut`` finds the pieces that the pre-token pattern of the vocabularies
(``public_tokenizers.PATTERN``) matches, one after the other: contractions,
runs of letters, numbers or other characters with one space before them, and
white space.  It works on whole arrays of code points instead of a regular
expression.  ``number`` gives each distinct piece of a step a number, so that
a piece is encoded once and its ids are copied to all its places.
"""

from __future__ import annotations

import base64
import functools
import itertools
import re

import numpy as np
import pyarrow as pa

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))  # odd multipliers
#: Pieces whose ids a worker process keeps; beyond it the store starts anew.
KEPT_PIECES = 400_000


@functools.lru_cache(1)
def char_kinds() -> np.ndarray:
    """The kind of every code point."""
    import regex

    kinds = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            kinds[ord(m[0][0]): ord(m[0][-1]) + 1] = kind
    return kinds


def cut(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """The joined text, its code points, the starts of all pieces, and for each
    text the number of its first piece (one more entry at the end)."""
    joined = "".join(texts)
    code = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    n = len(code)
    edges = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=edges[1:])
    if not n:
        return joined, code, np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    kind = char_kinds()[code]
    mark = np.ones(n + 1, bool)
    np.not_equal(kind[1:], kind[:-1], out=mark[1:n])
    mark[edges] = True
    last_of_text = np.zeros(n + 1, bool)
    last_of_text[edges] = True
    begin = np.flatnonzero(mark[:n])
    end = np.append(begin[1:], n)
    run = kind[begin]
    # The last white space before other characters is a piece of its own, or goes with them if it is a space.
    inner = (run == SPACE) & ~last_of_text[end]
    at = end[inner]
    mark[at - 1] = True
    mark[at[code[at - 1] == 0x20]] = False
    # A lone apostrophe that begins a piece takes the letters of a contraction.
    lone = np.flatnonzero((run == OTHER) & (end - begin == 1) & (code[begin] == 0x27) & mark[begin] & ~last_of_text[end])
    if len(lone):
        lone = lone[run[lone + 1] == LETTER]
        at, stop = begin[lone + 1], end[lone + 1]
        one = code[at]
        two = np.where(at + 1 < stop, code[np.minimum(at + 1, n - 1)], 0)
        take = np.isin(one, [ord(c) for c in "stmd"]).astype(np.int64)
        for a, b in ("re", "ve", "ll"):
            take[(one == ord(a)) & (two == ord(b))] = 2
        at, stop, take = at[take > 0], stop[take > 0], take[take > 0]
        mark[at] = False
        mark[at + take] = True
    starts = np.flatnonzero(mark[:n])
    return joined, code, starts, np.searchsorted(starts, edges)


@functools.lru_cache(4)
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.cumprod(np.full(length, m, np.uint64)) for m in (np.uint64(0x100000001B3), np.uint64(0xD6E8FEB86659FD93)))


def span_hashes(code: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each span; spans ascend and don't overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    begin, n = starts[0], len(code)
    size = np.diff(np.append(starts, n))
    place = np.arange(n - begin) - np.repeat(starts - begin, size)
    value = code[begin:].astype(np.uint64) + np.uint64(1)
    longest = int((stops - starts).max())
    if not np.array_equal(stops[:-1], starts[1:]) or stops[-1] != n:
        value[place >= np.repeat(stops - starts, size)] = 0
        place = np.minimum(place, longest - 1)
    hashes = []
    for mix, power in zip(_MIX, _powers(1 << (longest - 1).bit_length())):
        v = value * mix
        v ^= v >> np.uint64(31)
        v *= power[place]
        hashes.append(np.add.reduceat(v, starts - begin))
    return hashes[0], hashes[1]


def distinct(joined: str, code: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The distinct strings among the spans of a text, and the number of each span.

    Strings are told apart by two 64-bit hashes; if two share the first but not
    the second, the spans are compared as strings instead.
    """
    if not len(starts):
        return [], np.zeros(0, np.int64)
    one, two = span_hashes(code, starts, stops)
    # Numbered by hashing in the order of first occurrence, which needs no sort.
    index = pa.array(one).dictionary_encode().indices.to_numpy()
    first = np.empty(int(index.max()) + 1, np.int64)
    first[index[::-1]] = np.arange(len(index) - 1, -1, -1)
    if not np.array_equal(two[first][index], two):
        numbers: dict[str, int] = {}
        index = np.array([numbers.setdefault(joined[a:b], len(numbers)) for a, b in zip(starts, stops)])
        return list(numbers), index
    return [joined[a:b] for a, b in zip(starts[first].tolist(), stops[first].tolist())], index


def number(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct pieces of some texts, the number of each piece in order, and
    the offsets of the texts in those numbers."""
    joined, code, starts, offsets = cut(texts)
    return *distinct(joined, code, starts, np.append(starts[1:], len(code))[:len(starts)]), offsets


def words(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The joined text, its code points, the starts and stops of its words (runs
    without white space of SPACE_CHARS), for each text the number of its first
    word (one more entry at the end), and the edges of the texts."""
    joined = "".join(texts)
    code = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    edges = text_edges(texts)
    starts, stops = runs(~((code == 0x20) | (code >= 9) & (code <= 13)), edges)
    return joined, code, starts, stops, np.searchsorted(starts, edges), edges


def text_edges(texts: list[str]) -> np.ndarray:
    """Where each text begins in the joined text, and where the last one ends."""
    return np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def runs(inside: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the longest runs of marked characters within a text."""
    wide = np.concatenate([[False], inside, [False]])
    first, last = inside & ~wide[:-2], inside & ~wide[2:]
    cut_at = edges[(edges > 0) & (edges < len(inside))]
    first[cut_at] |= inside[cut_at]
    last[cut_at - 1] |= inside[cut_at - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def spread(index: np.ndarray, flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all pieces in order, and how many each piece has, from the ids
    of the distinct pieces one after the other."""
    begin = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=begin[1:])
    count = lengths[index]
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    places = np.repeat(begin[:-1][index] - (ends - count), count) + np.arange(total)
    return flat[places], count


class PieceEncoder:
    """Ids of single pieces by one vocabulary; keeps up to KEPT_PIECES of them.
    Strings of ``added`` tokens in a text have their own ids, and the parts of
    the text around them are cut like texts of their own."""

    def __init__(self, encode, added: dict[str, int] | None = None):
        self._encode, self._kept, self._added = encode, {}, added or {}
        # The longest of those that begin at a place, as the library does.
        longest_first = sorted(self._added, key=len, reverse=True)
        self._split = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")").split

    def raw(self, word: bytes):
        """The ids of one piece, not kept."""
        return self._encode(word.decode())

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the number of ids of each word."""
        kept, encode = self._kept, self._encode
        out = list(map(kept.get, words))
        for i, ids in enumerate(out):
            if ids is None:
                out[i] = encode(words[i])
        if len(kept) + len(words) > KEPT_PIECES:
            kept.clear()
        kept.update(zip(words, out))
        lengths = np.fromiter(map(len, out), np.int64, len(out))
        return np.fromiter(itertools.chain.from_iterable(out), np.uint32, int(lengths.sum())), lengths

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and the offsets of the texts."""
        if not any(token in t for token in self._added for t in texts):
            return self._plain(texts)
        parts, behind, first = [], [], [0]  # the plain parts, the added token behind each (or -1), each text's first part
        for t in texts:
            cut_up = self._split(t)
            parts += cut_up[::2]
            behind += [self._added[token] for token in cut_up[1::2]] + [-1]
            first.append(len(parts))
        ids, offsets = self._plain(parts)
        tokens = np.array(behind, np.int64)
        at = np.flatnonzero(tokens >= 0)
        ids = np.insert(ids, offsets[at + 1], tokens[at].astype(np.uint32))
        return ids, (offsets + np.concatenate([[0], np.cumsum(tokens >= 0)]))[first]

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words, index, offsets = number(texts)
        ids, count = spread(index, *self(words))
        ends = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
        return ids, ends[offsets]


@functools.lru_cache(1)
def byte_chars() -> dict[int, int]:
    """The printable character that stands for each byte in a byte-level
    vocabulary: itself if visible in Latin-1, else the next from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = (b for b in range(256) if b not in visible)
    return {b: b for b in visible} | {b: 256 + k for k, b in enumerate(hidden)}


@functools.lru_cache(2)
def json_encoder(path: str) -> PieceEncoder:
    """By a file of the tokenizers library, with its added tokens."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    model, chars = tokenizer.model, byte_chars()
    added = {}
    for token_id, token in tokenizer.get_added_tokens_decoder().items():
        if token.single_word or token.lstrip or token.rstrip or token.normalized:
            raise ValueError(f"added token {token.content!r} is not matched as it stands")
        added[token.content] = token_id
    tokenize = model.tokenize

    def ids(piece: str) -> list[int]:
        # An ASCII character is its own byte.
        text = piece if piece.isascii() else piece.encode().decode("latin-1")
        return [t.id for t in tokenize(text.translate(chars))]

    return PieceEncoder(ids, added)


def rank_table(path: str) -> dict[bytes, int]:
    """The token bytes and ids of a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@functools.lru_cache(2)
def rank_encoder(path: str, pattern: str) -> PieceEncoder:
    """By a rank file of the tiktoken library, without special tokens."""
    import tiktoken

    encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=rank_table(path), special_tokens={})
    single = encoding._core_bpe.encode_single_piece
    return PieceEncoder(lambda piece: single(piece.encode()))
