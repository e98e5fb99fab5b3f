"""The perfect binary Golay code (23, 12, 7) as a fuzzy hash of 23 bits.

Every word of 23 bits lies within 3 bits of exactly one of the 4,096 codewords.
The keys of a word are the codewords that it or one of its one-bit neighbours
decodes to: one key if the word is within 2 bits of its codeword, else six.
Words that differ in at most two bits share a key, because both are neighbours
of (or equal to) a word between them.
"""

from __future__ import annotations

import functools
from itertools import combinations

import numpy as np

BITS = 23
#: Fixed value: the generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011


@functools.lru_cache(1)
def decode_table() -> np.ndarray:
    """The index (0 to 4095) of the codeword nearest to each word."""
    index = np.arange(4096, dtype=np.int64)
    rest = index << 11
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << bit - 11), rest)
    codewords = index << 11 | rest
    errors = np.array([sum(1 << b for b in bits) for k in range(4) for bits in combinations(range(BITS), k)])
    table = np.zeros(1 << BITS, np.int16)
    for error in errors:
        table[codewords ^ error] = index
    return table


def fuzzy_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word its codeword indices: an array (words, 24) in ascending order
    and a mask of the entries that are not repetitions."""
    table = decode_table()
    flips = np.concatenate([[0], 1 << np.arange(BITS)])
    keys = np.sort(table[words[:, None] ^ flips], axis=1).astype(np.int64)
    fresh = np.ones(keys.shape, bool)
    fresh[:, 1:] = keys[:, 1:] != keys[:, :-1]
    return keys, fresh
