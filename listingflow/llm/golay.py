"""Nearby codewords of the binary Golay code of length 23.

A 23-bit word, extended by a parity bit, lies at distance 0 or 2 from one codeword of the extended code, or at
distance 4 from six. The numbers of these codewords are the keys of the word. Two words that differ in at most two
bits share a key: extended, they differ in no or two bits, and moving a word by two bits leaves one of its
codewords within distance 4.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

LENGTH, CHECKS = 23, 11
# Generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 of the code (fixed value).
_GENERATOR = 0b101011100011
MAX_KEYS = 6


@cache
def _syndromes() -> tuple[np.ndarray, ...]:
    """Syndromes of all values of each byte of a word."""
    single = []
    for bit in range(LENGTH):
        rest = 1 << bit
        for high in range(LENGTH - 1, CHECKS - 1, -1):
            if rest >> high & 1:
                rest ^= _GENERATOR << (high - CHECKS)
        single.append(rest)
    tables = []
    for first in range(0, 24, 8):
        table = np.zeros(256, dtype=np.int64)
        for value in range(256):
            for j in range(8):
                if value >> j & 1 and first + j < LENGTH:
                    table[value] ^= single[first + j]
        tables.append(table)
    return tuple(tables)


def syndrome(words: np.ndarray) -> np.ndarray:
    a, b, c = _syndromes()
    return a[words & 255] ^ b[words >> 8 & 255] ^ c[words >> 16 & 255]


@cache
def _errors() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the error patterns of the nearest extended codewords, and how many there are."""
    flips = [sum(1 << i for i in at) for n in range(5) for at in combinations(range(LENGTH), n)]
    patterns = np.array(flips, dtype=np.int64)
    weight = np.bitwise_count(patterns).astype(np.int64)
    weight += weight & 1  # with the parity bit
    found = syndrome(patterns)
    errors, n = np.zeros((1 << CHECKS, MAX_KEYS), dtype=np.int64), np.zeros(1 << CHECKS, dtype=np.int64)
    for s in range(1 << CHECKS):
        here = found == s
        nearest = patterns[here][weight[here] == weight[here].min()]
        errors[s, : len(nearest)], n[s] = nearest, len(nearest)
    return errors, n


def keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): the 12-bit numbers of the codewords near each word of 23 bits, and the word each is of."""
    errors, n = _errors()
    s = syndrome(words)
    row, slot = np.nonzero(np.arange(MAX_KEYS) < n[s][:, None])
    return row, (words[row] ^ errors[s[row], slot]) >> CHECKS
