"""Perfect binary Golay code: index keys shared by nearby 23-bit words.

Every 23-bit word lies within three bits of one codeword. The keys of a word are
the 12-bit indices of the codewords nearest to the word and to its one-bit
neighbours: one key if the word is within two bits of its codeword, else six.
Two words that differ in at most two bits have a common one-bit neighbour (or
are neighbours), so they share a key.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

LENGTH, DATA = 23, 12
CHECKS = LENGTH - DATA
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1


def _remainders() -> np.ndarray:
    """Remainder modulo the generator of each power x^0 .. x^22."""
    out, value = [], 1
    for _ in range(LENGTH):
        out.append(value)
        value <<= 1
        if value >> CHECKS:
            value ^= GENERATOR
    return np.array(out, np.int64)


def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and high 11 bits, and the error of a syndrome."""
    powers = _remainders()
    low, high = np.zeros(1 << DATA, np.int64), np.zeros(1 << CHECKS, np.int64)
    for bit in range(DATA):
        low[np.arange(1 << DATA) >> bit & 1 == 1] ^= powers[bit]
    for bit in range(CHECKS):
        high[np.arange(1 << CHECKS) >> bit & 1 == 1] ^= powers[DATA + bit]
    errors = np.zeros(1 << CHECKS, np.int64)
    for weight in (1, 2, 3):
        for places in combinations(range(LENGTH), weight):
            syndrome = int(np.bitwise_xor.reduce(powers[list(places)]))
            errors[syndrome] = sum(1 << p for p in places)
    return low, high, errors


def decode(words: np.ndarray, parts) -> np.ndarray:
    """Index (its 12 leading bits) of the codeword nearest to each word."""
    low, high, errors = parts
    syndrome = low[words & ((1 << DATA) - 1)] ^ high[words >> DATA]
    return (words ^ errors[syndrome]) >> CHECKS


def keys(words: np.ndarray, parts, width: int = LENGTH) -> np.ndarray:
    """One row of width + 1 indices per word; a repeat in a row is -1.

    Words shorter than 23 bits are padded with zeros, which are never flipped.
    """
    flips = np.concatenate([[0], 1 << np.arange(width)])
    found = np.sort(decode(words[:, None] ^ flips[None, :], parts), axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    return found
