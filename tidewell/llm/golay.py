"""The binary Golay code of length 23: 4096 codewords, any word within 3 bits of exactly one."""

from __future__ import annotations

import functools
from itertools import combinations

import numpy as np

LENGTH, CHECKS = 23, 11
#: Fixed value: the generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101


def _syndrome(word: int) -> int:
    """Remainder of the word by the generator."""
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECKS)
    return word


@functools.lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the words' low 12 and high 11 bits, and each syndrome's errors.

    The errors are those patterns of up to 4 bits that lead from a word of the syndrome to a
    codeword: the one of up to 3 bits first, then those of 4 bits (five, if the first has 3
    bits, else none); missing ones are -1.
    """
    single = [_syndrome(1 << b) for b in range(LENGTH)]

    def of(words: int, shift: int) -> np.ndarray:
        out = np.zeros(words, np.int32)
        for b in range(words.bit_length() - 1):
            out[np.arange(words) >> b & 1 == 1] ^= single[b + shift]
        return out

    errors = np.full((1 << CHECKS, 6), -1, np.int32)
    filled = np.zeros(1 << CHECKS, np.int64)
    for weight in range(5):
        for bits in combinations(range(LENGTH), weight):
            s = 0
            for b in bits:
                s ^= single[b]
            errors[s, filled[s]] = sum(1 << b for b in bits)
            filled[s] += 1
    return of(1 << 12, 0), of(1 << 11, 12), errors


def near_codewords(words: np.ndarray) -> np.ndarray:
    """Indices (0 to 4095) of the codewords within 4 bits of each 23-bit word, the nearest first.

    Two words that differ in at most one bit share a codeword: the nearest of one is always
    among the near ones of the other, since it lies within 3 bits of the first and so within 4
    of the second. Missing ones are -1.
    """
    low, high, errors = tables()
    words = np.asarray(words, np.int64)
    error = errors[low[words & 0xFFF] ^ high[words >> 12]]
    return np.where(error >= 0, (words[:, None] ^ error) >> CHECKS, -1)
