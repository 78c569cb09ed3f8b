"""The perfect binary Golay code (23, 12, 7) over numpy arrays."""

from __future__ import annotations

import itertools

import numpy as np

LENGTH, DATA = 23, 12
#: Fixed value: generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
#: Most codewords near one word: one at distance 3, and five at distance 4.
NEARBY = 6


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, LENGTH - DATA - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - (LENGTH - DATA))
    return word


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of each half word, and per syndrome the patterns that lead to nearby codewords."""
    ones = [_remainder(1 << bit) for bit in range(LENGTH)]

    def syndromes(bits: list[int]) -> np.ndarray:
        out = np.zeros(1, np.int64)
        for one in bits:
            out = np.concatenate([out, out ^ one])
        return out

    patterns: dict[int, list[int]] = {}
    for weight in range(5):
        for bits in itertools.combinations(range(LENGTH), weight):
            syndrome = 0
            for bit in bits:
                syndrome ^= ones[bit]
            known = patterns.setdefault(syndrome, [])
            # A word within 2 of a codeword has neighbours that all decode to it as well.
            if weight < 4 or (known and known[0].bit_count() == 3):
                known.append(sum(1 << bit for bit in bits))
    near = np.array([(p := patterns[s]) + [-1] * (NEARBY - len(p)) for s in range(1 << (LENGTH - DATA))])
    return syndromes(ones[:12]), syndromes(ones[12:]), near


LOW, HIGH, PATTERNS = _tables()


def nearby_indices(words: np.ndarray) -> np.ndarray:
    """Per 23-bit word the 12-bit indices of its nearby codewords, padded with -1 to six columns.

    The first is the codeword it decodes to. A word three errors away from that one has the five at
    distance four as well. Words that differ in at most one bit always share an index.
    """
    words = words.astype(np.int64)
    patterns = PATTERNS[LOW[words & 0xFFF] ^ HIGH[words >> 12]]
    return np.where(patterns < 0, -1, (words[:, None] ^ patterns) >> (LENGTH - DATA))
