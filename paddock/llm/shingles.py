"""Word shingles of whole texts as sets of 64-bit hashes, vectorised over the bytes of a text.

A word's hash is a polynomial over its bytes (from prefix sums of the whole text), finalised; a
shingle's is a finalised combination of its words' hashes.  No text is looped over word by word.
"""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)                 # odd, so it has an inverse modulo 2**64
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
PLACE = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3,
                  0x589965CC75374CC3], dtype=np.uint64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((BASE, INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def word_hashes(text: str) -> np.ndarray:
    """One hash per word (a run of bytes other than space and 0x09-0x0D), A-Z lower-cased."""
    raw = np.frombuffer(text.encode(), np.uint8)
    if not len(raw):
        return np.empty(0, np.uint64)
    gap = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    low = raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)
    power, inverse = _power(len(raw) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((low.astype(np.uint64) + np.uint64(1)) * power[:len(raw)], dtype=np.uint64)])
    return mix((total[end] - total[start]) * inverse[start])


def shingle_set(text: str, size: int = 5) -> np.ndarray:
    """The distinct shingles of ``size`` words, ascending; with fewer words the whole sequence is one."""
    w = word_hashes(text)
    if not len(w):
        return w
    n = min(size, len(w))
    s = np.full(len(w) - n + 1, np.uint64(n), np.uint64)
    for k in range(n):
        s += w[k:len(w) - n + 1 + k] * PLACE[k % len(PLACE)] + np.uint64(k)
    return np.unique(mix(s))


def fingerprint(shingles: np.ndarray) -> np.int64:
    """64 bits that tell sets apart, whatever their order; 0 for the empty set."""
    if not len(shingles):
        return np.int64(0)
    total = np.sum(mix(shingles ^ BASE), dtype=np.uint64) + np.uint64(len(shingles))
    return mix(np.array([total], np.uint64)).view(np.int64)[0]
