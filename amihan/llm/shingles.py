"""Sets of word shingles as sorted 64-bit hashes, computed on bytes by whole-array steps."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

WORDS = 5
SEGMENT = 1 << 20
#: Odd multipliers; the bytes that part words.
POWER, JOIN = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Lower case for A to Z, a space for every byte that parts words.
FOLD = bytes(0x20 if b in SPACES else b + 32 if 65 <= b <= 90 else b for b in range(256))


@lru_cache(maxsize=2)
def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def _hash_words(part: bytes) -> np.ndarray:
    data = np.frombuffer(part, np.uint8)
    n = len(data)
    word = np.empty(n + 2, bool)
    word[0] = word[-1] = False
    np.not_equal(data, 0x20, out=word[1:-1])
    edges = np.flatnonzero(word[1:] != word[:-1])
    begins, ends = edges[::2], edges[1::2]
    room = 1 << max(10, n.bit_length())
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(room, POWER)[:n], out=sums[1:])
    back = _powers(room, pow(POWER, -1, 1 << 64))
    return mix((sums[ends] - sums[begins]) * back[begins])


def word_hashes(text: bytes) -> np.ndarray:
    """A hash of each word; long texts go by in segments that end between words."""
    text = text.translate(FOLD)
    if len(text) <= SEGMENT:
        return _hash_words(text) if text else np.empty(0, np.uint64)
    parts, at = [], 0
    while at < len(text):
        cut = min(len(text), at + SEGMENT)
        if cut < len(text):
            cut = text.rfind(b" ", at + 1, cut)
            cut = text.find(b" ", at + SEGMENT) if cut < 0 else cut
            cut = len(text) if cut < 0 else cut
        parts.append(_hash_words(text[at:cut]))
        at = cut
    return np.concatenate(parts)


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of all runs of five words; of fewer words the whole run; of none nothing."""
    words = word_hashes(text)
    n = len(words)
    if not n:
        return words
    size = min(n, WORDS)
    joined = words[: n - size + 1].copy()
    for k in range(1, size):
        joined *= JOIN
        joined += words[k : n - size + 1 + k]
    if n < WORDS:
        joined += np.uint64(n)
    return np.unique(mix(joined))
