"""Runs of windows that share their smallest gram: the unit that exact substring matching is dealt by.

The anchor of a window is the gram with the smallest hash in it, the leftmost
of equals.  It depends on the window's bytes alone, so equal windows have
equal anchors wherever they stand.  Consecutive windows of a document with
one anchor are a group; groups part the windows of a document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from amihan.llm.shingles import mix

GRAM = 20
POWER = 0x9E3779B97F4A7C15


_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: int) -> np.ndarray:
    """The first powers of a base, cut from one table that grows as needed."""
    if len(_POWERS.get(base, ())) < n:
        out = np.full((n >> 18) + 1 << 18, base, np.uint64)
        out[0] = 1
        _POWERS[base] = np.cumprod(out, out=out)
    return _POWERS[base][:n]


@dataclass(frozen=True)
class Groups:
    """Per group: its document, first window, number of windows, hashes of its anchor and of all its bytes, and the anchor's place in it.

    Beside them hashes of the anchor with what is before and after it, half as
    long as a window has beside its anchor; 0 where the group has less there.
    Every window has one of them whole, so groups that share neither share no
    window.
    """

    doc: np.ndarray
    start: np.ndarray
    windows: np.ndarray
    anchor: np.ndarray
    content: np.ndarray
    place: np.ndarray
    before: np.ndarray
    after: np.ndarray


def window_groups(data: np.ndarray, offsets: np.ndarray, length: int) -> Groups:
    """Groups of all windows of a length in documents lying one after the other; offsets has their borders."""
    n = len(data)
    none = np.empty(0, np.int64)
    if n < length:
        small = np.empty(0, np.uint32)
        return Groups(none, none, none, small, np.empty(0, np.uint64), np.empty(0, np.int32), small, small)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    product = data.astype(np.uint64)
    product += np.uint64(1)
    product *= powers(n, POWER)
    np.cumsum(product, out=sums[1:])
    back = powers(n, pow(POWER, -1, 1 << 64))
    grams = n - GRAM + 1
    packed = product[:grams]
    np.subtract(sums[GRAM:], sums[:grams], out=packed)
    packed *= back[:grams]
    packed ^= packed >> np.uint64(29)
    packed *= np.uint64(0xBF58476D1CE4E5B9)
    packed >>= np.uint64(32)
    packed <<= np.uint64(32)
    packed |= np.arange(grams, dtype=np.uint64)
    span, width = length - GRAM + 1, 1
    least = packed
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    # least[p] is of the window that starts at p; windows reaching into the next document don't count.
    valid = np.ones(len(least), bool)
    for k in range(1, length):
        at = offsets[1:-1] - k
        valid[at[(at >= 0) & (at < len(valid))]] = False
    new = np.empty(len(least), bool)
    new[0] = True
    np.not_equal(least[1:], least[:-1], out=new[1:])
    new[1:] |= valid[1:] & ~valid[:-1]
    new &= valid
    start = np.flatnonzero(new)
    # A group ends before the next group's start or where windows stop being valid.
    stops = np.flatnonzero(valid & ~np.append(valid[1:], False)) + 1
    following = np.append(start[1:], len(least))
    ends = np.minimum(following, stops[np.searchsorted(stops, start, side="right")]) if len(start) else start
    doc = np.searchsorted(offsets, start, side="right") - 1
    anchor = (least[start] >> np.uint64(32)).astype(np.uint32)
    at = (least[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    last = ends + length - 1
    content = mix((sums[last] - sums[start]) * back[start] + (ends - start).astype(np.uint64))
    half = (length - GRAM + 1) // 2

    def side(begin: np.ndarray, there: np.ndarray) -> np.ndarray:
        begin = np.where(there, begin, start)
        found = mix((sums[begin + half + GRAM] - sums[begin]) * back[begin]) >> np.uint64(32)
        return np.where(there, np.maximum(found, 1), 0).astype(np.uint32)

    before, after = side(at - half, at - half >= start), side(at, at + GRAM + half <= last)
    return Groups(doc, start, ends - start, anchor, content, (at - start).astype(np.int32), before, after)
