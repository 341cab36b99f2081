"""A run-length index of a repetitive text: compressed Burrows-Wheeler transform with sampled run ends.

Of the transform only runs of equal symbols are kept: where each begins, its
symbol, and the text positions of its first and last row.  Patterns are read
from the right; while the symbol before the match goes on, a row steps to the
row of the longer match inside its run.  Where it doesn't, the nearest run of
the wanted symbol above or below is entered at its sampled end, whichever
shares more text with the match.  That yields the matching statistics: at
each position of a pattern the length of the longest match starting there.

All patterns step together, as arrays.
"""

from __future__ import annotations

import numpy as np


def packed(text: np.ndarray) -> tuple[np.ndarray, int, int]:
    """As many symbols from each position on as a word of 63 bits holds, zeros after the end; with that number and a symbol's bits."""
    n = len(text)
    bits = max(1, int(text.max(initial=0)).bit_length())
    known = max(1, 63 // bits)
    key = np.zeros(n, np.uint64)
    for k in range(known):
        key <<= np.uint64(bits)
        if k < n:
            key[: n - k] |= text[k:].astype(np.uint64)
    return key, known, bits


def suffix_order(key: np.ndarray, known: int) -> np.ndarray:
    """Positions in the order of the suffixes; key holds the first ``known`` symbols of each.

    A rank is the first place of suffixes that are equal so far, so it stays as
    those are told apart by more symbols.  All must be: where two were in
    either order, a row would step to the place of another text position.
    """
    n = len(key)
    order = np.argsort(key)
    new = np.empty(n, bool)
    new[0] = True
    ranked = key[order]
    np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
    del ranked
    rank = np.zeros(n, np.uint32)
    while True:
        first = np.flatnonzero(new)
        rank[order] = np.repeat(first, np.diff(np.append(first, n)))
        tied = np.flatnonzero(~(new & np.append(new[1:], True)))
        if not len(tied):
            break
        at = order[tied]
        pair = rank[at].astype(np.uint64) << np.uint64(32)
        inside = at + known < n
        # One that has ended comes before those that go on with zeros.
        pair[~inside] |= (n - at[~inside]).astype(np.uint64)
        pair[inside] |= rank[at[inside] + known] + np.uint64(known + 1)
        by = np.argsort(pair)
        pair = pair[by]
        order[tied] = at[by]
        new[tied[1:]] |= pair[1:] != pair[:-1]
        known *= 2
    return order


def dense_symbols(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct symbols, and the place of each position's symbol among them; a table does it where symbols are small."""
    most = int(text.max(initial=0))
    if most > 4 * len(text):
        symbols, dense = np.unique(text, return_inverse=True)
        return symbols, dense.astype(np.int32)
    there = np.zeros(most + 1, bool)
    there[text] = True
    return np.flatnonzero(there), (np.cumsum(there, dtype=np.int32) - 1)[text]


class RunIndex:
    def __init__(self, text: np.ndarray) -> None:
        self.symbols, self.text = dense_symbols(text)
        self.n = len(text)
        self.packed, self.known, self.bits = packed(self.text)
        order = suffix_order(self.packed, self.known)
        before = self.text[order - 1]
        begins = np.flatnonzero(np.concatenate(([True], before[1:] != before[:-1])))
        self.begins, self.heads = begins, before[begins].astype(np.int64)
        lengths = np.diff(np.append(begins, self.n))
        self.first_at, self.last_at = order[begins], order[begins + lengths - 1]
        self.last_row = begins + lengths - 1
        # Sorted by symbol and place, the rows before a run are the row that its first row steps to.
        by_symbol = np.lexsort((begins, self.heads))
        self.by_symbol = by_symbol
        self.keys = self.heads[by_symbol] * self.n + begins[by_symbol]
        self.steps_to = np.empty(len(begins), np.int64)
        self.steps_to[by_symbol] = np.cumsum(lengths[by_symbol]) - lengths[by_symbol]

    def _shared(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Lengths of the common beginnings of the text at two places, up to a limit."""
        out = np.zeros(len(a), np.int64)
        limit = np.minimum(limit, self.n - np.maximum(a, b))
        alive = np.flatnonzero(limit > 0)
        x, y = a[alive], b[alive]
        while len(alive):
            differ = self.packed[x] ^ self.packed[y]
            # Without the bit below the first that differs, rounding can't reach the next power of two.
            first = np.frexp((differ & ~(differ >> np.uint64(1))).astype(np.float64))[1] - 1
            out[alive] += np.where(differ == 0, self.known, self.known - 1 - first // self.bits)
            on = (differ == 0) & (out[alive] < limit[alive])
            alive, x, y = alive[on], x[on] + self.known, y[on] + self.known
        return np.minimum(out, np.maximum(limit, 0))

    def matching_statistics(self, patterns: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """For rows of symbols, the longest match at each place; rows must come longest first, filling is ignored."""
        m, width = patterns.shape
        found = np.searchsorted(self.symbols, patterns)
        dense = np.where(self.symbols[np.minimum(found, len(self.symbols) - 1)] == patterns, found, -1)
        out = np.zeros((m, width), np.int32)
        row, at, size = np.zeros(m, np.int64), np.full(m, self.first_at[0]), np.zeros(m, np.int64)
        for back in range(1, int(lengths.max(initial=0)) + 1):
            live = int(np.searchsorted(-lengths, -back, side="right"))
            place = lengths[:live] - back
            symbol = dense[np.arange(live), place]
            run = np.searchsorted(self.begins, row[:live], side="right") - 1
            goes_on = self.heads[run] == symbol
            row_next = self.steps_to[run] + row[:live] - self.begins[run]
            at_next, size_next = at[:live] - 1, size[:live] + 1
            off = np.flatnonzero(~goes_on)
            if len(off):
                wanted = symbol[off]
                below = np.searchsorted(self.keys, wanted * self.n + row[off])
                picks = []
                for sorted_at, samples, rows in ((below - 1, self.last_at, self.last_row), (below, self.first_at, self.begins)):
                    there = (sorted_at >= 0) & (sorted_at < len(self.keys)) & (wanted >= 0)
                    which = self.by_symbol[np.clip(sorted_at, 0, len(self.keys) - 1)]
                    there &= self.heads[which] == wanted
                    place_there = samples[which]
                    shared = self._shared(at[off], place_there, np.where(there, size[off], 0))
                    picks.append((np.where(there, shared, -1), place_there, self.steps_to[which] + rows[which] - self.begins[which]))
                above_better = picks[0][0] >= picks[1][0]
                share, pos, to = (np.where(above_better, x, y) for x, y in zip(*picks))
                none = share < 0
                row_next[off] = np.where(none, 0, to)
                at_next[off] = np.where(none, self.first_at[0], pos - 1)
                size_next[off] = np.where(none, 0, share + 1)
            row[:live], at[:live], size[:live] = row_next, at_next, size_next
            out[np.arange(live), place] = size_next
        return out
