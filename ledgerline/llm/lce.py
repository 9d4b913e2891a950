"""Longest common extensions of two places of a sequence, from a difference cover.

A cover of ``V`` is a set of residues such that any two places, moved on by some common
``delta < V``, both come to lie on a residue of it.  Only the suffixes that start at such
places are sorted: first by their leading ``V`` numbers, packed, then by ranks of the
place ``V``, ``2V``, ``4V`` ... further on, which is sampled too.  The common prefixes of
neighbours in that order are kept in a sparse table of minima.

A query compares number after number up to ``delta``; where all agree, both places are
sampled, and the minimum over the neighbours between their ranks gives the rest.
"""

from __future__ import annotations

import numpy as np

# A perfect difference set; every residue of 31 is a difference of two.
V = 31
COVER = (0, 1, 3, 8, 12, 18)


def shifts(v: int = V, cover: tuple[int, ...] = COVER) -> np.ndarray:
    """The smallest ``delta`` for each pair of residues."""
    covered = np.zeros(v, bool)
    covered[list(cover)] = True
    steps = np.arange(v)
    made = np.full((v, v), -1)
    for delta in steps[::-1]:
        at = covered[(steps + delta) % v]
        made[np.outer(at, at)] = delta
    return made


SHIFTS = shifts()


class Extensions:
    """Common extensions to the right within ``text``: integers from 1 up.

    Parts of a joined text end in numbers that occur once, so that none goes beyond.
    """

    def __init__(self, text: np.ndarray):
        self.n = n = len(text)
        # Zeros behind the end make every look-ahead valid.
        self.text = np.concatenate([text.astype(np.int64), np.zeros(2 * V, np.int64)])
        residues = np.zeros(V, bool)
        residues[list(COVER)] = True
        places = np.flatnonzero(residues[np.arange(n) % V]) if n else np.zeros(0, np.int64)
        self.slot = np.full(n + 1, -1, np.int32)
        self.slot[places] = np.arange(len(places), dtype=np.int32)
        self._sort(places)

    def _sort(self, places: np.ndarray) -> None:
        text, m = self.text, len(places)
        bits = max(1, int(text.max(initial=0)).bit_length())
        per = max(1, 63 // bits)
        keys = []
        for at in range(0, V, per):
            key = np.zeros(m, np.int64)
            for step in range(at, min(V, at + per)):
                key = (key << bits) | text[places + step]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        rank = self._ranks(order, keys)
        # Ranks by V, 2V, 4V ... numbers; past the end comes first.
        levels = [rank]
        span = V
        while m and levels[-1].max() < m - 1:
            rank = levels[-1]
            ahead = places + span
            further = np.full(m, -1, np.int64)
            inside = ahead < self.n
            further[inside] = rank[self.slot[ahead[inside]]]
            order = np.lexsort((further, rank))
            levels.append(self._ranks(order, [rank, further]))
            span *= 2
        self.rank = levels[-1].astype(np.int32)
        order = np.empty(m, np.int64)
        order[self.rank] = np.arange(m)
        shared = self._shared(places, places[order], levels)
        self.table = self._minima(shared)

    @staticmethod
    def _ranks(order: np.ndarray, keys: list[np.ndarray]) -> np.ndarray:
        new = np.zeros(len(order), np.int64)
        for key in keys:
            sorted_ = key[order]
            new[1:] |= sorted_[1:] != sorted_[:-1]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(new)
        return rank

    def _shared(self, places: np.ndarray, ordered: np.ndarray, levels) -> np.ndarray:
        """Common prefixes of sampled suffixes that are neighbours in order."""
        a, b = ordered[:-1].copy(), ordered[1:].copy()
        start = a.copy()
        for level in range(len(levels) - 2, -1, -1):
            step, rank = V << level, levels[level]
            inside = (a < self.n) & (b < self.n)
            same = np.zeros(len(a), bool)
            same[inside] = rank[self.slot[a[inside]]] == rank[self.slot[b[inside]]]
            # Equal ranks of two places whose spans run past the end differ by length.
            a[same] += step
            b[same] += step
        return (a - start + self._plain(a, b, np.full(len(a), V))).astype(np.int32)

    @staticmethod
    def _minima(values: np.ndarray) -> list[np.ndarray]:
        table = [values]
        span = 1
        while 2 * span <= len(values):
            last = table[-1]
            table.append(np.minimum(last[:-span], last[span:]))
            span *= 2
        return table

    def _plain(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal numbers from ``a`` and ``b`` on, up to ``most``, one after another."""
        text, got = self.text, np.zeros(len(a), np.int64)
        live = np.flatnonzero((most > 0) & (a < self.n) & (b < self.n))
        while len(live):
            at = got[live]
            x, y = a[live] + at, b[live] + at
            same = (text[x] == text[y]) & (x < self.n) & (y < self.n)
            live = live[same]
            got[live] += 1
            live = live[got[live] < most[live]]
        return got

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many numbers from ``a`` and from ``b`` on (``a < b <= n``) are equal."""
        delta = SHIFTS[a % V, b % V]
        got = self._plain(a, b, delta)
        on = np.flatnonzero((got == delta) & (b + delta < self.n))
        if len(on):
            x = self.rank[self.slot[a[on] + delta[on]]].astype(np.int64)
            y = self.rank[self.slot[b[on] + delta[on]]].astype(np.int64)
            lo, hi = np.minimum(x, y), np.maximum(x, y)
            width = hi - lo
            level = np.frexp(width.astype(np.float64))[1] - 1
            rest = np.empty(len(on), np.int64)
            for k in np.unique(level):
                of = level == k
                row = self.table[k]
                rest[of] = np.minimum(row[lo[of]], row[hi[of] - (1 << k)])
            got[on] += rest
        return got
