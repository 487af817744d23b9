"""Suffix sorting by hash comparison.

Two suffixes are compared by the length of their common extension, found by
binary search over prefix polynomial hashes, and the byte after it; the
suffixes are ordered by a bottom-up mergesort whose merges rank all elements
of a run in its neighbour at once.
"""

from __future__ import annotations

import numpy as np

from .common import BASE, BASE2, U64, inverse, powers, prefix_hash


class Suffixes:
    """Suffixes ``at[i]`` of ``data``, each of at most ``length[i]`` bytes."""

    def __init__(self, data: np.ndarray, at: np.ndarray, length: np.ndarray, base: int = BASE):
        self.data, self.at, self.length = data, at.astype(np.int64), length.astype(np.int64)
        self.base = base
        self.prefix = prefix_hash(data, base)
        self.scale = powers(len(data), inverse(base))[self.at]
        self.origin = self.prefix[self.at]

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Lengths of the common extensions of the suffixes x and y (arrays of numbers)."""
        lx, ly = self.at[x], self.at[y]
        most = np.minimum(self.length[x], self.length[y])
        px, py, sx, sy = self.origin[x], self.origin[y], self.scale[x], self.scale[y]
        found = np.zeros(len(x), dtype=np.int64)
        step = 1 << max(0, int(most.max(initial=0)).bit_length() - 1)
        while step:
            t = found + step
            ok = t <= most
            t = np.where(ok, t, 0)
            ok &= (self.prefix[lx + t] - px) * sx == (self.prefix[ly + t] - py) * sy
            found = np.where(ok, t, found)
            step >>= 1
        return found

    def less(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether suffix x stands before suffix y (ties by number); a number below 0 stands last."""
        out = (y < 0) & (x >= 0)
        live = np.flatnonzero((x >= 0) & (y >= 0))
        x, y = x[live], y[live]
        n = self.common(x, y)
        endx, endy = n >= self.length[x], n >= self.length[y]
        top = len(self.data) - 1
        bx = self.data[np.minimum(self.at[x] + n, top)].astype(np.int16)
        by = self.data[np.minimum(self.at[y] + n, top)].astype(np.int16)
        bx[endx], by[endy] = -1, -1
        out[live] = (bx < by) | ((bx == by) & (x < y))
        return out

    def _rank(self, x: np.ndarray, runs: np.ndarray) -> np.ndarray:
        """How many elements of row r of ``runs`` stand before each element of row r of ``x``."""
        rows, width = runs.shape
        lo = np.zeros(x.shape, dtype=np.int64)
        hi = np.full(x.shape, width, dtype=np.int64)
        row = np.arange(rows)[:, None]
        for _ in range(int(width).bit_length()):
            mid = (lo + hi) >> 1
            other = runs[row, np.minimum(mid, width - 1)]
            before = self.less(other.ravel(), x.ravel()).reshape(x.shape) & (mid < hi)
            lo, hi = np.where(before, mid + 1, lo), np.where(before, hi, mid)
        return lo

    def mergesort(self, groups: np.ndarray) -> np.ndarray:
        """Sort every row of ``groups`` (suffix numbers, a power of two wide, -1 as padding)."""
        out = groups
        width = 1
        while width < groups.shape[1]:
            runs = out.reshape(-1, 2 * width)
            a, b = runs[:, :width], runs[:, width:]
            row = np.broadcast_to(np.arange(len(runs))[:, None], a.shape)
            own = np.arange(width)[None, :]
            spot_a, spot_b = own + self._rank(a, b), own + self._rank(b, a)
            keep_a, keep_b = a >= 0, b >= 0
            merged = np.full_like(runs, -1)
            merged[row[keep_a], spot_a[keep_a]] = a[keep_a]
            merged[row[keep_b], spot_b[keep_b]] = b[keep_b]
            out = merged.reshape(groups.shape)
            width *= 2
        return out

    def sort_groups(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sort the suffixes within groups: (order, first of its group, common length with the one before).

        Groups of one size class (up to the next power of two) are sorted together.
        """
        n = len(group)
        by = np.argsort(group, kind="stable")
        g = group[by]
        first = np.ones(n, dtype=bool)
        first[1:] = g[1:] != g[:-1]
        start = np.flatnonzero(first)
        size = np.diff(np.append(start, n))
        order = by.copy()
        width = 2
        while width < 2 * int(size.max(initial=1)):
            sel = np.flatnonzero((size > width // 2) & (size <= width))
            # bounded number of elements at a time
            for part in np.array_split(sel, max(1, len(sel) * width // (1 << 17))):
                if len(part):
                    spot = start[part][:, None] + np.arange(width)[None, :]
                    real = np.arange(width)[None, :] < size[part][:, None]
                    rows = np.where(real, by[np.minimum(spot, n - 1)], -1)
                    order[spot[real]] = self.mergesort(rows)[real]
            width *= 2
        lcp = np.zeros(n, dtype=np.int64)
        inner = np.flatnonzero(~first)
        if len(inner):
            lcp[inner] = self.common(order[inner - 1], order[inner])
        return order, first, lcp

    def holds(self, order: np.ndarray, first: np.ndarray, lcp: np.ndarray) -> bool:
        """Whether neighbours in the order really agree in ``lcp`` bytes and then differ (or end)."""
        inner = np.flatnonzero(~first)
        top = len(self.data) - 1
        for part in np.array_split(inner, max(1, len(inner) // 20000)):
            x, y, n = order[part - 1], order[part], lcp[part]
            span = np.arange(int(n.max(initial=0)))[None, :]
            inside = span < n[:, None]
            dx = self.data[np.minimum(self.at[x][:, None] + span, top)]
            dy = self.data[np.minimum(self.at[y][:, None] + span, top)]
            if (inside & (dx != dy)).any():
                return False
            more = (n < self.length[x]) & (n < self.length[y])
            if (more & (self.data[np.minimum(self.at[x] + n, top)] == self.data[np.minimum(self.at[y] + n, top)])).any():
                return False
        return True


def sorted_suffixes(data, at, length, group):
    """``sort_groups`` with collision verification: a failed check sorts anew with another base."""
    for base in (BASE, BASE2, BASE ^ 0x5555555555555554, BASE2 ^ 0x3333333333333332):
        s = Suffixes(data, at, length, base)
        got = s.sort_groups(group)
        if s.holds(*got):
            return got
    raise ValueError("hash collisions under every base")
