"""Hashes of the runs of a byte class in texts, for operators with token rules of their own."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .common import PIECE, mix, window_sums


def byte_class(*spans: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags, true for the bytes of the (first, last) spans."""
    out = np.zeros(256, bool)
    for first, last in spans:
        out[first : last + 1] = True
    return out


def _cuts(data: np.ndarray, lo: int, hi: int, member: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut data[lo:hi] into pieces of about PIECE bytes, each but the last ending outside a run."""
    while hi - lo > 2 * PIECE:
        cut, size = 0, PIECE
        while not cut:
            outside = np.flatnonzero(~member[data[lo : min(lo + size, hi)]])
            if len(outside):
                cut = lo + int(outside[-1]) + 1
            elif lo + size >= hi:
                cut = hi
            size *= 2
        yield lo, cut
        lo = cut
    if hi > lo:
        yield lo, hi


def run_spans(data: np.ndarray, offsets: np.ndarray, i: int, j: int, member: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """First byte, end and row (from 0) of each maximal run of ``member`` bytes in rows i..j-1, in order, piece by piece."""
    for lo, hi in _cuts(data, int(offsets[i]), int(offsets[j]), member):
        inside = member[data[lo:hi]]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        breaks = offsets[i:j] - lo
        breaks = breaks[(breaks > 0) & (breaks < hi - lo)]
        opens[breaks] |= inside[breaks]
        closes[breaks - 1] |= inside[breaks - 1]
        starts, ends = np.flatnonzero(opens) + lo, np.flatnonzero(closes) + 1 + lo
        yield starts, ends, np.searchsorted(offsets[i : j + 1], starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Hashes of the ascending spans data[starts:ends] by ``values``, a number for each byte; bytes that are to count as equal have the same one."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lo, hi = int(starts[0]), int(ends[-1])
    sums, down = window_sums(values[data[lo:hi]], hi - lo)
    a, b = starts - lo, ends - lo
    return mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))


def run_hashes(data: np.ndarray, offsets: np.ndarray, i: int, j: int, member: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each run of ``run_spans``."""
    hashes, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for starts, ends, row in run_spans(data, offsets, i, j, member):
        hashes.append(span_hashes(data, starts, ends, values))
        rows.append(row)
    return np.concatenate(hashes), np.concatenate(rows)


class Column:
    """An array that grows at its end without being copied each time."""

    def __init__(self, kind: type):
        self._held, self._n = np.zeros(1024, kind), 0

    def __len__(self) -> int:
        return self._n

    @property
    def values(self) -> np.ndarray:
        return self._held[: self._n]

    def extend(self, more: np.ndarray) -> None:
        n = self._n + len(more)
        if n > len(self._held):
            self._held = np.concatenate([self.values, np.zeros(max(n, 2 * self._n) - self._n, self._held.dtype)])
        self._held[self._n : n] = more
        self._n = n


class HashIndex:
    """Numbers 0, 1, 2, ... of 64-bit hashes, for lookups of whole arrays.

    New hashes wait in a small table of their own until there are enough to be worth a merge.
    """

    WAITING = 1 << 16

    def __init__(self):
        empty = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.tables = [empty, empty]

    def __len__(self) -> int:
        return sum(len(keys) for keys, _ in self.tables)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The numbers of hashes, -1 for those without one."""
        out = np.full(len(hashes), -1)
        for keys, numbers in self.tables:
            left = np.flatnonzero(out < 0)
            if len(keys) and len(left):
                at = np.minimum(np.searchsorted(keys, hashes[left]), len(keys) - 1)
                out[left] = np.where(keys[at] == hashes[left], numbers[at], -1)
        return out

    def add(self, hashes: np.ndarray) -> None:
        """Number new hashes in their order."""
        new = hashes, np.arange(len(self), len(self) + len(hashes))
        main, waiting = self.tables
        waiting = self._merged(waiting, new)
        if len(waiting[0]) > self.WAITING:
            main, waiting = self._merged(main, waiting), (waiting[0][:0], waiting[1][:0])
        self.tables = [main, waiting]

    @staticmethod
    def _merged(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([x[0], y[0]])
        order = np.argsort(keys, kind="stable")
        return keys[order], np.concatenate([x[1], y[1]])[order]
