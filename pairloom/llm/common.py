"""Byte-level helpers that run inside tasks: text buffers, word and shingle hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Texts are worked on in pieces of about so many bytes, so that memory does not grow with a batch.
PIECE = 1 << 19

WHITE = np.zeros(256, bool)
WHITE[[32, 9, 10, 11, 12, 13]] = True
CLOSING = np.zeros(256, bool)
CLOSING[[ord(c) for c in ".,;:!?"]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_LOWER_VALUE = BYTE_VALUE[LOWER]
_SHINGLE = mix(np.arange(1001, 1065, dtype=np.uint64)) | np.uint64(1)
_tables: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2^64.

    The tables are kept up to a bounded length; longer ones are made for the call.
    """
    held = _tables.get("up")
    if held is None or len(held) < n:
        size = max(n, 2 * PIECE)
        up, down = (np.full(size, b, np.uint64) for b in (_BASE, _INVERSE))
        up[0] = down[0] = 1
        up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if size > 8 * PIECE:
            return up[:n], down[:n]
        _tables["up"], _tables["down"] = up, down
    return _tables["up"][:n], _tables["down"][:n]


def text_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array and its row offsets; null counts as empty."""
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, bounds, data = column.buffers()
    offsets = np.frombuffer(bounds, np.int64 if large else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def row_runs(offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each; a longer row stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def window_sums(values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums P with P[i] = sum of values[:i] * base^i, and the inverse powers."""
    up, down = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up[:n], out=sums[1:])
    return sums, down


def _pieces(data: np.ndarray, lo: int, hi: int) -> Iterator[tuple[int, int]]:
    """Cut data[lo:hi] at white space into pieces of about PIECE bytes."""
    while hi - lo > 2 * PIECE:
        back = np.flatnonzero(WHITE[data[lo + PIECE // 2 : lo + PIECE]])
        if len(back):
            cut = lo + PIECE // 2 + int(back[-1]) + 1
        else:
            cut, step = lo + PIECE, PIECE
            while cut < hi:
                ahead = np.flatnonzero(WHITE[data[cut : min(cut + step, hi)]])
                if len(ahead):
                    cut += int(ahead[0]) + 1
                    break
                cut = min(cut + step, hi)
        yield lo, cut
        lo = cut
    yield lo, hi


def _spans(piece: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of ``piece``; no word crosses a break."""
    inside = ~WHITE[piece]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    breaks = breaks[(breaks > 0) & (breaks < len(piece))]
    opens[breaks] |= inside[breaks]
    closes[breaks - 1] |= inside[breaks - 1]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def word_hashes(data: np.ndarray, offsets: np.ndarray, i: int, j: int, tails: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of rows i..j-1, lower-cased A-Z, and the word count of each row.

    A word is a run of bytes other than 0x20 and 0x09-0x0D. Into ``tails`` goes, for each word, the
    number of its last two bytes before a closing mark.
    """
    hashes, counts = [], np.zeros(j - i, np.int64)
    for lo, hi in _pieces(data, int(offsets[i]), int(offsets[j])):
        if hi <= lo:
            continue
        piece = data[lo:hi]
        starts, ends = _spans(piece, offsets[i:j] - lo)
        sums, down = window_sums(_LOWER_VALUE[piece], hi - lo)
        hashes.append(mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)))
        if tails is not None:
            low = LOWER[piece].astype(np.int64)
            last = ends - 1
            last = np.where(CLOSING[piece[last]] & (last > starts), last - 1, last)
            tails.append(low[last] + 256 * np.where(last > starts, low[last - 1], 0))
        at = np.searchsorted(starts, np.clip(offsets[i : j + 1] - lo, 0, hi - lo))
        counts += np.diff(at)
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), counts


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles of one text: with fewer words, of the whole sequence; without words, none."""
    n = len(words)
    if n == 0:
        return words
    if n < k:
        return mix((words * _SHINGLE[:n]).sum(keepdims=True) + np.uint64(n))
    out = words[: n - k + 1] * _SHINGLE[0]
    for d in range(1, k):
        out = out + words[d : n - k + 1 + d] * _SHINGLE[d]
    return mix(out + np.uint64(k))


def text_shingles(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The distinct k-word shingle hashes of every row, ascending."""
    data, offsets = text_view(column)
    for i, j in row_runs(offsets):
        words, counts = word_hashes(data, offsets, i, j)
        at = 0
        for n in counts.tolist():
            yield np.unique(shingle_hashes(words[at : at + n], k))
            at += n


def lists_of(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """A list column from one numpy array per row."""
    ends = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=ends[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64) if flat.dtype == np.uint64 else flat, kind))
