"""Words and word-window hashes of a whole Arrow column of text at once, in numpy, inside Spark tasks.

Texts come as binary columns (`text` cast to binary), so any bytes work. A null text is an empty one. Work goes in cuts
of a few megabytes of text, so a task's memory depends on the longest text and not on the batch."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CUT_BYTES = 1 << 22
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of the words of the contracts: everything but space and \x09-\x0D; and letters, digits and non-ASCII only.
SPACED = np.ones(256, bool)
SPACED[[32, 9, 10, 11, 12, 13]] = False
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
_BASE = 0x9E3779B97F4A7C15 & ~7 | 5
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_ODD = mix(np.arange(1000, 1064, dtype=np.uint64)) | np.uint64(1)


def _power(base: int, n: int) -> np.ndarray:
    kept = _powers.get(str(base))
    if kept is None or len(kept) < n:
        size = max(n, min(n + n // 4, CUT_BYTES + 65536))
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        _powers[str(base)] = kept = np.cumprod(steps, dtype=np.uint64)
    return kept[:n]


@dataclass
class Words:
    """The words of some texts: where each starts and ends in `data`, and `rows[i]:rows[i + 1]`, the words of text i."""
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, from running sums of bytes times powers."""
        n = len(self.data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[self.data] * _power(_BASE, n), out=sums[1:])
        inverse = _power(pow(_BASE, -1, 1 << 64), n + 1)
        return mix((sums[self.ends] - sums[self.starts]) * inverse[self.starts] + (self.ends - self.starts).astype(np.uint64) * _ODD[0])

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()

    def texts(self, which: np.ndarray) -> pa.Array:
        """The words numbered `which` as a binary column."""
        lengths = self.ends[which] - self.starts[which]
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat(self.starts[which] - offsets[:-1], lengths) + np.arange(offsets[-1])
        return pa.Array.from_buffers(pa.binary(), len(which), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(self.data[at])])


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column and the offsets of its values."""
    column = column.fill_null(b"") if column.null_count else column
    column = column.cast(pa.large_binary())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if column.buffers()[2] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def words(column: pa.Array, inside: np.ndarray = SPACED) -> Words:
    """The words of a binary column, A-Z lower-cased."""
    data, offsets = bytes_of(column)
    data = _LOWER[data]
    within = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = within[:-1], within[1:]
    starts = np.flatnonzero(within & (~before | edge[:-1]))
    ends = np.flatnonzero(within & (~after | edge[1:])) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def windows(hashes: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every k consecutive words that stay in one text, in order, and the offsets of each text's. A text of
    fewer words, but not none, has one: that of all its words."""
    counts = np.diff(rows)
    n_windows = np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))
    offsets = np.concatenate([[0], np.cumsum(n_windows)])
    if len(hashes) == 0:
        return np.zeros(0, np.uint64), offsets
    padded = np.concatenate([hashes, np.zeros(k, np.uint64)])
    total = np.zeros(len(hashes), np.uint64)
    for j in range(k):
        total += padded[j:j + len(hashes)] * _ODD[j + 1]
    short = np.flatnonzero((counts > 0) & (counts < k))
    for i in short:
        own = hashes[rows[i]:rows[i + 1]]
        total[rows[i]:rows[i] + 1] = (own * _ODD[1:1 + len(own)]).sum(dtype=np.uint64, keepdims=True) + _ODD[40 + len(own) % 20:][:1]
    at = np.repeat(rows[:-1] - offsets[:-1], n_windows) + np.arange(offsets[-1])
    return mix(total[at]), offsets


def stretches(hashes: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each hashes[first:stop], from running sums of hashes times powers."""
    n = len(hashes)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(hashes) * _power(_BASE, n), out=sums[1:])
    inverse = _power(pow(_BASE, -1, 1 << 64), n + 1)
    return mix((sums[stop] - sums[first]) * inverse[first] + (stop - first).astype(np.uint64) * _ODD[0])


def least(hashes: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The place of the smallest of each hashes[first:stop], the first of equal ones. No range is empty."""
    level = np.arange(len(hashes))
    found = np.zeros(len(first), np.int64)
    power = np.floor(np.log2(np.maximum(stop - first, 1))).astype(np.int64)
    for k in range(int(power.max(initial=0)) + 1):
        if k:  # the smallest of 2^k hashes from each place on
            right = level[np.minimum(np.arange(len(level)) + (1 << (k - 1)), len(level) - 1)]
            level = np.where(hashes[right] < hashes[level], right, level)
        own = np.flatnonzero(power == k)
        a, b = level[first[own]], level[stop[own] - (1 << k)]
        found[own] = np.where(hashes[b] < hashes[a], b, a)
    return found


def distinct_per_row(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row, and the offsets of each row's."""
    values = values.copy()
    for start, stop in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        values[start:stop].sort()
    first = np.ones(len(values), bool)
    first[1:] = values[1:] != values[:-1]
    first[offsets[:-1][offsets[:-1] < len(values)]] = True
    return values[first], np.concatenate([[0], np.cumsum(first)])[offsets]


def cuts(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CUT_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most `limit` bytes of text, or of one row."""
    for batch in batches:
        column = batch.column(text)
        lengths = pc.binary_length(column.fill_null(b"")).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(lengths), 0
        while start < len(lengths):
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def ids(values: np.ndarray) -> np.ndarray:
    """Unsigned hashes as Spark's signed longs."""
    return values.astype(np.uint64).view(np.int64)
