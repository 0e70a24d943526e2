"""Texts of an Arrow column as flat numpy arrays: bytes, words, lines, code points, hashes.

All functions work on whole texts. A batch is cut into runs of whole rows (``runs``) so that
the arrays of one step stay near ``RUN_BYTES`` bytes of text, or one text if it is longer.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

RUN_BYTES = 600_000

#: Bytes of words of lower-cased text: digits, a-z and everything outside ASCII.
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True
#: Bytes other than ASCII white space.
INK = np.ones(256, bool)
INK[[32, 9, 10, 11, 12, 13]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


class Flat:
    """Some consecutive texts: ``data`` (uint8) and ``at`` (int64 offsets, one more than texts)."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        self.data, self.at = data, at

    def __len__(self) -> int:
        return len(self.at) - 1

    def lower(self) -> Flat:
        return Flat(LOWER[self.data], self.at)

    def text(self, i: int) -> bytes:
        return self.data[self.at[i]:self.at[i + 1]].tobytes()


def runs(column: pa.Array, most: int = RUN_BYTES):
    """(first row, Flat) of runs of whole texts; null texts count as empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    at = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    first, n = 0, len(column)
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        last = min(last, n)
        yield first, Flat(data[at[first]:at[last]], at[first:last + 1] - at[first])
        first = last


def spans(flat: Flat, table: np.ndarray):
    """Starts, ends and text numbers of the maximal runs of bytes marked in ``table``."""
    if not len(flat.data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    mark = table[flat.data]
    edge = np.zeros(len(mark) + 1, bool)
    edge[flat.at] = True
    before = np.empty_like(mark)
    before[0], before[1:] = False, mark[:-1]
    starts = np.flatnonzero(mark & (~before | edge[:-1]))
    after = np.empty_like(mark)
    after[-1], after[:-1] = False, mark[1:]
    ends = np.flatnonzero(mark & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(flat.at, starts, "right") - 1


def lines(flat: Flat):
    """Starts, ends and text numbers of all ``\\n``-split lines; an empty text has one."""
    cut = np.flatnonzero(flat.data == 10)
    starts = np.sort(np.concatenate([flat.at[:-1], cut + 1]), kind="stable")
    owner_of_cut = np.searchsorted(flat.at, cut, "right") - 1
    texts = np.sort(np.concatenate([np.arange(len(flat)), owner_of_cut]), kind="stable")
    ends = np.sort(np.concatenate([flat.at[1:], cut]), kind="stable")
    return starts, ends, texts


@lru_cache(1)
def _powers(size: int):
    up = np.full(size, _BASE, np.uint64)
    down = np.full(size, _INVERSE, np.uint64)
    if size:
        up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A well-spread permutation of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of slices of ``data``; equal bytes give equal hashes anywhere."""
    size = 1 << max(len(data) + 1, 1 << 16).bit_length()
    up, down = _powers(size)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
    own = (total[ends] - total[starts]) * down[starts]
    return mix(own + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def chain(values: np.ndarray, texts: np.ndarray, n: int):
    """Hashes of all n consecutive values within one text, and where each begins."""
    count = len(values) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    begin = np.flatnonzero(texts[:count] == texts[n - 1:])
    out = np.zeros(len(begin), np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(0xA24BAED4963EE407) + values[begin + k] + np.uint64(k + 1))
    return out, begin




def parts(batches, rows: int = 512):
    """Arrow batches in slices of some rows, so that what is made of one stays small."""
    for batch in batches:
        for first in range(0, len(batch), rows):
            yield batch.slice(first, rows)
        del batch
        pa.default_memory_pool().release_unused()


class Tally:
    """Counts by number, added up over many arrays in as much memory as there are numbers."""

    def __init__(self):
        self.keys, self.counts, self.waiting, self.held = (np.zeros(0, np.uint64),
                                                           np.zeros(0, np.int64), [], 0)

    def add(self, values: np.ndarray) -> None:
        self.waiting.append(np.unique(values, return_counts=True))
        self.held += len(self.waiting[-1][0])
        if self.held > max(len(self.keys), 1_000_000):
            self.total()

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if self.waiting:
            keys = np.concatenate([self.keys, *[k for k, _ in self.waiting]])
            counts = np.concatenate([self.counts, *[n for _, n in self.waiting]])
            self.keys, inverse = np.unique(keys, return_inverse=True)
            self.counts = np.bincount(inverse, counts, len(self.keys)).astype(np.int64)
            self.waiting, self.held = [], 0
        return self.keys, self.counts
