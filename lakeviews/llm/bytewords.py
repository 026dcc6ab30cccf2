"""Words of Arrow string columns as arrays: positions and 64-bit hashes, without a loop over rows.

A batch is taken in chunks of about ``CHUNK`` bytes of whole texts; memory is a
few dozen bytes per byte of a chunk (or of one longer text).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
#: ASCII other than letters and digits separates words too.
PUNCTUATION = SPACE.copy()
PUNCTUATION[[b for b in range(128) if not chr(b).isalnum()]] = True
_VALUES = np.random.RandomState(20).randint(1, 1 << 62, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _VALUES.copy()
_LOWER[ord("A"):ord("Z") + 1] = _VALUES[ord("a"):ord("z") + 1]
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, n of each at least."""
    if len(_powers[0]) < n:
        for k, b in enumerate((_BASE, _INVERSE)):
            _powers[k] = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, b))])
    return _powers[0], _powers[1]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offs = np.frombuffer(offsets, width, n + 1, column.offset * width().itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts of about ``limit`` bytes."""
    raw, offs = buffers(column)
    at, n = 0, len(offs) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        yield at, end, raw[offs[at]:offs[end]], offs[at:end + 1] - offs[at]
        at = end


@dataclass
class Words:
    row: np.ndarray  # of each word, from 0
    start: np.ndarray  # byte offset in the chunk
    end: np.ndarray
    hash: np.ndarray | None
    first: np.ndarray  # index of each row's first word, one more at the end


def words(raw: np.ndarray, offs: np.ndarray, space: np.ndarray = SPACE, lower: bool = False, hashed: bool = True) -> Words:
    n = len(raw)
    inside = ~space[raw]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    first = np.searchsorted(start, offs)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    h = span_hash(prefix_sums(raw, lower), start, end) if hashed else None
    return Words(row, start, end, h, first)


def prefix_sums(raw: np.ndarray, lower: bool = False) -> np.ndarray:
    up, _ = powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((_LOWER if lower else _VALUES)[raw] * up[:len(raw)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span, the same wherever the span lies."""
    _, down = powers(len(sums))
    return mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def grams(w: Words, n: int, gap: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of n words in order, ``gap`` apart, within a row."""
    reach = (n - 1) * gap
    if len(w.row) <= reach:
        return w.row[:0], np.zeros(0, np.uint64)
    m = len(w.row) - reach
    h = np.full(m, np.uint64(n * 31 + gap))
    for k in range(n):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + w.hash[k * gap:k * gap + m])
    same = w.row[:m] == w.row[reach:]
    return w.row[:m][same], h[same]


def distinct(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, value) in order of both."""
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]
