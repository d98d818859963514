"""Numpy scanning of text held in Arrow string columns: words, word hashes, lookup tables.

Everything here works on the UTF-8 bytes of a whole batch at once, so a task costs a few
nanoseconds per byte and never builds a Python object per word. Memory is bounded: bytes are
scanned in blocks that end between words, so only the 8-byte hash, start and end of each word
are held for a whole text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 17
GROUP_BYTES = 1 << 20

_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Longer ranges are hashed one by one with BLAKE2b.
LONG = 128


def byte_table(predicate) -> np.ndarray:
    """Boolean table over byte values for ``predicate(byte)``."""
    return np.array([bool(predicate(b)) for b in range(256)])


#: Words between ASCII white space (space, tab, line feed, vertical tab, form feed, return).
NOT_SPACE = byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Words of ASCII digits, ASCII letters and anything beyond ASCII.
ALNUM_OR_WIDE = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)
#: Byte values with A-Z folded to a-z.
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on every input bit."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash of each byte range ``[start, end)`` of ``data`` (ranges may be any, in order or not).

    A range is read eight bytes at a time and each piece goes through the finaliser together with the
    hash so far, so no sum over positions can cancel out; ranges over ``LONG`` bytes take BLAKE2b.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    if fold is not None:
        data = fold[data]
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    pieces = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    size = ends - starts
    with np.errstate(over="ignore"):
        h = (size.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        on = np.arange(len(starts))
        for k in range(0, min(int(size.max(initial=0)), LONG), 8):
            on = on[size[on] > k]
            left = np.minimum(size[on] - k, 8).astype(np.uint64)
            h[on] = mix(h[on] ^ (pieces[starts[on] + k] & (_ALL >> (np.uint64(64) - np.uint64(8) * left))))
        h = mix(h + np.uint64(0x9E3779B97F4A7C15))
    for i in np.flatnonzero(size > LONG).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return h


def scan_words(data: np.ndarray, row_starts: np.ndarray, table: np.ndarray, fold: np.ndarray | None = None):
    """(hashes, starts, ends) of the maximal runs of ``table`` bytes; a run never crosses a row start."""
    n = len(data)
    rows = row_starts[row_starts < n]
    hashes, starts, ends = [], [], []
    a = 0
    while a < n:
        b = min(a + BLOCK, n)
        while b < n and table[data[b - 1]] and table[data[b]]:
            ahead = data[b : b + BLOCK]
            stop = np.flatnonzero(~table[ahead])
            b = b + int(stop[0]) if len(stop) else b + len(ahead)
        inside = table[data[a:b]]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        own = rows[np.searchsorted(rows, a) : np.searchsorted(rows, b)] - a
        first[own] = inside[own]
        s = np.flatnonzero(first)
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        cut = own[own > 0] - 1
        last[cut] = inside[cut]
        e = np.flatnonzero(last) + 1
        hashes.append(range_hashes(data[a:b], s, e, fold))
        starts.append(s + a)
        ends.append(e + a)
        a = b
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts), np.concatenate(ends)


def flat_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_groups(batch: pa.RecordBatch, column: str, most: int = GROUP_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with about ``most`` bytes of text (a longer single text is a slice of its own)."""
    if not batch.num_rows:
        return
    data, offsets = flat_text(batch.column(column))
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield batch.slice(i, j - i), data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def rows_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First word of each row: ``out[i]:out[i + 1]`` are the words of row ``i``."""
    return np.searchsorted(starts, offsets, "left")


def take_ranges(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The elements of the ranges ``[start, start + length)`` of ``flat``, one after another."""
    total = int(lengths.sum())
    if not total:
        return flat[:0]
    ends = np.cumsum(lengths)
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


class HashTable:
    """Open-addressed map from 64-bit keys to non-negative 32-bit values, looked up by whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        keys, first = np.unique(np.asarray(keys, np.uint64), return_index=True)
        values = np.asarray(values, np.int32)[first]
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.full(1 << bits, -1, np.int32)
        slot = self._slot(keys)
        left = np.arange(len(keys))
        while len(left):
            free = left[self.values[slot[left]] < 0]
            _, winner = np.unique(slot[free], return_index=True)
            put = free[winner]
            self.keys[slot[put]], self.values[slot[put]] = keys[put], values[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            slot[left] = (slot[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where there is none."""
        slot = self._slot(keys)
        out = self.values[slot]
        other = np.flatnonzero((out >= 0) & (self.keys[slot] != keys))
        while len(other):
            slot[other] = (slot[other] + 1) & self.mask
            out[other] = self.values[slot[other]]
            other = other[(out[other] >= 0) & (self.keys[slot[other]] != keys[other])]
        return out
