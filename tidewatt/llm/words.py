"""Vectorised words and hashes of whole texts inside Arrow tasks.

A word is a maximal run of bytes other than space and 0x09-0x0D, A-Z lower-cased. Texts of a slice lie in one
buffer, so every step is one numpy pass over the slice. A null text has no word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_BASE_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = _U(0xD6E8FEB86659FD93)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser with full avalanche."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


@lru_cache(maxsize=1)
def _trim():
    """The C library's call that gives freed memory back, where there is one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError, TypeError):
        return lambda _: 0


def release() -> None:
    """Give back what this process has freed: a Python worker lives on beside the executor's heap, also while idle."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def released(run):
    """A function on a group, after which the worker gives back what the group took."""
    @wraps(run)
    def whole(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            release()

    return whole


@lru_cache(maxsize=4)
def _powers(n: int, inverse: bool) -> np.ndarray:
    out = np.full(n + 1, _BASE_INVERSE if inverse else _BASE, dtype=_U)
    out[0] = 1
    return np.cumprod(out, dtype=_U)


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """Powers 0..n of the hash base modulo 2^64; sizes are rounded up so that few tables are made."""
    return _powers(max(SLICE_BYTES, 1 << int(n).bit_length()), inverse)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Parts of the batches with about SLICE_BYTES of text each; one longer text is a part of its own.

    After each batch the worker gives back what it has freed.
    """
    for batch in batches:
        text = batch.column(column)
        if not batch.num_rows:
            continue
        sizes = np.nan_to_num(np.asarray(pc.binary_length(text).to_numpy(zero_copy_only=False), dtype=float))
        begin, total = 0, 0
        for i, size in enumerate(sizes):
            if i > begin and total + size > SLICE_BYTES:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += size
        yield batch.slice(begin)
        release()


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all values, n + 1 offsets); null counts as empty."""
    values = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = values.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[values.offset:values.offset + len(values) + 1]
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[off[0]:off[-1]], off - off[0]


class Sums:
    """Prefix sums of a polynomial hash: the hash of any byte range in constant time."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.inverse = powers(n, True)
        self.sums = np.zeros(n + 1, dtype=_U)
        np.cumsum((data.astype(_U) + _U(1)) * powers(n)[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mix(value + (end - start).astype(_U) * _STEP)


@dataclass
class Words:
    """Words of a slice in order: byte range in data, index of the text, hash; first[i] is text i's first word."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words(column: pa.Array, lower: bool = True) -> Words:
    """Words of all texts of a slice; lower: A-Z are hashed as a-z."""
    data, offsets = raw(column)
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.zeros(len(data), dtype=bool)
    before[1:] = solid[:-1]
    start = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = solid[1:]
    end = np.flatnonzero(solid & (~after | edge[1:])) + 1
    first = np.searchsorted(start, offsets)
    return Words(data, offsets, start, end, first, Sums(_LOWER[data] if lower else data).of(start, end) if len(start) else np.zeros(0, _U))


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of a byte mask over each text."""
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of the lines between line feeds; a text of zero bytes has one empty line."""
    breaks = np.flatnonzero(data == 0x0A)
    start = np.concatenate([offsets[:-1], breaks + 1])
    text = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, "right") - 1])
    order = np.lexsort((start, text))
    start, text = start[order], text[order]
    end = np.append(start[1:] - 1, 0)
    last = np.append(text[1:] != text[:-1], True)
    end[last] = offsets[text[last] + 1]
    return start, end, text


def sequences(hashes: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k words from each position on."""
    acc = np.full(len(at), k, dtype=_U)
    for j in range(k):
        acc = acc * _STEP + hashes[at + j]
    return mix(acc)


def shingles(w: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, n + 1 bounds): the distinct k-word shingles of each text, ascending.

    A text of 1 to k - 1 words has its whole sequence as one shingle, one without words none.
    """
    counts = w.counts
    whole = np.maximum(counts - k + 1, 0)
    bounds = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(whole + ((counts > 0) & (counts < k)), out=bounds[1:])
    out = np.empty(bounds[-1], dtype=_U)
    at = np.arange(whole.sum()) + np.repeat(w.first[:-1] - (np.cumsum(whole) - whole), whole)
    place = np.arange(whole.sum()) + np.repeat(bounds[:-1] - (np.cumsum(whole) - whole), whole)
    out[place] = sequences(w.hash, at, k)
    for m in range(1, k):
        short = np.flatnonzero(counts == m)
        if len(short):
            out[bounds[short]] = sequences(w.hash, w.first[short], m)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        out[a:b].sort()
    new = np.ones(len(out), dtype=bool)
    new[1:] = out[1:] != out[:-1]
    new[bounds[:-1][whole > 0]] = True
    kept = np.zeros(len(out) + 1, dtype=np.int64)
    np.cumsum(new, out=kept[1:])
    return out[new], kept[bounds]


def binaries(parts: list[np.ndarray] | tuple[np.ndarray, np.ndarray]) -> pa.Array:
    """One binary per array."""
    return pa.array([p.tobytes() for p in parts], pa.binary())
