"""Words of Arrow text columns as 64-bit hashes, in numpy and without Python strings.

A word is a longest run of bytes outside a set of ASCII separators, with A-Z lower-cased. Bytes
from 0x80 up always belong to words, so runs of bytes and runs of code points are the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SPACE = bytes([0x20, *range(0x09, 0x0E)])
NOT_ALNUM = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

#: Bytes hashed in one step; a step ends between words.
STEP = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_rng = np.random.Generator(np.random.PCG64(20240101))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _rng.integers(1, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows together, and where each row begins (one more than rows)."""
    column = column.cast(pa.large_string()).fill_null("")
    _, at, data = column.buffers()
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(at, np.int64)[column.offset : column.offset + n + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


class Words:
    """hash: of each word. row: first word of each row, one more than rows. start: first byte."""

    __slots__ = ("hash", "row", "start")

    def __init__(self, column: pa.Array, separators: bytes):
        inside = np.ones(256, bool)
        inside[list(separators)] = False
        inside[65:91] = inside[97:123]  # a letter that is lower-cased counts as its lower form
        data, rows = text_bytes(column)
        is_word = inside[data]
        first = is_word.copy()
        first[1:] &= ~is_word[:-1]
        begins = rows[:-1][rows[:-1] < len(data)]
        first[begins] = is_word[begins]
        self.start = np.flatnonzero(first)
        self.row = np.searchsorted(self.start, rows)
        code = _BYTE[_LOWER]
        code[~inside] = 0
        self.hash = np.empty(len(self.start), np.uint64)
        edge = 0
        while edge < len(self.start):
            to = np.searchsorted(self.start, self.start[edge] + STEP)
            to = max(int(to), edge + 1)
            a = int(self.start[edge])
            b = int(self.start[to]) if to < len(self.start) else len(data)
            self.hash[edge:to] = _hashes(data[a:b], self.start[edge:to] - a, code)
            edge = to

    def counts(self) -> np.ndarray:
        return np.diff(self.row)


def _hashes(data: np.ndarray, start: np.ndarray, code: np.ndarray) -> np.ndarray:
    length = np.diff(np.append(start, len(data)))
    place = np.arange(len(data), dtype=np.int64) - np.repeat(start, length)
    value = code[data]
    if place.max(initial=0) < len(_PLACE):
        value *= _PLACE[place]
    else:  # words beyond the table: each round of places has its own multiplier
        turn = (place // len(_PLACE)).astype(np.uint64)
        value *= _PLACE[place % len(_PLACE)] + mix(turn) * np.uint64(2)
    return mix(np.add.reduceat(value, start))


def piece_hashes(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The hash of the bytes from each start to the next, case and all."""
    out, edge = np.empty(len(start), np.uint64), 0
    while edge < len(start):
        to = max(int(np.searchsorted(start, start[edge] + STEP)), edge + 1)
        b = int(start[to]) if to < len(start) else len(data)
        out[edge:to] = _hashes(data[start[edge] : b], start[edge:to] - start[edge], _BYTE)
        edge = to
    return out


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of every ``k`` words in a row; ``len(hashes) - k + 1`` of them."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for i in range(1, k):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
        out += hashes[i : i + n]
    return mix(out)


def whole(hashes: np.ndarray) -> np.uint64:
    """The hash of a sequence of any length, apart from those of ``shingles``."""
    return mix(shingles(hashes, len(hashes)) ^ np.uint64(len(hashes)))[0]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers ``start, start + 1, ...`` of each range, one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


def list_column(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column whose row i has ``values[ends[i]:ends[i + 1]]``."""
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32), pa.int32()), pa.array(values, kind))
