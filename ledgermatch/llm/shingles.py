"""Vectorised word and shingle hashing for whole Arrow string columns.

Words are maximal runs of bytes other than space and \\t-\\r, after lower-casing A-Z; multi-byte UTF-8
sequences hold no such bytes, so byte runs and code-point runs agree.  A word's hash is a polynomial
over its bytes (mod 2**64) passed through a 64-bit finaliser; a shingle chains the hashes of its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[str, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n + 1:
        for key, base in (("up", _BASE), ("down", _BASE_INV)):
            steps = np.full(n + 1, base, dtype=np.uint64)
            steps[0] = 1
            _powers[key] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, int64 offsets) of a string column; a null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and each text's first word (int64, one more than texts)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    solid = ~_SPACE[data]
    begins = np.zeros(n + 1, dtype=bool)
    begins[offsets[offsets <= n]] = True
    prior = np.concatenate(([False], solid[:-1]))
    start = np.flatnonzero(solid & (~prior | begins[:n]))
    after = np.concatenate((solid[1:], [False]))
    end = np.flatnonzero(solid & (~after | begins[1:])) + 1
    up, down = _power(n)
    letters = (_LOWER[data] if lower else data).astype(np.uint64) + np.uint64(1)
    sums = np.concatenate(([np.uint64(0)], np.add.accumulate(letters * up[:n])))
    words = mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    return words, np.searchsorted(start, offsets).astype(np.int64)


def shingle_sets(column: pa.Array, width: int = 5, chunk_bytes: int = 1_000_000) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingle hashes (uint64).

    A text of fewer than ``width`` words has its whole word sequence as one shingle; one without words has none.
    """
    data, offsets = string_buffers(column)
    at, texts = 0, len(offsets) - 1
    while at < texts:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + chunk_bytes, side="right")) - 1)
        words, first = word_hashes(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        chained = np.full(max(0, len(words) - width + 1), np.uint64(width), dtype=np.uint64)
        for k in range(width):
            chained = mix64(chained * _BASE + words[k : k + len(chained)])
        for i in range(to - at):
            lo, hi = first[i], first[i + 1]
            if hi - lo >= width:
                own = np.sort(chained[lo : hi - width + 1])
                yield own[np.concatenate(([True], own[1:] != own[:-1]))]
            elif hi > lo:
                h = np.full(1, np.uint64(hi - lo), dtype=np.uint64)
                for k in range(lo, hi):
                    h = mix64(h * _BASE + words[k : k + 1])
                yield h
            else:
                yield np.zeros(0, np.uint64)
        at = to
