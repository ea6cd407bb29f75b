"""Suffix arrays of many short strings by induced sorting, and their permuted common prefixes, in whole-array numpy.

The strings are joined, each ended by a separator of its own (smaller than any byte), so no order or common prefix runs past
an end.  Induced sorting is linear; here each bucket's suffixes are induced in one array step, or in one
for each repeat of its byte, instead of one by one.
"""

from __future__ import annotations

import numpy as np

from ledgermatch.llm.shingles import mix64

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def join_strings(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, first symbol of each string).  Bytes count from len(strings); separators descend, the last is 0."""
    m = len(strings)
    sizes = np.array([len(x) for x in strings], dtype=np.int64)
    first = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    text = np.empty(int(sizes.sum()) + m, dtype=np.int32)
    inside = np.ones(len(text), dtype=bool)
    ends = first + sizes
    inside[ends] = False
    text[inside] = np.frombuffer(b"".join(strings), dtype=np.uint8).astype(np.int32) + m
    text[ends] = np.arange(m - 1, -1, -1)
    return text, first


def _types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one."""
    n = len(text)
    change = np.flatnonzero(text[:-1] != text[1:])
    # the first place from here on where the symbol changes tells the order
    at = change[np.minimum(np.searchsorted(change, np.arange(n)), max(0, len(change) - 1))] if len(change) else np.zeros(n, np.int64)
    small = np.zeros(n, dtype=bool)
    if len(change):
        known = np.arange(n) <= change[-1]
        small[known] = text[at[known]] < text[at[known] + 1]
    small[-1] = True
    return small


class _Sorter:
    """Induces the order of all suffixes from that of the leftmost smaller ones."""

    def __init__(self, text: np.ndarray, m: int) -> None:
        self.text, self.m = text, m
        self.small = _types(text)
        self.leftmost = np.flatnonzero(self.small[1:] & ~self.small[:-1]) + 1
        inner = text >= m
        self.code = np.where(inner, text - m, 0).astype(np.uint8)
        self.inner = inner
        count = np.bincount(self.code[inner], minlength=256)
        self.end = np.cumsum(count)
        self.start = self.end - count
        large = np.bincount(self.code[inner & ~self.small], minlength=256)
        self.middle = self.start + large  # larger suffixes of a byte come before its smaller ones
        self.separators = np.flatnonzero(~inner)[::-1]

    def _put(self, order: np.ndarray, at: np.ndarray, found: np.ndarray, forward: bool) -> None:
        """Writes suffixes, in the order given, at the heads (or tails) of their bytes' buckets."""
        code = self.code[found]
        by = np.argsort(code, kind="stable")
        code = code[by]
        count = np.bincount(code, minlength=256)
        rank = np.arange(len(code)) - (np.cumsum(count) - count)[code]
        if forward:
            order[at[code] + rank] = found[by]
            at += count
        else:
            order[at[code] - 1 - rank] = found[by]
            at -= count

    def induce(self, leftmost: np.ndarray) -> np.ndarray:
        """Order of all suffixes that begin with a byte, from the leftmost smaller ones in their order."""
        order = np.full(int(self.end[-1]), -1, dtype=np.int64)
        own = leftmost[self.inner[leftmost]]
        by_code = np.argsort(self.code[own], kind="stable")
        own = own[by_code]
        edge = np.searchsorted(self.code[own], np.arange(257))
        head = self.start.copy()

        def before(found: np.ndarray, small: bool) -> np.ndarray:
            found = found[found > 0] - 1
            return found[self.inner[found] & (self.small[found] == small)]

        # larger suffixes, ascending: from separators, then byte by byte
        self._put(order, head, before(leftmost[~self.inner[leftmost]], False), True)
        for c in range(256):
            if self.start[c] == self.end[c]:
                continue
            done = int(self.start[c])
            while done < head[c]:
                now, done = order[done : head[c]], int(head[c])
                self._put(order, head, before(now, False), True)
            if edge[c + 1] > edge[c]:
                self._put(order, head, before(own[edge[c] : edge[c + 1]], False), True)
        # smaller suffixes, descending
        tail = self.end.copy()
        for c in range(255, -1, -1):
            if self.start[c] == self.end[c]:
                continue
            done = int(self.end[c])
            while done > tail[c]:
                now, done = order[tail[c] : done][::-1], int(tail[c])
                self._put(order, tail, before(now, True), False)
            if self.middle[c] > self.start[c]:
                self._put(order, tail, before(order[self.start[c] : self.middle[c]][::-1], True), False)
        return order

    def sort_leftmost(self) -> np.ndarray:
        """The leftmost smaller suffixes in order: their substrings are sorted and named, and the string of names is sorted in turn."""
        p = self.leftmost
        if len(p) < 2:
            return p
        order = self.induce(np.concatenate((self.separators[np.isin(self.separators, p)], p[self.inner[p]])))
        mark = np.zeros(len(self.text), dtype=bool)
        mark[p] = True
        ordered = np.concatenate((self.separators[mark[self.separators]], order[mark[order]]))
        # substrings up to the next leftmost one, with their types, are equal if their hashes and lengths are
        up = np.full(len(self.text) + 1, _BASE, dtype=np.uint64)
        up[0] = 1
        up = np.multiply.accumulate(up)
        symbol = self.text.astype(np.uint64) * np.uint64(2) + self.small + np.uint64(1)
        sums = np.concatenate(([np.uint64(0)], np.add.accumulate(symbol * up[:-1])))
        down = np.full(len(self.text) + 1, _INVERSE, dtype=np.uint64)
        down[0] = 1
        down = np.multiply.accumulate(down)
        stop = np.minimum(np.concatenate((p[1:], [len(self.text) - 1])) + 1, len(self.text))
        name_of = np.zeros(len(self.text), dtype=np.uint64)
        name_of[p] = mix64((sums[stop] - sums[p]) * down[p] + (stop - p).astype(np.uint64))
        new = np.concatenate(([True], name_of[ordered[1:]] != name_of[ordered[:-1]]))
        name = np.zeros(len(self.text), dtype=np.int64)
        name[ordered] = np.cumsum(new) - 1
        return p[_order_of_names(name[p])]


def _order_of_names(name: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names, by ranks over doubling lengths: the names are too many for buckets."""
    n, step = len(name), 1
    while True:
        next_name = np.concatenate((name[step:] + 1, np.zeros(min(step, n), np.int64)))
        keys, name = np.unique(name * (n + 2) + next_name, return_inverse=True)
        if len(keys) == n or step >= n:
            return np.argsort(name, kind="stable")
        step *= 2


def suffix_array(text: np.ndarray, m: int) -> np.ndarray:
    """Suffixes that begin with a byte, in order; ``m`` strings are joined in ``text``."""
    s = _Sorter(text, m)
    return s.induce(s.sort_leftmost())


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Permuted common prefixes: for each place, how much its suffix shares with the one before it in order.

    Where the bytes before both suffixes agree, a prefix is one shorter than that of the place before; the rest, whose sum is
    small, are compared.
    """
    n = len(text)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, dtype=np.int64)
    has = before >= 0
    place = np.arange(n)
    agrees = has & (place > 0) & (before > 0)
    agrees[agrees] = text[place[agrees] - 1] == text[before[agrees] - 1]
    agrees[1:] &= has[:-1]
    agrees[0] = False
    at = np.flatnonzero(has & ~agrees)
    other, length = before[at], np.zeros(len(at), np.int64)
    padded = np.concatenate((text, np.full(32, -1, text.dtype)))
    live = np.arange(len(at))
    steps = np.arange(16)
    while len(live):
        a, b = at[live] + length[live], other[live] + length[live]
        same = padded[a[:, None] + steps] == padded[b[:, None] + steps]
        run = np.where(same.all(axis=1), 16, np.argmin(same, axis=1))
        length[live] += run
        live = live[run == 16]
    shared[at] = length
    # a chain of agreeing places falls by one from its head
    head = np.maximum.accumulate(np.where(agrees, 0, place))
    return np.where(has, np.maximum(0, shared[head] - (place - head)), 0)
