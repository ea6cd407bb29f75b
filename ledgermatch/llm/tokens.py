"""Whole texts to token ids with the tokenizers library, remembering the ids of words.

The library spends most of its time on words it has seen before.  Texts are therefore cut, a column at a time, at places
that no token spans for either tokenizer used here (before a space, around a line break, between letters, digits and
punctuation; never at an apostrophe, where contractions are), the distinct pieces are encoded once, and ids are
gathered.  A piece of Latin letters or of punctuation goes straight to the BPE model, any other through the library's
whole pipeline.  A text with characters outside printable ASCII, Latin-1 letters and single spaces or line breaks goes
through the whole pipeline too.  A worker remembers at most ``MEMO`` pieces and then starts afresh.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from ledgermatch.llm.shingles import string_buffers

#: Pieces a worker remembers.
MEMO = 350_000
#: Bytes of text that are cut at a time.
CHUNK = 3_000_000

_SPACE, _LINE, _LETTER, _PUNCTUATION, _DIGIT, _APOSTROPHE, _OTHER = range(7)
_CLASS = np.full(256, _OTHER, dtype=np.uint8)
_CLASS[33:127] = _PUNCTUATION
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASS[32], _CLASS[10], _CLASS[39] = _SPACE, _LINE, _APOSTROPHE
_PLAIN = re.compile("( ?)([A-Za-zÀ-ÖØ-öø-ÿ]+|[!-&(-/:-@\\[-`{-~]+)")


def _byte_letters() -> list[str]:
    """The printable character that byte-level BPE uses for each byte: itself where printable, else the next from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in shown else next(others)) for b in range(256)]


class Encoder:
    """``lower`` says that the tokenizer lower-cases and drops white space (``word_bpe``); otherwise it is byte-level with
    spaces kept (``byte_bpe``).  Special tokens' strings in a text are ordinary text."""

    def __init__(self, path: str, lower: bool) -> None:
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.model = self.whole.model
        self.lower = lower
        self.letters = _byte_letters()
        self.size = self.whole.get_vocab_size()
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.new: list[list[int]] = []

    def ids(self, text: str) -> list[int]:
        return self.whole.encode(text, add_special_tokens=False).ids

    def _learn(self, piece: str) -> int:
        if m := _PLAIN.fullmatch(piece):
            word = m[2].lower() if self.lower else piece
            made = [t.id for t in self.model.tokenize("".join(map(self.letters.__getitem__, word.encode())))]
        else:
            made = self.ids(piece)
        self.known[piece] = at = len(self.ends) - 1 + len(self.new)
        self.new.append(made)
        return at

    def _table(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all known pieces in one array, and where each piece's end."""
        if self.new:
            self.ends = np.concatenate((self.ends, self.ends[-1] + np.cumsum([len(x) for x in self.new])))
            self.flat = np.concatenate((self.flat, np.array([i for x in self.new for i in x], dtype=np.uint32)))
            self.new = []
        return self.ends, self.flat

    def _simple(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Classes of all bytes; which texts hold only what the cuts are right for."""
        kind = _CLASS[data]
        lead = np.flatnonzero(data[:-1] == 0xC3)
        tail = data[lead + 1]
        lead = lead[(tail != 0x97) & (tail != 0xB7)]
        kind[lead] = kind[lead + 1] = _LETTER
        odd = kind == _OTHER
        blank = kind <= _LINE
        odd[1:] |= blank[1:] & blank[:-1]
        upto = np.concatenate(([0], np.cumsum(odd)))
        return kind, upto[offsets[1:]] == upto[offsets[:-1]]

    def _cut(self, kind: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where pieces begin, and the end."""
        n = len(kind)
        first = np.zeros(n + 1, dtype=bool)
        before, here = kind[:-1], kind[1:]
        first[1:n] = (here <= _LINE) | (before == _LINE) | ((before != here) & (before != _SPACE) & (before != _APOSTROPHE) & (here != _APOSTROPHE))
        first[offsets] = True
        first[n] = True
        return np.flatnonzero(first)

    def encode(self, column: pa.Array) -> Iterator[np.ndarray]:
        """For each text its ids (uint32); none for a null or empty text."""
        data, offsets = string_buffers(column)
        at, texts = 0, len(offsets) - 1
        while at < texts:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, side="right")) - 1)
            yield from self._encode(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
            at = to

    def _encode(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
        none = np.zeros(0, np.uint32)
        if not len(data):
            yield from [none] * (len(offsets) - 1)
            return
        kind, simple = self._simple(data, offsets)
        starts = self._cut(kind, offsets)
        text = np.searchsorted(offsets, starts[:-1], side="right") - 1
        use = simple[text]
        pieces = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), pa.py_buffer(np.ascontiguousarray(data)))
        if not use.all():
            pieces, text = pieces.filter(pa.array(use)), text[use]
        coded = pieces.dictionary_encode()
        if len(self.known) > MEMO:
            self._forget()
        known, learn = self.known.get, self._learn
        slots = np.array([learn(p) if (k := known(p)) is None else k for p in coded.dictionary.to_numpy(zero_copy_only=False)], dtype=np.int64)
        ends, flat = self._table()
        slot = slots[coded.indices.to_numpy()] if len(slots) else np.zeros(0, np.int64)
        count = ends[slot + 1] - ends[slot]
        total = np.concatenate(([0], np.cumsum(count)))
        ids = flat[np.repeat(ends[slot] - total[:-1], count) + np.arange(total[-1])]
        bounds = total[np.searchsorted(text, np.arange(len(offsets)))]
        for i in range(len(offsets) - 1):
            if simple[i]:
                yield ids[bounds[i] : bounds[i + 1]]
            else:
                yield np.array(self.ids(bytes(data[offsets[i] : offsets[i + 1]]).decode()), dtype=np.uint32)


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, lower: bool) -> Encoder:
    """One for each file in a worker process."""
    if (path, lower) not in _encoders:
        _encoders[path, lower] = Encoder(path, lower)
    return _encoders[path, lower]
