"""Cuts of texts where a tokenizer provably can't merge across, and encoding of each distinct chunk once.

Both vocabularies split a text by a pattern before any merge, so a cut at a certain token border changes nothing:
chunks can be encoded alone, and equal chunks have equal ids. Cuts are placed only where the classes of the two bytes
beside them prove the border; everything doubtful (other scripts, combining marks, apostrophes) stays inside a chunk and
is left to the library.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa

from . import _text as X

SPACE, LETTER, DIGIT, SYMBOL, OTHER = range(5)
_CLASS = np.full(256, SYMBOL, np.uint8)
_CLASS[128:] = OTHER
_CLASS[48:58] = DIGIT
_CLASS[65:91] = _CLASS[97:123] = LETTER
_CLASS[[0x20, 9, 10, 11, 12, 13]] = SPACE


def classes(data: np.ndarray) -> np.ndarray:
    """Class of each byte; U+00C0 to U+017F are letters, both bytes, but for two signs and U+0130, which lowers to two characters."""
    kind = _CLASS[data]
    lead = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC5)) if data.size > 1 else np.zeros(0, np.int64)
    second = data[lead + 1]
    sign = (data[lead] == 0xC3) & ((second == 0x97) | (second == 0xB7))
    lead = lead[~sign & ~((data[lead] == 0xC4) & (second == 0xB0))]
    kind[lead] = LETTER
    kind[lead + 1] = LETTER
    return kind


def specials_in(data: np.ndarray, off: np.ndarray, specials: Sequence[bytes]) -> list[tuple[int, int]]:
    """Spans of the special strings, none across two documents."""
    whole, found = data.tobytes(), []
    for s in specials:
        at = whole.find(s)
        while at >= 0:
            if X.doc_of(np.array([at]), off)[0] == X.doc_of(np.array([at + len(s) - 1]), off)[0]:
                found.append((at, at + len(s)))
            at = whole.find(s, at + 1)
    return sorted(found)


def _placed(cut: np.ndarray, data: np.ndarray, off: np.ndarray, specials: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    cut[0] = True
    cut[off[(off > 0) & (off < data.size)]] = True
    for a, b in specials_in(data, off, specials):
        cut[a + 1 : b] = False
        cut[a] = True
        if b < cut.size:
            cut[b] = True
    starts = np.flatnonzero(cut)
    return starts, np.append(starts[1:], data.size)


def word_chunks(data: np.ndarray, off: np.ndarray, specials: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Chunks for a vocabulary that drops white space and splits into letter runs, single digits and other runs."""
    if not data.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = classes(data)
    prev, cur = kind[:-1], kind[1:]
    cut = np.zeros(data.size, bool)
    cut[1:] = (prev == SPACE) | (cur == SPACE)
    cut[1:] |= (prev == LETTER) & ((cur == DIGIT) | (cur == SYMBOL))
    cut[1:] |= (prev == DIGIT) & (cur != OTHER)
    cut[1:] |= (prev == SYMBOL) & ((cur == DIGIT) | ((cur == LETTER) & (data[:-1] != 39)))
    starts, ends = _placed(cut, data, off, specials)
    solid = kind[starts] != SPACE
    return starts[solid], ends[solid]


def byte_chunks(data: np.ndarray, off: np.ndarray, specials: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Chunks for a byte-level vocabulary whose words carry the white space before them."""
    if not data.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = classes(data)
    prev, cur = kind[:-1], kind[1:]
    cut = np.zeros(data.size, bool)
    solid = (prev == LETTER) | (prev == DIGIT) | (prev == SYMBOL)
    cut[1:] = solid & (cur == SPACE)
    cut[1:] |= (prev == LETTER) & ((cur == DIGIT) | (cur == SYMBOL))
    cut[1:] |= (prev == DIGIT) & ((cur == LETTER) | (cur == SYMBOL))
    cut[1:] |= (prev == SYMBOL) & ((cur == DIGIT) | ((cur == LETTER) & (data[:-1] != 39)))
    return _placed(cut, data, off, specials)


def ragged(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """flat[starts[0]:starts[0]+counts[0]], flat[starts[1]:...] and so on, in one array."""
    total = int(counts.sum())
    if not total:
        return flat[:0]
    before = np.cumsum(counts) - counts
    return flat[np.repeat(starts - before, counts) + np.arange(total)]


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values, where each is found, and the place of every value among them; by a hash table, then a short sort."""
    coded = pa.array(values).dictionary_encode()
    found, which = coded.dictionary.to_numpy(), coded.indices.to_numpy()
    some = np.zeros(found.size, np.int64)
    some[which] = np.arange(which.size)
    order = np.argsort(found)
    place = np.empty(found.size, np.int64)
    place[order] = np.arange(found.size)
    return found[order], some[order], place[which]


class DistinctEncoder:
    """Ids of chunks, each distinct chunk encoded once while the bounded memory of a worker lasts.

    ``encode`` turns a list of byte strings into a list of id sequences. ``MOST`` chunks are remembered, about 30 bytes
    each; when they are full, the half that was met in the fewest blocks goes.
    """

    MOST = 1 << 19

    def __init__(self, encode: Callable[[list[bytes]], list[Sequence[int]]]) -> None:
        self.encode = encode
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.starts = np.zeros(0, np.uint32)
        self.counts = np.zeros(0, np.int32)
        self.met = np.zeros(0, np.uint16)
        self.ids = np.zeros(0, np.int32)

    def sweep(self) -> None:
        """Keep the half that was met most often; what was met long ago counts less from now on."""
        half = self.MOST // 2
        kept = np.sort(np.argpartition(self.met, self.met.size - half)[self.met.size - half :]) if self.met.size > half else np.arange(self.met.size)
        counts = self.counts[kept]
        self.ids = ragged(self.ids, self.starts[kept].astype(np.int64), counts.astype(np.int64))
        self.starts = (np.cumsum(counts, dtype=np.int64) - counts).astype(np.uint32)
        self.keys, self.counts, self.met = self.keys[kept], counts, self.met[kept] // 2

    def find(self, data: np.ndarray, shown: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Place of each chunk in ``starts`` and ``counts``. ``shown``: the bytes by which chunks are told apart."""
        hashes, first, which = _distinct(X.span_hashes(shown, starts, ends))
        if self.keys.size and self.keys.size + hashes.size > self.MOST:
            self.sweep()
        at, known = self._known(hashes)
        self.met[at[known]] += self.met[at[known]] < 65535
        new = np.flatnonzero(~known)
        if new.size:
            whole = shown.tobytes()
            found = self.encode([whole[a:b] for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)])
            counts = np.fromiter(map(len, found), np.int64, len(found))
            if self.ids.size + int(counts.sum()) >= 1 << 32:
                self.forget()
                return self.find(data, shown, starts, ends)
            ids = np.fromiter(chain.from_iterable(found), np.int32, int(counts.sum()))
            begin = self.ids.size + np.cumsum(counts) - counts
            self.ids = np.concatenate([self.ids, ids])
            self.starts = np.insert(self.starts, at[new], begin.astype(np.uint32))
            self.counts = np.insert(self.counts, at[new], counts.astype(np.int32))
            self.met = np.insert(self.met, at[new], 1)
            self.keys = np.insert(self.keys, at[new], hashes[new])
            at = np.searchsorted(self.keys, hashes)
        return at[which]

    def _known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, hashes)
        known = np.zeros(hashes.size, bool)
        inside = at < self.keys.size
        known[inside] = self.keys[at[inside]] == hashes[inside]
        return at, known

    def spelled(self, place: np.ndarray) -> np.ndarray:
        """The ids of chunks one after another."""
        return ragged(self.ids, self.starts[place].astype(np.int64), self.counts[place].astype(np.int64))


def foldable(data: np.ndarray) -> np.ndarray:
    """ASCII capitals lowered, but not before a character that may combine with them."""
    low = X.ascii_lowered(data)
    if data.size > 1:
        risky = np.flatnonzero(_CLASS[data[1:]] == OTHER)
        risky = risky[(data[risky + 1] < 0xC3) | (data[risky + 1] > 0xC5)]
        low[risky] = data[risky]
    return low
