"""Vectorised text primitives over Arrow string columns: byte blocks, spans and span hashes.

A block is the UTF-8 bytes of some whole documents back to back with their offsets; nothing here makes a Python string.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19
#: Longer runs of bytes are worked on in windows, so that no array of wide numbers is as long as a giant text.
WINDOW_BYTES = 8 * BLOCK_BYTES

_rng = np.random.default_rng(0x5EED)
_BYTE_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: The separators of a word: U+0020 and U+0009 to U+000D.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 9, 10, 11, 12, 13]] = True
_PLAIN = np.zeros(256, bool)
_PLAIN[48:58] = _PLAIN[65:91] = _PLAIN[97:123] = True


#: What operators keep in a worker between tasks: a name, and what lets go of it.
_HELD: dict[str, Callable[[], None]] = {}


def held(name: str, let_go: Callable[[], None]) -> None:
    _HELD[name] = let_go


def begin(name: str = "") -> None:
    """At the start of a task of an operator: let go of what others have left in this worker, which Spark uses again."""
    left = [k for k in _HELD if k != name]
    for k in left:
        _HELD.pop(k)()
    if left:
        gc.collect()
        with contextlib.suppress(AttributeError, OSError):  # only the GNU library has it
            ctypes.CDLL(None).malloc_trim(0)


def text_column(values: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One large_string array without nulls; a null text counts as empty."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
        if isinstance(values, pa.ChunkedArray):
            values = pa.concat_arrays(values.chunks) if values.num_chunks else pa.array([], values.type)
    return values.cast(pa.large_string()).fill_null("")


def raw(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a large_string array, offsets from 0."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = values.buffers()
    off = np.frombuffer(offsets, np.int64, len(values) + 1, values.offset * 8)
    end = int(off[-1])
    flat = np.frombuffer(data, np.uint8, end)[int(off[0]) :] if end else np.zeros(0, np.uint8)
    return flat, off - off[0]


def blocks(values: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of rows with about ``limit`` bytes; a longer row stands alone."""
    data, off = raw(values)
    first, n = 0, len(values)
    while first < n:
        last = max(first + 1, int(np.searchsorted(off, off[first] + limit, "right")) - 1)
        yield first, last, data[off[first] : off[last]], off[first : last + 1] - off[first]
        first = last


def per_doc(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Number of True in each document."""
    if flags.size > WINDOW_BYTES:
        return np.array([np.count_nonzero(flags[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)], np.int64)
    total = np.zeros(flags.size + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def windows(data: np.ndarray, limit: int = WINDOW_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of about ``limit`` bytes of one text, each cut before a blank that follows a letter or digit of ASCII.

    Neither words nor the chunks of the tokenizers go across such a place. A text without one is a single window.
    """
    at = 0
    while data.size - at > limit:
        cut = at + limit
        while cut < data.size:
            part, before = data[cut : cut + limit], data[cut - 1 : cut + limit - 1][: data.size - cut]
            found = np.flatnonzero(SEPARATOR[part] & _PLAIN[before])
            if found.size:
                cut += int(found[0])
                break
            cut += limit
        if cut >= data.size:
            break
        yield at, cut
        at = cut
    yield at, data.size


def code_points(data: np.ndarray) -> np.ndarray:
    """True at the first byte of each code point."""
    return (data & 0xC0) != 0x80


def spans(mask: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, cut at document borders."""
    if not mask.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = mask.copy(), mask.copy()
    first[1:] &= ~mask[:-1]
    last[:-1] &= ~mask[1:]
    inner = off[(off > 0) & (off < mask.size)]
    first[inner] = mask[inner]
    last[inner - 1] = mask[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def doc_of(positions: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The document that holds each byte position."""
    return np.searchsorted(off, positions, "right") - 1


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the public splitmix64 one)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def by_window(of: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``of`` a block: values of its documents one after another, and their numbers; giant documents go window by window."""
    if data.size <= WINDOW_BYTES:
        return of(data, off)
    found, counts = [], np.zeros(off.size - 1, np.int64)
    for k, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True)):
        for x, y in windows(data[a:b]):
            values, n = of(data[a + x : a + y], np.array([0, y - x]))
            found.append(values)
            counts[k] += n[0]
    return np.concatenate(found), counts


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span: differences of one running polynomial, shifted to position 0 by the base's inverse.

    Spans are in order and don't overlap; far ones are hashed in groups of about WINDOW_BYTES.
    """
    if data.size <= WINDOW_BYTES:
        return _near_hashes(data, starts, ends)
    out, first = np.empty(starts.size, np.uint64), 0
    while first < starts.size:
        a = int(starts[first])
        last = max(first + 1, int(np.searchsorted(ends, a + WINDOW_BYTES, "right")))
        b = int(ends[last - 1])
        out[first:last] = _near_hashes(data[a:b], starts[first:last] - a, ends[first:last] - a) if b - a <= WINDOW_BYTES else _long_hash(data[a:b])
        first = last
    return out


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, n at least."""
    if _powers[0].size < n:
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            p = np.full(max(n, BLOCK_BYTES + (1 << 16)), base, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def _near_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    n = data.size + 1
    up, down = _tables(n)
    total = np.zeros(n, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[: n - 1], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64))


def _long_hash(data: np.ndarray) -> np.uint64:
    """The same hash of one long span, a block after another."""
    up, _ = _tables(BLOCK_BYTES)
    h = 0
    for a in range(0, data.size, BLOCK_BYTES):
        part = data[a : a + BLOCK_BYTES]
        h += int((_BYTE_VALUES[part] * up[: part.size]).sum(dtype=np.uint64)) * pow(int(_BASE), a, 1 << 64)
    return mix(np.array([(h + data.size) % (1 << 64)], np.uint64))[0]


#: Lower case of A-Z; of the two-byte Latin-1 capitals, in lowered().
_ASCII_LOWER = np.arange(256, dtype=np.uint8)
_ASCII_LOWER[65:91] += 32


def ascii_lowered(data: np.ndarray) -> np.ndarray:
    return _ASCII_LOWER[data]


def lowered(data: np.ndarray) -> np.ndarray:
    """Lower case of ASCII and Latin-1 letters; other scripts stay as they are."""
    out = _ASCII_LOWER[data]
    if out.size > 1:
        second = out[1:]
        capital = (data[:-1] == 0xC3) & (second >= 0x80) & (second <= 0x9E) & (second != 0x97)
        second[capital] += 32
    return out


def ngram_hashes(words: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window of n words inside one document, and the index of its first word."""
    m = words.size - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.zeros(m, np.uint64)
    for k in range(n):
        h = mix(h * np.uint64(0x100000001B3) + words[k : k + m])
    first = np.flatnonzero(doc[:m] == doc[n - 1 :])
    return h[first], first
