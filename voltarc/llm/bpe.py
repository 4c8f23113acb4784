"""Byte-level BPE encoding and decoding with batched numpy merge rounds.

Texts are cut into chunks that no token crosses, each distinct chunk is split by the vocabulary's public word pattern, and
the words of many chunks lie as symbols in one flat array. A round looks up the keys of all neighbouring pairs in the
sorted pair keys by binary search, finds the lowest rank of each word by a segmented minimum and applies that merge
wherever it occurs in the word; words without a mergeable pair leave the array.

Defined cases: null and empty texts have no tokens and decode to the empty text; the special string inside a text is its
special id, as the library has it; repeated rows are encoded each for itself; an empty table gives an empty result.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import quoted, ship
from . import _chunks as C
from . import _text as X
from .tokens import vocabulary

BYTE_VOCABULARY = "byte_bpe_50k.json"
#: The public word pattern of byte-level vocabularies of this kind (fixed value).
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_NONE = np.int64(1 << 40)
#: Symbols of a word from which on its merges are queued: a round over all its symbols for each merge would take too long.
LONG = 2000
#: Ids that are written or decoded at once.
PART = 1 << 20


def printable_bytes() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabulary files: itself if printable, else from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        of_char, ids = printable_bytes(), spec["model"]["vocab"]
        size = max([*ids.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.token_bytes: list[bytes] = [b""] * size
        for token, i in ids.items():
            self.token_bytes[i] = bytes(of_char[c] for c in token) if all(c in of_char for c in token) else token.encode()
        self.specials = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        for content, i in self.specials.items():
            self.token_bytes[i] = content
        self.byte_id = np.zeros(256, np.int64)
        for c, b in of_char.items():
            self.byte_id[b] = ids[c]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left = np.array([ids[a] for a, _ in merges], np.int64)
        right = np.array([ids[b] for _, b in merges], np.int64)
        keys = (left << 32) | right
        order = np.argsort(keys, kind="stable")
        self.pair_keys = keys[order]
        self.pair_rank = order.astype(np.int64)
        self.rank_id = np.array([ids[a + b] for a, b in merges], np.int64)
        self.flat, self.begin, self.length = _flat(self.token_bytes)
        self.digits, self.digits_begin, self.digits_length = _flat([b"%d," % i for i in range(size)])


def _flat(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    length = np.array([len(p) for p in parts], np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(length) - length, length


def merge_words(words: list[bytes], v: Vocabulary) -> list[np.ndarray]:
    """Ids of each word, by merge rounds over all words at once."""
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(words)
    long = [k for k, w in enumerate(words) if len(w) > LONG]
    for k in long:
        out[k] = merge_long(words[k], v)
    words = [b"" if len(w) > LONG else w for w in words] if long else words
    lengths = np.array([len(w) for w in words], np.int64)
    sym = v.byte_id[np.frombuffer(b"".join(words), np.uint8)]
    word = np.repeat(np.arange(len(words)), lengths)
    last = v.pair_keys.size - 1
    while sym.size:
        rank = np.full(sym.size, _NONE)
        if sym.size > 1:
            key = (sym[:-1] << 32) | sym[1:]
            at = np.minimum(np.searchsorted(v.pair_keys, key), last)
            good = (v.pair_keys[at] == key) & (word[:-1] == word[1:])
            rank[:-1][good] = v.pair_rank[at[good]]
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        lowest = np.minimum.reduceat(rank, first)
        size = np.diff(np.append(first, sym.size))
        done = lowest == _NONE
        for k in np.flatnonzero(done):
            out[word[first[k]]] = sym[first[k] : first[k] + size[k]]
        if done.all():
            break
        hit = (rank == np.repeat(lowest, size)) & (rank < _NONE)
        at = np.flatnonzero(hit)  # of overlapping hits every second one merges, from the left
        fresh = np.append(True, np.diff(at) > 1)
        run = np.maximum.accumulate(np.where(fresh, np.arange(at.size), 0))
        at = at[(np.arange(at.size) - run) % 2 == 0]
        sym[at] = v.rank_id[rank[at]]
        keep = ~np.repeat(done, size)
        keep[at + 1] = False
        sym, word = sym[keep], word[keep]
    return out


def merge_long(word: bytes, v: Vocabulary) -> np.ndarray:
    """Ids of one long word: its pairs wait in a heap by rank and place, found in the same sorted keys."""
    sym = v.byte_id[np.frombuffer(word, np.uint8)]
    key = (sym[:-1] << 32) | sym[1:]
    at = np.minimum(np.searchsorted(v.pair_keys, key), v.pair_keys.size - 1)
    known = np.flatnonzero(v.pair_keys[at] == key)
    queue = [(r, k, a, b) for r, k, a, b in zip(v.pair_rank[at[known]].tolist(), known.tolist(), sym[known].tolist(), sym[known + 1].tolist(), strict=True)]
    heapq.heapify(queue)
    sym = sym.tolist()
    after, before = list(range(1, len(sym) + 1)), list(range(-1, len(sym) - 1))
    keys, last = v.pair_keys, v.pair_keys.size

    def push(left: int, right: int) -> None:
        pair = (sym[left] << 32) | sym[right]
        place = bisect_left(keys, pair)
        if place < last and keys[place] == pair:
            heapq.heappush(queue, (int(v.pair_rank[place]), left, sym[left], sym[right]))

    while queue:
        rank, left, a, b = heapq.heappop(queue)
        right = after[left]
        if sym[left] != a or right >= len(sym) or sym[right] != b:
            continue  # one of them has been merged meanwhile
        sym[left], sym[right] = int(v.rank_id[rank]), -1
        after[left] = after[right]
        if after[left] < len(sym):
            before[after[left]] = left
            push(left, after[left])
        if before[left] >= 0:
            push(before[left], left)
    return np.array([s for s in sym if s >= 0], np.int64)


class Encoder:
    """Ids of texts, block by block."""

    def __init__(self, path: str) -> None:
        self.v = Vocabulary(path)
        self.chunks = C.DistinctEncoder(self._encode)

    def _encode(self, chunks: list[bytes]) -> list[np.ndarray]:
        words: list[bytes] = []
        of: list[int] = []
        for k, c in enumerate(chunks):
            if c in self.v.specials:
                of.append(-1)
                continue
            own = WORDS.findall(c.decode())
            words += [w.encode() for w in own]
            of.append(len(own))
        ids = merge_words(words, self.v)
        out, at = [], 0
        for c, n in zip(chunks, of, strict=True):
            if n < 0:
                out.append(np.array([self.v.specials[c]], np.int64))
            else:
                out.append(ids[at] if n == 1 else np.concatenate([np.zeros(0, np.int64), *ids[at : at + n]]))
                at += n
        return out

    def ids(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents of a block, and the number of each; a giant document goes window by window."""
        return X.by_window(self._ids, data, off)

    def _ids(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, ends = C.byte_chunks(data, off, list(self.v.specials))
        place = self.chunks.find(data, data, starts, ends)
        counts = np.bincount(X.doc_of(starts, off), weights=self.chunks.counts[place], minlength=off.size - 1).astype(np.int64)
        return self.chunks.spelled(place), counts

    def decoded(self, ids: np.ndarray) -> Iterator[bytes]:
        """The text of some ids in UTF-8, part by part; bytes that are none become U+FFFD."""
        reader = codecs.getincrementaldecoder("utf-8")("replace")
        for a in range(0, ids.size, PART):
            own = ids[a : a + PART]
            yield reader.decode(C.ragged(self.v.flat, self.v.begin[own], self.v.length[own]).tobytes()).encode()
        yield reader.decode(b"", True).encode()

    def written(self, ids: np.ndarray) -> Iterator[bytes]:
        """Ids in decimal, joined by commas, part by part."""
        for a in range(0, ids.size, PART):
            own = ids[a : a + PART]
            yield C.ragged(self.v.digits, self.v.digits_begin[own], self.v.digits_length[own])[: None if a + PART < ids.size else -1].tobytes()


def _sha256(parts: Iterator[bytes]) -> str:
    out = hashlib.sha256()
    for x in parts:
        out.update(x)
    return out.hexdigest()


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def encoder(path: str) -> Encoder:
    """The encoder that this worker keeps, with what it remembers, until another operator's task begins."""
    X.held("bpe", _encoder.cache_clear)
    return _encoder(path)


def round_trip(df: DataFrame, name: str = BYTE_VOCABULARY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of each row."""
    ship(df.sparkSession)
    path = vocabulary(name)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        X.begin("bpe")
        e = encoder(path)
        for batch in batches:
            n_tokens, ids_hex, text_hex = [], [], []
            for _, _, data, off in X.blocks(X.text_column(batch.column(1)), X.BLOCK_BYTES // 2):
                ids, counts = e.ids(data, off)
                n_tokens.append(counts)
                for own in np.split(ids, np.cumsum(counts)[:-1]):
                    ids_hex.append(_sha256(e.written(own)))
                    text_hex.append(_sha256(e.decoded(own)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([np.zeros(0, np.int64), *n_tokens])), pa.array(ids_hex, pa.string()), pa.array(text_hex, pa.string())], names=["key", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text")).mapInArrow(coded, f"`key` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string").withColumnRenamed("key", key)


def encode_texts(texts: list[str | None], name: str = BYTE_VOCABULARY) -> list[list[int]]:
    """Ids of each text, as the library's encode gives them without added special tokens."""
    e, out = encoder(vocabulary(name)), []
    for _, _, data, off in X.blocks(X.text_column(pa.array(texts, pa.string()))):
        ids, counts = e.ids(data, off)
        out += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    return out


def decode_ids(ids: list[list[int]], name: str = BYTE_VOCABULARY) -> list[str]:
    e = encoder(vocabulary(name))
    return [b"".join(e.decoded(np.array(x, np.int64))).decode() for x in ids]


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"))
