"""Token counts of whole texts, exactly as a tokenizer library gives them.

Texts up to HUGE characters are encoded in chunks that provably don't touch (``_chunks``), each distinct chunk once.
Longer texts go by overlap resynchronisation: overlapping windows are encoded with offsets, and two neighbours are
spliced at a common token border that is proven stable: white space begins there after a solid character, both windows
have a border there, and both agree on every token from there to the last such place of the overlap. If no such border
exists the overlap is widened, up to the whole text.

Defined cases: null and empty texts have 0 bytes and 0 tokens; special strings in texts count as the library counts
them; a text without white space is encoded as one window; repeated rows are counted each for itself; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import quoted, ship
from . import _chunks as C
from . import _text as X

HUGE = 1 << 16
WINDOW = 1 << 14
OVERLAP = 1 << 9
WORD_VOCABULARY = "word_bpe_49k.json"

#: Ids and (start, end) offsets in characters of a text.
Offsets = Callable[[str], tuple[list[int], list[tuple[int, int]]]]


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file; a path stays as it is."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def library(path: str) -> Offsets:
    """The library that reads ``path``: tokenizers for .json, sentencepiece for .model."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)

        def pieces(text: str) -> tuple[list[int], list[tuple[int, int]]]:
            found = model.encode(text, return_type="proto").pieces
            char = np.append(0, np.cumsum(X.code_points(np.frombuffer(text.encode(), np.uint8))))  # its offsets are bytes
            return [p.id for p in found], [(int(char[p.begin]), int(char[p.end])) for p in found]

        return pieces
    tokenizer = load(path)

    def encoded(text: str) -> tuple[list[int], list[tuple[int, int]]]:
        out = tokenizer.encode(text, add_special_tokens=False)
        return out.ids, out.offsets

    return encoded


@lru_cache(maxsize=4)
def load(path: str):  # noqa: ANN201
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


_STABLE = regex.compile(r"(?<=[^\s\u0085 ])(?=[ \t\n\r])")


def _splice(text: str, low: int, high: int, left: tuple[np.ndarray, np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[int, int] | None:
    """Tokens of ``left`` before, and of ``right`` before, the first proven common border in text[low:high]; None without one.

    A window: ids, starts, ends in the text. Borders are those where every earlier token ends at or before the place and
    every later one starts at or after it.
    """
    places = np.array([m.start() for m in _STABLE.finditer(text, low + 1, high)], np.int64)
    if places.size < 2:
        return None

    def borders(window: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        _, starts, ends = window
        before = np.searchsorted(ends, places, "right")
        return before, (before == starts.size) | (starts[np.minimum(before, starts.size - 1)] >= places) if starts.size else before == 0

    (i, good_i), (j, good_j) = borders(left), borders(right)
    both = np.flatnonzero(good_i & good_j)
    if both.size < 2:
        return None
    last = both[-1]
    for k in both[:-1]:
        a, b = left[0][i[k] : i[last]], right[0][j[k] : j[last]]
        if a.size and a.size == b.size and (a == b).all() and (left[1][i[k] : i[last]] == right[1][j[k] : j[last]]).all():
            return int(i[k]), int(j[k])
    return None


def encode_huge(text: str, encode: Offsets, window: int = WINDOW, overlap: int = OVERLAP) -> list[int]:
    """Ids of a text, by windows spliced at proven stable borders."""

    def over(a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids, at = encode(text[a:b])
        at = np.array(at, np.int64).reshape(-1, 2) + a
        return np.array(ids, np.int64), at[:, 0], at[:, 1]

    if len(text) <= window:
        return list(encode(text)[0])
    out: list[int] = []
    begin, end = 0, window
    here, skip = over(begin, end), 0
    while end < len(text):
        width = overlap
        while True:
            start = max(begin, end - width)
            if start == begin:  # the overlap has become the window: take a longer one from the same, proven start
                end = min(len(text), begin + 2 * (end - begin))
                here = over(begin, end)
                if end == len(text):
                    break
                width = overlap
                continue
            stop = min(len(text), start + window + width)
            there = over(start, stop)
            cut = _splice(text, start, end, here, there)
            if cut:
                out += here[0][skip : cut[0]].tolist()
                begin, end, here, skip = start, stop, there, cut[1]
                break
            width *= 2
        if end == len(text):
            break
    return out + here[0][skip:].tolist()


class WordEncoder:
    """Ids of texts for the word vocabulary, block by block."""

    def __init__(self, path: str) -> None:
        self.tokenizer = load(path)
        self.specials = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.chunks = C.DistinctEncoder(self._encode)

    def _encode(self, chunks: list[bytes]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([c.decode() for c in chunks], add_special_tokens=False)]

    def block(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of each chunk in self.chunks, document of each chunk, tokens of each document)."""
        starts, ends = C.word_chunks(data, off, self.specials)
        shown = C.foldable(data)
        for a, b in C.specials_in(data, off, self.specials):
            shown[a:b] = data[a:b]
        place, doc = self.chunks.find(data, shown, starts, ends), X.doc_of(starts, off)
        return place, doc, np.bincount(doc, weights=self.chunks.counts[place], minlength=off.size - 1).astype(np.int64)

    def ids(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents of a block, and the number of each document; a giant document goes window by window."""
        return X.by_window(self._ids, data, off)

    def _ids(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place, _, counts = self.block(data, off)
        return self.chunks.spelled(place), counts


@lru_cache(maxsize=2)
def _word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _let_go() -> None:
    _word_encoder.cache_clear()
    library.cache_clear()
    load.cache_clear()


def word_encoder(path: str) -> WordEncoder:
    """The encoder that this worker keeps, with what it remembers, until another operator's task begins."""
    X.held("tokens", _let_go)
    return _word_encoder(path)


def counts(texts: pa.Array, path: str, huge: int = HUGE) -> np.ndarray:
    """Tokens of each text of a large_string array."""
    out = np.zeros(len(texts), np.int64)
    chunked = path.endswith(WORD_VOCABULARY)
    for a, b, data, off in X.blocks(texts):
        long = X.per_doc(X.code_points(data), off) > huge
        for k in np.flatnonzero(long):
            out[a + k] = len(encode_huge(texts[a + int(k)].as_py(), library(path)))
        if not chunked:
            for k in np.flatnonzero(~long):
                out[a + k] = len(library(path)(texts[a + int(k)].as_py())[0])
        elif not long.all():
            if long.any():
                rest = texts.slice(a, b - a).filter(pa.array(~long))
                data, off = X.raw(rest)
            out[a + np.flatnonzero(~long)] = word_encoder(path).block(data, off)[2]
    return out


def count_tokens(df: DataFrame, name: str = WORD_VOCABULARY, limit: int = 2048, key: str = "doc_id", text: str = "text", huge: int = HUGE) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of each row."""
    ship(df.sparkSession)
    path = vocabulary(name)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        X.begin("tokens")
        for batch in batches:
            texts = X.text_column(batch.column(1))
            n = counts(texts, path, huge)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(X.raw(texts)[1])), pa.array(n), pa.array(n > limit)], names=["key", "n_bytes", "n_tokens", "over_limit"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text")).mapInArrow(counted, f"`key` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean").withColumnRenamed("key", key)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
