"""Tokenizer operators against the libraries themselves."""

import hashlib
import time

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from voltarc.llm import _text as X
from voltarc.llm import bpe, tokens

WORD = tokens.vocabulary(tokens.WORD_VOCABULARY)
BYTE = tokens.vocabulary(bpe.BYTE_VOCABULARY)
PIECE = tokens.vocabulary("piece_bpe_32k.model")
HARD = [
    "", " ", "\n\n  a", "don't 'tis I've we'LL !'s 'S", "J̌́ é Éx ́", "x<|endoftext|>y <|startoftext|> <|endoftext|", "a  b c\u0085 d",
    "ÀÉ×÷ßſ İI ΑΣ 漢字 日本語", "1234 12a3 ½ ٣ a1'2", "aaaa aaaaaaa !!!!???", "tab\t\tnew\r\nline \x1c x", "🙂🙂 👩‍👩‍👧 ok", "<|endoftext|><|endoftext|>", "trailing   ", "Ǆ ǆ Ḱ k",
]
TEXTS = st.text(alphabet=st.sampled_from(list("abAB'stve 12.!\n\t<|>é×ÇJ̌́   漢🙂ſİ")), max_size=40)


def word_counts(texts):
    return tokens.counts(X.text_column(pa.array(texts, pa.string())), WORD).tolist()


def test_hard_texts_have_the_library_s_ids():
    lib = tokens.load(BYTE)
    assert bpe.encode_texts(HARD) == [lib.encode(t, add_special_tokens=False).ids for t in HARD]
    assert bpe.decode_ids(bpe.encode_texts(HARD)) == HARD
    word = tokens.load(WORD)
    data, off = X.raw(X.text_column(pa.array(HARD)))
    ids, counts = tokens.WordEncoder(WORD).ids(data, off)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [word.encode(t, add_special_tokens=False).ids for t in HARD]


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=6))
def test_any_texts_have_the_library_s_ids(texts):
    lib, word = tokens.load(BYTE), tokens.load(WORD)
    assert bpe.encode_texts(texts) == [lib.encode(t, add_special_tokens=False).ids for t in texts]
    assert word_counts(texts) == [len(word.encode(t, add_special_tokens=False).ids) for t in texts]


def test_long_words_have_the_library_s_ids():
    rng = np.random.default_rng(11)
    lib = tokens.load(BYTE)
    for letters in ("ab", "etaoinshrdlu", "aé漢🙂", "x"):
        for n in (bpe.LONG + 1, 20_000):
            word = "".join(rng.choice(list(letters), n))
            assert bpe.encode_texts([word, "short " + word]) == [lib.encode(t, add_special_tokens=False).ids for t in (word, "short " + word)]
    words = [bytes(rng.choice(list(b"theringaoust"), int(n)).tolist()) for n in rng.integers(1, 60, 200)]
    v = bpe.encoder(BYTE).v
    assert [x.tolist() for x in map(lambda w: bpe.merge_long(w, v), words)] == [x.tolist() for x in bpe.merge_words(words, v)]
    began = time.perf_counter()
    bpe.encode_texts(["".join(rng.choice(list("etaoinshrdlu"), 200_000))])
    assert time.perf_counter() - began < 20


def test_giant_texts_in_windows(monkeypatch):
    rng = np.random.default_rng(12)
    text = "".join(str(rng.choice(["the", "Größe", "don't", "1234", "...", "\n\n", "  ", "x" * 90, "漢字かな", "<|endoftext|>", "é"])) + str(rng.choice([" ", "", "\n"])) for _ in range(3000))
    lib, word = tokens.load(BYTE), tokens.load(WORD)
    data, off = X.raw(X.text_column(pa.array([text, "a b"])))
    e = tokens.WordEncoder(WORD)
    whole = e.ids(data, off)[0].tolist()
    starts, ends = X.spans(~X.SEPARATOR[data], off)
    hashes = X.span_hashes(data, starts, ends)
    one = X.span_hashes(data, np.array([0]), np.array([data.size]))
    monkeypatch.setattr(X, "WINDOW_BYTES", 500)
    monkeypatch.setattr(X, "BLOCK_BYTES", 100)
    monkeypatch.setattr(bpe, "PART", 7)
    assert (X.span_hashes(data, starts, ends) == hashes).all() and X.span_hashes(data, np.array([0]), np.array([data.size])) == one
    assert len(list(X.windows(data, 500))) > 10
    assert e.ids(data, off)[0].tolist() == whole == word.encode(text, add_special_tokens=False).ids + word.encode("a b", add_special_tokens=False).ids
    assert bpe.encode_texts([text, "a b"]) == [lib.encode(t, add_special_tokens=False).ids for t in (text, "a b")]
    assert bpe.decode_ids(bpe.encode_texts([text])) == [text]
    coder, ids = bpe.encoder(BYTE), np.array(lib.encode(text, add_special_tokens=False).ids)
    assert b"".join(coder.written(ids)).decode() == ",".join(map(str, ids.tolist()))


@pytest.mark.parametrize("path", [WORD, BYTE, PIECE])
def test_windows_splice_to_the_whole_encoding(path):
    rng = np.random.default_rng(3)
    parts = ["the", "Größe", "don't", "1234", "...", "\n\n", "  ", "x" * 90, "漢字かな", "<|endoftext|>", "é"]
    lib = tokens.library(path)
    for n in (1, 40, 900):
        text = "".join(rng.choice(parts) + rng.choice([" ", "", "\n"]) for _ in range(n))
        assert list(tokens.encode_huge(text, lib, 64, 8)) == list(lib(text)[0])
    assert list(tokens.encode_huge("y" * 500, lib, 64, 8)) == list(lib("y" * 500)[0])


def test_huge_texts_count_as_whole_ones():
    text = "Some words, and more of them. " * 400
    got = tokens.counts(X.text_column(pa.array([text, "short", None])), WORD, huge=2000).tolist()
    lib = tokens.load(WORD)
    assert got == [len(lib.encode(text, add_special_tokens=False).ids), 1, 0]


def test_queries_on_edge_rows(spark):
    rows = [(1, None, "z"), (2, "", "z"), (3, "same text", "z"), (3, "same text", "z"), (None, "Ünï <|endoftext|>", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.count_tokens(df).collect()}
    assert (1, 0, 0, False) in got and (2, 0, 0, False) in got and (3, 9, 2, False) in got
    trip = bpe.round_trip(df).collect()
    lib = tokens.load(BYTE)
    for r, (key, text, _) in zip(sorted(trip, key=lambda r: (r.doc_id or 0)), sorted(rows, key=lambda r: r[0] or 0), strict=True):
        ids = lib.encode(text or "", add_special_tokens=False).ids
        assert (r.doc_id, r.n_tokens) == (key, len(ids))
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert tokens.count_tokens(df.limit(0)).count() == 0 and bpe.round_trip(df.limit(0)).count() == 0
