"""Language ID by coverage: texts of no learned language are rejected, those of learned ones stay."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from voltarc.llm import _text as X
from voltarc.llm import langid

WORDS = {
    "en": "the with house water thing which about under would there their people could through before little world after great where right think place again because",
    "fr": "les avec maison leur chose quelle être sous dans pour nous vous toujours jamais beaucoup homme femme jour temps monde encore après depuis quand comme",
    "de": "der mit haus wasser ding welche über unter würde dort ihre leute könnte durch vorher klein welt nach groß wieder weil immer zwischen schon jetzt",
    "es": "los con casa agua cosa cual sobre bajo sería allí gente podría antes pequeño mundo después grande donde derecho pensar lugar otra porque siempre nunca",
}
POLISH = "przyszłość dzieci żyją w mieście gdzie wszyscy ludzie pracują każdego dnia szczęście jest najważniejsze chociaż często zapominamy wdzięczność źródło książka"


def test_stage_rejects_what_no_language_covers(spark):
    rng = random.Random(3)
    rows = []
    for k in range(240):
        lang = sorted(WORDS)[k % 4]
        rows.append((k, " ".join(rng.choice(WORDS[lang].split()) for _ in range(80)), lang))
    letters = "abcdefghijklmnopqrstuvwxyz"
    for k in range(20):
        rows.append((1000 + k, " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 9))) for _ in range(200)) + " the with", None))
        rows.append((2000 + k, " ".join(rng.choice(POLISH.split()) for _ in range(80)) + " where", None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.keep_known(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == list(range(240))
    judged = langid.predict(docs.where("doc_id >= 1000"), langid.train(docs.where("lang IS NOT NULL")), ["doc_id"]).collect()
    assert sum(r.score >= langid.MIN_SCORE for r in judged) > 20  # the score alone would keep them


def test_coverage_lies_between_own_and_other_texts(spark):
    rng = random.Random(6)
    rows = [(k, " ".join(rng.choices(WORDS[x].split(), k=60)), x) for k, x in enumerate(sorted(WORDS) * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    least = langid.least_coverage(docs, langid.train(docs))
    assert len(least) == 4 and all(0.3 < x < 0.9 for x in least)


def test_no_rows_and_no_labels(spark):
    docs = spark.createDataFrame([(1, "the house", None)], "doc_id long, text string, lang string")
    assert langid.keep_known(spark, docs, "").count() == 0
    assert langid.keep_known(spark, docs.limit(0), "").count() == 0


def plain_grams(text):
    """4-byte windows of the lowered text with a letter in the middle two places and at one end at least."""
    low = "".join(c.lower() if c.isascii() or 0xC0 <= ord(c) <= 0xDE and ord(c) != 0xD7 else c for c in text).encode()
    flat = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in low)
    found = [flat[k : k + 4] for k in range(len(flat) - 3)]
    return [g for g in found if 32 not in g[1:3] and (g[0] != 32 or g[3] != 32)]


def plain_predict(rows):
    """Exact sets in place of the filters, with the same choice of n-grams."""
    training = [(t, lang) for k, t, lang in rows if t is not None and lang is not None and (k is None or zlib.crc32(str(k).encode()) % 4 != 2)]
    sizes = Counter(lang for _, lang in training)
    found = {lang: Counter(g for t, x in training if x == lang for g in set(plain_grams(t))) for lang in sizes}
    rate = {lang: {g: n / sizes[lang] for g, n in c.items() if n >= 2} for lang, c in found.items()}
    most = {}
    for c in rate.values():
        for g, r in c.items():
            most[g] = max(most.get(g, 0), r)
    member = {lang: {g for g, r in c.items() if r >= langid.RATE_SHARE * most[g]} for lang, c in rate.items()}
    out = []
    for _, text, _ in rows:
        if not any(map(str.isalpha, text or "")) or not sizes:
            out.append(("und", 0.0))
            continue
        counts = {lang: sum(g in member[lang] for g in plain_grams(text)) for lang in sorted(member)}
        top = max(counts.values())
        best = min((x for x in counts if counts[x] == top), default=None) if top else min(sizes, key=lambda x: (-sizes[x], x))
        out.append((best, top / sum(counts.values()) if top else 0.0))
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(9)
    rows = [(k, " ".join(rng.choices(WORDS[x].split(), k=rng.randint(8, 60))), x) for k, x in enumerate(sorted(WORDS) * 60)]
    rows += [(900, None, "en"), (901, "", "en"), (902, "12 34 !!", "fr"), (903, "漢字 漢字", None), (904, "THE HOUSE, with Water", None), (905, "xq", None), (3, rows[3][1], rows[3][2]), (None, rows[0][1], "de")]
    at = tmp_path_factory.mktemp("langid")
    spark.createDataFrame([(a, b, c, "s") for a, b, c in rows], "doc_id long, text string, lang string, lang_pred string").repartition(4).write.parquet(f"{at}/documents.parquet")
    return str(at), rows


def test_query_equals_exact_sets(spark, folder):
    at, rows = folder
    got = langid.op10_language_id(spark, at).collect()
    want = {(k, t): p for (k, t, _), p in zip(rows, plain_predict(rows), strict=True)}
    by_id = {k: t for k, t, _ in rows}
    assert len(got) == len(rows)
    for r in got:
        lang, score = want[r.doc_id, by_id[r.doc_id]]
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert r.lang_pred == lang and abs(r.score - score) < 0.01, r


def test_held_out_accuracy(spark, folder):
    at, rows = folder
    lang = {k: x for k, _, x in rows}
    held = [r for r in langid.op10_language_id(spark, at).where("held_out AND doc_id < 240").collect()]
    assert len(held) > 40 and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def test_no_input_but_the_text_decides(spark, folder):
    at, rows = folder
    docs = spark.read.parquet(f"{at}/documents.parquet")
    model = langid.train(docs.where(~langid.held_out()))
    assert model.languages == sorted(WORDS)
    shuffled = spark.createDataFrame([(k + 7, t, "de") for k, t, _ in rows if k is not None], "doc_id long, text string, lang string")
    a = {r["text"]: r["lang_pred"] for r in langid.predict(docs, model, ["text"]).collect()}
    b = {r["text"]: r["lang_pred"] for r in langid.predict(shuffled, model, ["text"]).collect()}
    assert all(a[t] == b[t] for t in b)


def test_filters_answer_for_all_languages_at_once():
    rng = random.Random(1)
    members = {f"l{k:02}": np.array(rng.sample(range(1 << 30), 2000), np.uint32) for k in range(70)}  # more than a word of bits
    model = langid.Filter.build(members, "l00")
    for k, (name, grams) in enumerate(sorted(members.items())):
        mask = model.lookup(grams)
        assert ((mask[k // 64] >> np.uint64(k % 64)) & np.uint64(1)).all(), name
    alien = np.array(rng.sample(range(1 << 30, 1 << 31), 20_000), np.uint32)
    hits = np.array([((model.lookup(alien)[k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean() for k in range(3)])
    assert (np.abs(hits - model.false_rate[:3]) < 0.01).all()


def test_windows_count_what_whole_texts_do(monkeypatch):
    text = " ".join(random.Random(2).choices(" ".join(WORDS.values()).split(), k=900)) + " 漢字 GROß É."
    model = langid.Filter.build({"a": langid.grams(*X.raw(X.text_column(pa.array([text[:3000]]))))[0], "b": np.array([5], np.uint32)}, "a")
    data, off = X.raw(X.text_column(pa.array([text, "the house"])))
    whole = model.known(data, off)
    monkeypatch.setattr(X, "WINDOW_BYTES", 700)
    monkeypatch.setattr(X.windows, "__defaults__", (700,))
    parts = model.known(data, off)
    assert np.allclose(whole[0], parts[0]) and (whole[1] == parts[1]).all()


def test_equally_common_grams_all_or_none():
    rows = [{"lang": "a", "n": 5, "grams": 10}, {"lang": "a", "n": 4, "grams": 10}, {"lang": "b", "n": 9, "grams": 3}]
    assert langid._least_kept(rows, 15) == {"a": 5} and langid._least_kept(rows, 20) == {} and langid._least_kept([], 3) == {}


def test_stage_leaves_clashing_columns_alone(spark):
    rng = random.Random(3)
    rows = [(k, " ".join(rng.choices(WORDS[x].split(), k=80)), x, 0.125, "mine", "dot") for k, x in enumerate(sorted(WORDS) * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, lang_pred string, `a.b` string")
    got = langid.keep_known(spark, docs, "")
    assert got.columns == docs.columns
    found = got.collect()
    assert len(found) > 150 and all((r["score"], r["lang_pred"], r["a.b"]) == (0.125, "mine", "dot") for r in found)
