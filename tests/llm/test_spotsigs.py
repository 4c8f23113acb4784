"""SpotSigs fingerprints against a plain version."""

import hashlib
import random

import pyarrow as pa
import pytest

from voltarc.llm import _text as X
from voltarc.llm import spotsigs as S


def plain_sets(text):
    words, now = [], ""
    for c in text + " ":
        if c.isascii() and not c.isalnum():
            if now:
                words.append("".join(x.lower() if x.isascii() or "À" <= x <= "Þ" else x for x in now))
            now = ""
        else:
            now += c
    anchors = set(S.ANCHORS)
    content = [k for k, w in enumerate(words) if w not in anchors]

    def chain(k, head):
        after = [words[j] for j in content if j >= k][: S.CHAIN]
        return (head, *after) if after else None

    spots = {chain(k + 1, w) for k, w in enumerate(words) if w in anchors} - {None}
    for place, k in enumerate(content):
        if not anchors & set(words[max(0, k - S.GAP) : k]):
            spots.add(("*", *(words[j] for j in content[place : place + S.CHAIN])))
    if not content and words:
        spots |= {("w", w) for w in words}
    if not words and text:
        spots.add(("t", text))
    return spots


def jaccard(x, y):
    return len(x & y) / len(x | y) if x | y else 1.0


def texts(n, seed):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "and", "der", "le", "los", "Maße", "Élan", "ÉLAN", *(f"w{k}" for k in range(60))]
    return [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 3, 20, 200]))) + rng.choice(["", ".", "###"]) for _ in range(n)]


def test_sets_equal_the_plain_version():
    rows = [*texts(120, 1), "", "###", "!!!", "the of and", "The the", "漢字 the かな x"]
    found, counts = S.signatures(X.text_column(pa.array(rows)))
    prints = S.written(found, counts)
    sets = [set(S.read(p).tolist()) for p in prints]
    plain = [plain_sets(t) for t in rows]
    assert [len(s) for s in sets] == [len(p) for p in plain]
    for a in range(0, len(rows), 3):
        for b in range(len(rows)):
            assert S.likeness(S.read(prints[a]), S.read(prints[b])) == pytest.approx(jaccard(plain[a], plain[b]))


def test_query_rows(spark, monkeypatch):
    monkeypatch.setattr(S, "ROWS_A_RANGE", 17)
    rows = [(k * 3, t) for k, t in enumerate(texts(150, 2))]
    rows += [(7, None), (9, rows[3][1]), (1000, ""), (1001, "x" * 3), (None, "before the first of all words")]
    df = spark.createDataFrame([(a, b, "c") for a, b in rows], "doc_id long, text string, near_next string").repartition(6)
    got = S.with_next(df).collect()
    assert len(got) == len(rows)
    order = sorted(((a is not None, a or 0, b or "") for a, b in rows))
    want = []
    for k, (known, key, text) in enumerate(order):
        after = order[(k + 1) % len(order)][2]
        n = len(text)
        edited = text[: n - n // 4] + after[: n // 4]
        s, e, x = plain_sets(text), plain_sets(edited), plain_sets(after)
        want.append((known, key, n, hashlib.sha256(edited.encode()).hexdigest(), round(jaccard(s, e), 9), round(jaccard(s, x), 9)))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == sorted(want)
    assert len({r.fingerprint for r in got if r.doc_id == 9}) == 1  # equal texts
    assert S.with_next(df.limit(0)).count() == 0
    one = S.with_next(spark.createDataFrame([(5, "abcdefgh")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and one[0].near_next == 1.0


def test_near_duplicates(spark):
    rows = [(k, t) for k, t in enumerate(x for x in texts(80, 3) if len(x) > 300)]
    rows += [(100 + k, t.replace(" w7 ", " w8 ")) for k, t in rows]
    got = {r.doc_id: r.class_id for r in S.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [(k, plain_sets(t)) for k, t in rows]
    for a, x in sets:
        for b, y in sets:
            if jaccard(x, y) >= 0.8:
                assert got[a] == got[b]
    assert len(set(got.values())) > 1
