"""The filter audit against plain counting."""

import re
from collections import Counter
from itertools import permutations

import numpy as np

from voltarc.llm import _text as X
from voltarc.llm import interactions as I

SCHEMA = "doc_id long, text string, source string, part string, n long, mask int"


def plain(rows, labels):
    lowest, good, toxic = {}, {k for k, q, _ in labels if q == 1}, {k for k, _, t in labels if t == 1}
    for k, t, _ in rows:
        if k is not None:
            lowest[t or ""] = min(k, lowest.get(t or "", k))
    out, fails = {}, []
    for k, t, source in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), bool(re.search("[#$%&*|]", t)), k is not None and k > lowest[t]]
        fails.append((source or "", "".join(x for x, y in zip("ABCDE", f, strict=True) if y), k in good and k is not None, k in toxic and k is not None))
    shapley = Counter()
    for part in {p for p, *_ in fails}:
        for order in map("".join, permutations("ABCDE")):
            for step, x in enumerate(order):
                row = [0] * 6
                for p, f, g, b in fails:
                    if p != part:
                        continue
                    gone, hit = bool(set(f) & set(order[:step])), x in f
                    for k, y in enumerate((not gone and not hit, hit and not gone, hit and gone, f == x, hit and not gone and g, hit and not gone and b)):
                        row[k] += y
                out[part, order, step + 1] = row
                shapley[part, x] += row[1]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def rows():
    rng = np.random.default_rng(7)
    words = [f"w{k}" for k in range(150)]
    texts = [" ".join(rng.choice(words[: int(rng.integers(2, 150))], int(rng.integers(1, 420)))) + rng.choice(["", "#", "|", "ABC" * 9, "ü"]) for _ in range(60)]
    texts += [texts[0] + "x", texts[1][:-1] + "y", "a" * 300 + "b" + "c" * 300, "a" * 300 + "d" + "c" * 300, "a" * 600 + "b", "a" * 600 + "d", "", None]
    out = [(k, texts[int(rng.integers(0, len(texts)))] if k % 3 else "a hot text " * 80, ["a", "b", None, ""][k % 4]) for k in range(300)]
    return out + [(5, "again", "a"), (5, "again", "a"), (6, "again", "b"), (4, "again", "c"), (None, "again", "a"), (None, "", "a"), (299, "é" * 300, "a"), (300, "è" * 300, "a"), (301, "é" * 300, "a")]


LABELS = [(k, int(k % 2), int(k % 5 == 0)) for k in range(0, 290, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (9999, 1, 1)]


def got(spark, table, labels, hashes=X.span_hashes):
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = I.audit(I.failure_counts(spark.createDataFrame([(*r, "x", 1, 2) for r in table], SCHEMA).repartition(4), labels, hashes)).collect()
    out = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in found}
    assert len(out) == len(found)
    return out


def test_audit_equals_plain_counts(spark):
    assert got(spark, rows(), LABELS) == plain(rows(), LABELS)


def test_texts_with_equal_hashes_are_told_apart(spark):
    def weak(data, starts, ends):
        return (ends - starts).astype(np.uint64)

    assert got(spark, rows(), LABELS, weak) == plain(rows(), LABELS)


def test_empty_tables(spark):
    assert got(spark, [], LABELS) == {}
    few = [(1, None, None), (2, "", "b")]
    assert got(spark, few, []) == plain(few, [])


def test_blocks_and_giant_texts(monkeypatch):
    monkeypatch.setattr(X, "WINDOW_BYTES", 5000)
    rng = np.random.default_rng(3)
    texts = [b" ".join(b"w%d" % k for k in rng.integers(0, 900, n)) for n in (0, 1, 40, 70, 200, 3000, 1)]
    data, off = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    n, distinct = I._word_counts(data, off)
    assert n.tolist() == [len(t.split()) for t in texts] and distinct.tolist() == [len(set(t.split())) for t in texts]
    seen = []

    def spans(data, starts, ends):
        seen.extend(bytes(data[a:b]) for a, b in zip(starts, ends, strict=True))
        return X.span_hashes(data, starts, ends)

    _, at = I.block_hashes(data, off, spans)
    assert [b"".join(seen[a:b]) for a, b in zip(at, at[1:], strict=False)] == texts
    assert all([len(x) for x in seen[a : b - 1]] == [256, 256, 512, 1024, 2048, 4096, 8192][: b - a - 1] for a, b in zip(at, at[1:], strict=False) if b > a)
