"""Quality rules: counts, learner and query against plain versions."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from voltarc.llm import _text as X
from voltarc.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, as the contract words them."""
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    again = {k + i for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for i in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(again)


def plain_base(counts):
    return counts[0] < 50 or 100 * counts[4] > 50 * counts[0]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from(list("ab#<é漢 \t\n\x0b\r\x85\xa0A1!")), max_size=60)), min_size=1, max_size=5))
def test_counts_equal_the_plain_ones(texts):
    got = Q.statistics(X.text_column(pa.array(texts, pa.string())))
    for k, t in enumerate(texts):
        assert tuple(int(got[c][k]) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == plain_counts(t)
        assert got["n_code_points"][k] == len(t or "") and got["n_digits"][k] == (t or "").count("1") and got["n_upper"][k] == (t or "").count("A")


def plain_learn(rows, bad, max_rules=12, max_tests=4, min_precision=0.9, min_cover=3):
    """The same covering over lists of dicts, every threshold tried one by one."""

    def holds(tests, row):
        return all(row[n] <= at if op == "<=" else row[n] > at for n, op, at in tests)

    left, rules = list(range(len(rows))), []
    while len(rules) < max_rules and sum(bad[k] for k in left) >= min_cover:
        grow, check = [k for k in left if k % 3 != 2], [k for k in left if k % 3 == 2]
        covered, tests = list(grow), []
        while len(tests) < max_tests and any(bad[k] for k in covered) and not all(bad[k] for k in covered):
            base = math.log2(sum(bad[k] for k in covered) / len(covered))
            best, gain = None, 0.0
            for name in rows[0]:
                values = sorted({rows[k][name] for k in covered})
                tried = []
                for op in ("<=", ">"):
                    for a, b in zip(values, values[1:]):
                        test = (name, op, (a + b) / 2)
                        hit = [k for k in covered if holds([test], rows[k])]
                        p = sum(bad[k] for k in hit)
                        tried.append((p * (math.log2(p / len(hit)) - base) if p else -1.0, test))
                for g, test in tried:
                    if g > gain + 1e-9:
                        best, gain = test, g
            if best is None:
                break
            tests.append(best)
            covered = [k for k in grow if holds(tests, rows[k])]
        if not tests:
            break

        def worth(n):
            hit = [k for k in check if holds(tests[:n], rows[k])]
            p = sum(bad[k] for k in hit)
            return (2 * p - len(hit)) / max(1, len(hit))

        keep = max(range(1, len(tests) + 1), key=lambda n: (round(worth(n), 9), -n))
        rule = None
        for n in range(keep, len(tests) + 1):
            hit = [k for k in left if holds(tests[:n], rows[k])]
            p = sum(bad[k] for k in hit)
            if len(hit) >= min_cover and (p + 1) / (len(hit) + 2) >= min_precision:
                rule = tests[:n]
                break
        if rule is None:
            break
        rules.append(tuple(rule))
        left = [k for k in left if not holds(rule, rows[k])]
    return rules


@pytest.mark.parametrize("seed", range(12))
def test_learner_equals_a_plain_one(seed):
    rng = np.random.default_rng(seed)
    n = 90
    table = {"x": np.round(rng.random(n), 1), "y": np.round(rng.random(n), 2), "z": rng.integers(0, 5, n).astype(float)}
    bad = (table["x"] > 0.6) & (table["z"] < 3) | (table["y"] < 0.15)
    bad ^= rng.random(n) < 0.03 * (seed % 3)
    want = plain_learn([{c: float(v[k]) for c, v in table.items()} for k in range(n)], bad.tolist())
    got = [r.tests for r in Q.learn(table, bad)]
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert [(n, op) for n, op, _ in a] == [(n, op) for n, op, _ in b] and np.allclose([t for *_, t in a], [t for *_, t in b])


def test_no_rules_without_two_kinds_of_labels():
    table = {"x": np.arange(10.0)}
    assert Q.learn(table, np.zeros(10, bool)) == [] and Q.learn(table, np.array([True, False] * 5)) == []


def corpus(rng, n=260):
    """(doc_id, text), (doc_id, quality): bad ones are full of symbols, or shout."""
    rows, labels = [], []
    vocabulary = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8))) for _ in range(800)]
    for k in range(n):
        words = rng.choices(vocabulary, k=rng.randint(60, 200))
        kind = rng.choice(["good", "good", "symbols", "shout"])
        if kind == "symbols":
            words = [w + rng.choice(["##", "|", ""]) for w in words]
        if kind == "shout":
            words = [w.upper() if rng.random() < 0.7 else w for w in words]
        rows.append((k, " ".join(words)))
        labels.append((k, int(kind == "good"), 0))
    return rows, labels


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("quality")
    rows, labels = corpus(random.Random(4))
    rows += [(900, None), (901, ""), (902, "too short"), (903, "same three words " * 40), (904, "line\n" * 60), (905, rows[0][1]), (0, rows[0][1]), (None, rows[1][1])]
    spark.createDataFrame([(a, b, "x") for a, b in rows], "doc_id long, text string, kept string").repartition(3).write.parquet(f"{at}/documents.parquet")
    held = [x for x in labels if x[0] % 4]  # the others are held out
    odd = [(None, 1, 0), (5000, 0, 0), (7, None, 0)]
    spark.createDataFrame(held + odd, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return str(at), rows, dict((a, q) for a, q, _ in labels)


def test_query_equals_the_plain_version(spark, folder):
    at, rows, labels = folder
    got = Q.op8_quality_rules(spark, at)
    assert [c for c, _ in got.dtypes] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    docs, truth = spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet")
    rules = Q.learn_from(docs, truth)
    names = [n for n, _, _ in Q.RATIOS]

    def verdict(text):  # the ordered list, rule by rule
        s = {c: int(v[0]) for c, v in Q.statistics(X.text_column(pa.array([text], pa.string()))).items()}
        have = {n: (s[a] / s[b] if s[b] else 0.0) for n, a, b in Q.RATIOS} | {"n_words": float(s["n_words"])}
        for rule in rules:
            if all(have[n] <= t if op == "<=" else have[n] > t for n, op, t in rule.tests):
                return False
        return True

    assert rules and all(t[0] in [*names, "n_words"] for r in rules for t in r.tests)
    want = sorted(((i is None, i or 0, *plain_counts(t), plain_base(plain_counts(t)), not plain_base(plain_counts(t)) and verdict(t)) for i, t in rows))
    assert sorted((r[0] is None, r[0] or 0, *r[1:]) for r in got.collect()) == want


def test_held_out_labels_are_met(spark, folder):
    at, _, labels = folder
    got = {r.doc_id: r.kept for r in Q.op8_quality_rules(spark, at).collect()}
    held = [k for k in labels if k % 4 == 0]
    right = sum(got[k] == bool(labels[k]) for k in held)
    assert len(held) > 60 and right >= 0.95 * len(held)


def test_bounded_labels_and_repeated_rows(spark, folder):
    at, _, _ = folder
    docs, labels = spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet")
    drawn = Q.labelled_texts(docs.unionByName(docs), labels, 40).collect()
    assert 15 < len(drawn) < 80 and len({r.doc_id for r in drawn}) == len(drawn)
    assert Q.labelled_texts(docs, labels.limit(0)) is None and Q.learn_from(docs, labels.limit(0)) == []


def test_stage_leaves_clashing_columns_alone(spark, folder, tmp_path):
    at, rows, _ = folder
    docs = spark.createDataFrame([(k, t, 7, "x", 0.5, True) for k, t in rows], "doc_id long, text string, n_words int, `a.b` string, score double, kept boolean")
    got = Q.keep_good(spark, docs, at)
    assert got.columns == docs.columns
    found = got.collect()
    assert found and all(r["n_words"] == 7 and r["a.b"] == "x" and r["score"] == 0.5 and r["kept"] is True for r in found)
    plain = [r.doc_id for r in Q.op8_quality_rules(spark, at).where("kept").collect()]
    assert sorted(map(str, (r.doc_id for r in found))) == sorted(map(str, plain))
    assert Q.keep_good(spark, docs.limit(0), at).count() == 0
    stats = Q.with_statistics(docs).first()
    assert stats["a.b"] == "x" and stats["n_words"] != 7
