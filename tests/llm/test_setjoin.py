"""The Jaccard join against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from voltarc.llm import _text as X
from voltarc.llm import setjoin as S


def shingles(text, width):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1)))


def brute(rows, width, percent):
    """{(doc_id, text): (n_shingles, component_id)}"""
    sets = {}
    for key, text in rows:
        if key is not None and shingles(text, width):
            sets.setdefault(shingles(text, width), []).append(key)
    names = list(sets)
    root = list(range(len(names)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(names)):
        for b in range(a):
            shared = len(names[a] & names[b])
            if 100 * shared >= percent * (len(names[a]) + len(names[b]) - shared):
                root[find(a)] = find(b)
    low = {}
    for k, s in enumerate(names):
        low[find(k)] = min(low.get(find(k), 10**9), *sets[s])
    at = {s: low[find(k)] for k, s in enumerate(names)}
    return {(key, text): (len(shingles(text, width)), None if key is None else at.get(shingles(text, width), key)) for key, text in rows}


def corpus(seed, n=220):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(40))
    rows, k = [], 0
    while len(rows) < n:
        words = [rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 9, 14, 30, 47, 60, 90, 150, 400]))]
        if rng.random() < 0.3:
            words += passage.split()
        for _ in range(rng.choice([1, 1, 1, 2, 6])):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, len(copy) // 30, len(copy) // 18])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            if rng.random() < 0.2:
                copy = copy[rng.randrange(3) :]
            rows.append((k, " ".join(copy).upper() if rng.random() < 0.1 else rng.choice([" ", "  ", "\n"]).join(copy)))
            k += 1
    return rows


@pytest.mark.parametrize(("width", "percent", "members"), [(4, 85, 3000), (5, 80, 3000), (4, 85, 2)])
def test_components_equal_brute_force(spark, monkeypatch, width, percent, members):
    monkeypatch.setattr(S, "BLOCK_MEMBERS", members)  # 2: every larger block is cut into chunks
    rows = corpus(width + percent + members)
    rows += [(5000, None), (5001, ""), (5002, " \n"), (5003, "lone"), (5004, "LONE"), (3, rows[3][1]), (None, rows[0][1]), (5005, "a b"), (5006, "é ü"), (5007, "É ü")]
    df = spark.createDataFrame([(a, b, "x") for a, b in rows], "doc_id long, text string, n_shingles string").repartition(5)
    got = S.jaccard_components(df, width, percent).collect()
    assert len(got) == len(rows)
    plain = brute(rows, width, percent)
    want = sorted((*plain[r], r[0]) for r in rows if r[0] is not None)
    assert sorted((r.n_shingles, r.component_id, r.doc_id) for r in got if r.doc_id is not None) == want
    assert [r.component_id for r in got if r.doc_id is None] == [None]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.jaccard_components(df).count() == 0
    assert S.keep_one(spark, df, "").count() == 0


def test_stage_keeps_one_of_each_group_and_all_others(spark):
    text = " ".join(f"v{k}" for k in range(100))
    rows = [(4, text), (2, text + " more"), (9, text), (7, "other words here that stand alone"), (2, text + " more"), (None, "x"), (11, None)]
    df = spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id long, text string, n_chars int")
    got = S.keep_one(spark, df, "")
    assert got.columns == df.columns
    assert sorted(str(r.doc_id) for r in got.collect()) == ["11", "2", "7", "None"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), min_size=1, max_size=25), min_size=1, max_size=14), st.sampled_from([60, 80, 85]))
def test_divide_skip_equals_brute_force(sets, percent):
    label = S.divide_skip([np.array(sorted(s), np.uint64) for s in sets], percent)
    root = list(range(len(sets)))
    for _ in sets:
        for a in range(len(sets)):
            for b in range(len(sets)):
                if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    assert all((label[a] == label[b]) == (root[a] == root[b]) for a in range(len(sets)) for b in range(len(sets)))


@pytest.mark.parametrize("percent", [80, 85])
def test_linked_sets_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    scheme = S.Scheme(percent)
    for _ in range(400):
        n = int(rng.choice([6, 7, 12, 40, 44, 50, 62, 64, 70, 100, 300]))
        pool = X.mix(rng.integers(0, 2**62, 2 * n, dtype=np.uint64))
        x, y = pool[:n], pool[:n]
        drop = int(rng.integers(0, n))
        while True:  # the most that may differ
            y = np.concatenate([pool[: n - drop // 2], pool[n : n + drop - drop // 2]])
            shared = np.intersect1d(x, y).size
            if 100 * shared >= percent * np.union1d(x, y).size:
                break
            drop -= 1
        if drop == 0:
            continue
        common = np.sort(rng.choice(pool, n // 2, replace=False))
        h, counts = np.concatenate([np.sort(x), np.sort(y)]), np.array([x.size, y.size])
        sig, key = scheme.signatures(h, counts, np.array([2, 4]), common)
        assert np.intersect1d(sig[key == 2], sig[key == 4]).size


def test_short_texts_are_one_shingle():
    texts = X.text_column(pa.array(["a b", "a b c", "A  B\tC", "a b c d", "", "a b c d e", "b a"]))
    data, off = X.raw(texts)
    h, counts = S.shingle_sets(data, off, 4)
    assert counts.tolist() == [1, 1, 1, 1, 0, 2, 1]
    assert h[1] == h[2] and len({h[0], h[1], h[3], h[6]}) == 4


def test_stage_judges_repeated_ids_by_their_texts(spark):
    words = [" ".join(f"{c}{k}" for k in range(60)) for c in "abcd"]
    rows = [(1, words[0]), (1, words[1]), (1, words[2]), (1, words[1] + " tail"), (2, words[1]), (3, words[3]), (3, words[3]), (3, None), (3, ""), (4, words[3] + " x")]
    df = spark.createDataFrame([(a, b, 7, "y") for a, b in rows], "doc_id long, text string, mark int, `a.b` string")
    got = S.keep_one(spark, df, "")
    assert got.columns == df.columns
    found = [(r["doc_id"], r["text"], r["mark"], r["a.b"]) for r in got.collect()]
    assert all(x[2:] == (7, "y") for x in found)
    texts = [x[:2] for x in found]
    assert sorted(map(str, texts)) == sorted(map(str, [(1, words[0]), (1, words[2]), *[x for x in texts if x in ((1, words[1]), (1, words[1] + " tail"))], (3, words[3]), (3, None), (3, "")]))
    assert sum(t in ((1, words[1]), (1, words[1] + " tail")) for t in texts) == 1  # one of a group's two texts


@pytest.mark.parametrize("members", [3000, 3])
def test_repeated_rows_of_one_id_make_one_set(spark, monkeypatch, members):
    monkeypatch.setattr(S, "BLOCK_MEMBERS", members)
    base = [f"w{k}" for k in range(80)]
    rows = [(9, " ".join(base))] * 40 + [(k, " ".join([*base[: 79 - k % 3], f"z{k}"])) for k in range(8)] + [(9, "another text of this id " * 4)] * 3
    got = S.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    want = brute(rows, 4, 85)
    by_size = sorted((r.doc_id, r.n_shingles, r.component_id) for r in got)
    assert by_size == sorted((d, *want[d, t]) for d, t in rows)


def test_components_of_paths_and_hubs(spark):
    from voltarc.llm.graph import components

    rng = random.Random(4)
    path = rng.sample(range(1000), 400)
    edges = [(a, b) for a, b in zip(path, path[1:], strict=False)] + [(5000, k) for k in range(5001, 5400)] + [(7000, 7000)]
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[k] for k in path} == {min(path)} and {got[k] for k in range(5000, 5400)} == {5000} and 7000 not in got and len(got) == 800
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_texts_that_stay_are_not_shuffled(spark):
    """Beyond any broadcast by size, only rows that the bit array over the dropped ids names meet an exchange."""
    rows = [(k, f"text {k}", k % 3) for k in range(400)] + [(None, "nobody", 1), (7, "again", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `_word` int").repartition(3)
    ids = spark.createDataFrame([(k,) for k in range(0, 400, 7)], "doc_id long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = S.without_ids(docs, ids)
        assert sorted(map(str, got.collect())) == sorted(str(r) for r in docs.collect() if r.doc_id is None or r.doc_id % 7)
        stays = got._jdf.queryExecution().optimizedPlan().children()
        plan = got._jdf.queryExecution().executedPlan().toString()
        first = plan[plan.index("Union") :].split("SortMergeJoin")[0]
        assert stays.size() >= 1 and "BroadcastHashJoin" in first and "Exchange hashpartitioning(doc_id" not in first and "SortMergeJoin" in plan
        assert S.without_ids(docs, ids.limit(0)).count() == len(rows) and S.without_ids(docs.limit(0), ids).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_shared_passage_alone_sends_no_text_to_the_chunks(spark, monkeypatch):
    """Sets that meet in a large block only by a passage, less than a link takes, are out before texts are copied."""
    passage = " ".join(f"p{k}" for k in range(20))
    rows = [(k, f"{passage} " + " ".join(f"w{k}x{j}" for j in range(20))) for k in range(12)]
    rows += [(100 + k, rows[k][1] + " more") for k in (3, 7)]
    monkeypatch.setattr(S, "BLOCK_MEMBERS", 2)
    dealt, settle = [], S.settle

    def told(df, name="table"):
        out = settle(df, name)
        if name == "dealt":
            dealt.extend(r.set_key for r in out.collect())
        return out

    monkeypatch.setattr(S, "settle", told)
    got = S.jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), 4, 85)
    assert {r.doc_id: r.component_id for r in got.collect()} == {k: k - 100 if k >= 100 else k for k, _ in rows}
    assert len(dealt) == 4
    monkeypatch.setattr(S, "COMBINE", 40)  # batches of few shingles, so that owners meet in the reducers
    dealt.clear()
    S.jaccard_components(spark.createDataFrame(rows[:12], "doc_id bigint, text string"), 4, 85).collect()
    assert not dealt


def test_a_block_grown_together_is_dealt_anew(spark, monkeypatch):
    """Pairs of near copies that meet others only by passages send their own texts alone, to blocks of their own."""
    passage = " ".join(f"p{k}" for k in range(20))
    rows = [(k, f"{passage} " + " ".join(f"w{k}x{j}" for j in range(20))) for k in range(9)]
    rows += [(100 + k, rows[k][1] + " more") for k in range(0, 9, 2)]
    monkeypatch.setattr(S, "BLOCK_MEMBERS", 2)
    monkeypatch.setattr(S, "BITS_MEMBERS", 5)
    told, settle = {}, S.settle

    def kept(df, name="table"):
        told[name] = settle(df, name)
        return told[name]

    monkeypatch.setattr(S, "settle", kept)
    got = S.jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), 4, 85)
    assert {r.doc_id: r.component_id for r in got.collect()} == {k: k - 100 if k >= 100 else k for k, _ in rows}
    assert told["texts"].count() == 10  # those with a near copy
    assert {r.chunks for r in told["sizes"].collect()} == {1} and told["sizes"].count() == 5


def test_long_sets_are_asked_for_a_part_of_their_shingles(spark, monkeypatch):
    """Sets around LONG find each other, whichever of the two sends all of its shingles."""
    monkeypatch.setattr(S, "BLOCK_MEMBERS", 2)
    monkeypatch.setattr(S, "LONG", 60)
    rng, rows = random.Random(11), []
    for k in range(30):
        words = [f"p{j}" for j in range(12)] + [f"w{k}x{j}" for j in range(30 + 3 * k)]
        rows.append((k, " ".join(words)))
        rows.append((100 + k, " ".join(words + [f"t{k}y{j}" for j in range(rng.randrange(1, 14))])))
    got = S.jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), 4, 80).collect()
    want = brute(rows, 4, 80)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted((d, *want[d, t]) for d, t in rows)
