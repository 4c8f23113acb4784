"""Best-fit packing: whole results, gapless places, few sequences."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from voltarc.llm import packing as P
from voltarc.llm import tokens


def held(classes):
    out = Counter()
    for c in classes:
        assert c.count > 0 and c.room >= 0
        for x, n in c.content:
            out[x] += n * c.count
    return out


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 60), max_size=20))
def test_plan_holds_every_piece_once_within_capacity(counts):
    classes = P.plan(counts, 50)
    assert held(classes) == Counter(counts)
    for c in classes:
        assert sum(x * n for x, n in c.content) + c.room == 50


def test_plan_is_near_the_bound_and_best_fit_decreasing():
    random.seed(5)
    counts = Counter(min(4096, int(random.lognormvariate(6.5, 1.1)) + 2) for _ in range(20000))
    bins = sum(c.count for c in P.plan(counts))
    bound = -(-sum(x * n for x, n in counts.items()) // 4096)
    assert bins <= bound * 1.002 + 1
    hard = Counter(random.randint(1200, 3000) for _ in range(3000))
    assert sum(c.count for c in P.plan(hard)) <= P.best_fit_order([x for x, n in hard.items() for _ in range(n)], 4096) * 1.01


def test_linear_groups_round_up_and_are_about_equal():
    counts = {x: 10 for x in range(100, 200)}
    rounded = P.linear_groups(list(counts), counts, 10)
    sizes = Counter()
    for x, to in rounded.items():
        assert to >= x
        sizes[to] += counts[x]
    assert max(sizes.values()) <= 110 and len(sizes) <= 12


def test_plan_size_doesn_t_grow_with_the_counts():
    random.seed(2)
    counts = Counter(random.randint(1, 4096) for _ in range(5000))
    small = len(P.plan(counts))
    assert len(P.plan({x: n * 100_000 for x, n in counts.items()})) < 6 * small


@pytest.mark.parametrize("block", [256, 2])
def test_pack_documents(spark, monkeypatch, block):
    monkeypatch.setattr(P, "BLOCK_PIECES", block)
    rows = [(k, "word " * n, "x") for k, n in enumerate([1, 5, 4095, 4096, 5000, 9000, 100, 100, 100])]
    rows += [(100, None, "x"), (101, "", "x"), (7, "word " * 100, "x"), (None, "one two", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, offset string")
    got = P.pack_documents(df).toPandas()
    lib = tokens.load(tokens.vocabulary(tokens.WORD_VOCABULARY))
    want = Counter()
    for key, text, _ in rows:
        ids = [*lib.encode(text or "", add_special_tokens=False).ids, 1]
        for p, a in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[a : a + 4096], "<u4")
            want[-1 if key is None else key, p, a, len(part), zlib.crc32(part.tobytes())] += 1
    got["doc_id"] = got["doc_id"].fillna(-1).astype(int)
    assert Counter(zip(*(got[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")), strict=True)) == want
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        assert own["offset"].tolist() == [0, *np.cumsum(own["length"])[:-1]] and own["length"].sum() <= 4096
    assert got["sequence_id"].nunique() == -(-got["length"].sum() // 4096)
    assert P.pack_documents(df.limit(0)).count() == 0
