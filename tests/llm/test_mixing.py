"""The source schedule against plain computation."""

import re
from collections import Counter, defaultdict

import numpy as np

from voltarc.llm import mixing as M

SCHEMA = "doc_id long, text string, source string, size long, k int"


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Targets of sizes in the order of sources, by giving out the excess again and again."""
    w = [weights[k % len(weights)] for k in range(len(sizes))]
    full = set()
    while True:
        left, rest = sum(sizes) - sum(most * sizes[k] for k in full), sum(w[k] for k in range(len(sizes)) if k not in full)
        t = [most * s if k in full else left * w[k] / rest for k, s in enumerate(sizes)]
        over = {k for k, s in enumerate(sizes) if k not in full and t[k] > most * s}
        if not over:
            return t
        full |= over


def table(spark, rows):
    return spark.createDataFrame([(*r, 0, 0) for r in rows], SCHEMA).repartition(5)


def test_targets(spark):
    rng = np.random.default_rng(2)
    for case in range(6):
        sizes = [int(x) for x in rng.integers(0, [20, 2000, 50, 10, 5, 3][case], 11)]
        sizes[case % 3] *= 1 + 100 * (case % 2)
        sizes[-1] += 1
        df = spark.createDataFrame([(f"s{k:02}", False, 0, s) for k, s in enumerate(sizes)], "_source string, _none boolean, slice int, words long")
        got = [(r.source_size, r.target) for r in M.targets(df).orderBy("k").collect()]
        assert np.allclose(got, list(zip(sizes, plain_targets(sizes), strict=True)), rtol=1e-12)


def test_mix(spark):
    rng = np.random.default_rng(1)
    rows = [(k, " ".join(["w"] * int(rng.integers(0, 90))), ["a", "b", "c", "d", None, "hot"][min(5, int(rng.integers(0, 9)))]) for k in range(900)]
    rows += [(2000, "long " * 9000, "é"), (2001, None, "nothing"), (2002, " \n", "a"), (2003, "x y", "a"), (2003, "x y", "a"), (2003, "z", "a"), (2003, "", "a"), (2003, "", "a"), (None, "q r s", None), (None, None, None)]
    mix = M.Mix(table(spark, rows), block_words=16)
    assert Counter((r.doc_id, r.size) for r in mix.documents.collect()) == Counter((k, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for k, t, _ in rows)
    sources = {r.k: r for r in mix.sources.collect()}
    taken, uses, places, order = Counter(), defaultdict(list), Counter(), []
    for r in mix.taken.collect():
        taken[r.k] += r.words
        if r.words:
            uses[r.k, r.start, r.size].append((r.turn, r.first, r.first + r.words))
            places[r.place] += r.words
            order.append((r.place, r.k, r.words))
    assert all(taken[k] == round(s.target) for k, s in sources.items()) and max(places.values()) <= 16
    for (_, _, size), parts in uses.items():  # no word of a document is taken twice in one turn
        for turn in {t for t, _, _ in parts}:
            own = sorted(p[1:] for p in parts if p[0] == turn)
            assert own[0][0] == 0 and own[-1][1] <= size and all(a[1] == b[0] for a, b in zip(own, own[1:], strict=False))
        assert len({t for t, _, _ in parts}) <= 3
    whole, run = sum(taken.values()), Counter()
    done = 0
    for _, k, n in sorted(order):  # every stretch from the start holds the sources by their shares
        run[k] += n
        done += n
        assert all(abs(run[s] - done * taken[s] / whole) < 16 * 12 for s in taken)
    again = M.Mix(table(spark, rows).repartition(3), block_words=16)
    assert sorted(map(tuple, again.taken.drop("nth").collect()), key=str) == sorted(map(tuple, mix.taken.drop("nth").collect()), key=str)


def test_query_defined_cases(spark, tmp_path):
    rows = [(1, "a b c", "s"), (1, "a b c", "s"), (2, None, "s"), (2, "", "s"), (2, "", "s"), (None, "x", None), (3, "\t", "t")]
    for part, n in ((rows, 7), ([r for r in rows if not (r[1] or "").strip()], 4), (rows[:0], 0)):
        table(spark, part).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        got = M.op12_source_schedule(spark, str(tmp_path)).collect()
        assert len(got) == n and all(r.taken <= 3 * r.size and (r.target == 0) == (r.source_size == 0) for r in got)
        assert sum(r.taken for r in got) == sum(r.size for r in got)


def test_bits(spark):
    rows = spark.range(256).select("id", M.bit_reversed(M.F.col("id"), 8).alias("r"), M.bit_reversed(M.F.col("id"), 8 + 40).alias("wide")).collect()
    assert all(r.r == int(f"{r.id:08b}"[::-1], 2) and r.wide == int(f"{r.id:048b}"[::-1], 2) for r in rows)
