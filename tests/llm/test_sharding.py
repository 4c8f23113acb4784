"""Vector bin packing over shards."""

import zlib
from collections import Counter

import numpy as np

from voltarc.llm import sharding as S


def test_place_balances_all_dimensions():
    rng = np.random.default_rng(4)
    units = np.stack([rng.lognormal(8, 1, 4000).astype(int) + 1, rng.lognormal(5, 1, 4000).astype(int) + 1, rng.integers(1, 30, 4000)], 1)
    at = S.place(units, 8)
    for load in (np.stack([np.bincount(at, weights=u, minlength=8) for u in units.T]),):
        assert (load.max(1) / load.mean(1) < 1.02).all()
    better = S.even_out(units, at, 8)
    load = np.bincount(better, weights=units[:, 0], minlength=8)
    assert load.max() - load.min() <= 2 or load.max() / load.mean() < 1.0005
    for u in units.T:  # tokens and rows stay balanced
        load = np.bincount(better, weights=u, minlength=8)
        assert load.max() / load.mean() < 1.02


def test_shard_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(k, " ".join(["w"] * int(rng.integers(1, 200)) + [str(k)]), "x") for k in range(3000)]
    rows += [(3000 + k, "the same text", "x") for k in range(300)] + [(4000 + k, "hot " * 50, "x") for k in range(3000)]
    rows += [(8000, None, "x"), (8001, "", "x"), (8002, "ü", "x"), (8002, "ü", "x"), (None, "nobody", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(3)
    got = S.shard(df).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t, _ in rows)
    load, slots, texts = Counter(), {}, {}
    for r in got:
        load[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
        texts.setdefault((r.text_crc32, r.size), set()).add(r.shard)
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(load) <= set(range(8))
    assert max(load.values()) / min(load.values()) < 1.02
    hot = (zlib.crc32(("hot " * 50).encode()), 201)
    assert all(len(s) == 1 for k, s in texts.items() if k != hot)  # only the group that no shard should hold is dealt
    assert all(r.dealt == ((r.text_crc32, r.size) == hot) for r in got)
    assert sorted(map(tuple, S.shard(df.repartition(7)).collect()), key=str) == sorted(map(tuple, got), key=str)
    assert S.shard(df.limit(0)).count() == 0
    whole, together = S.shard(df, whole_groups=True).collect(), {}
    for r in whole:
        together.setdefault((r.text_crc32, r.size), set()).add(r.shard)
    assert len(whole) == len(rows) and not any(r.dealt for r in whole) and all(len(s) == 1 for s in together.values())
    for s in range(8):
        slots = sorted(r.slot for r in whole if r.shard == s)
        assert slots == list(range(len(slots)))
    lone = next(iter(together[hot]))
    others = Counter()
    for r in whole:
        others[r.shard] += r.size
    rest = [n for s, n in others.items() if s != lone]
    assert max(rest) / min(rest) < 1.02  # the others share the rest
