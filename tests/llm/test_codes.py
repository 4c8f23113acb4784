"""Vector codes against full searches."""

import math

import numpy as np
import pytest

from voltarc.llm import codes as C

SCHEMA = "vec_id long, embedding array<float>, label int, code string, v int"


def plain_codes(rows, parts, entries, rounds):
    """Codes, errors and codebooks of (vec_id, integers) in the order of ids, by full searches."""
    cut = [np.array(v).reshape(parts, -1) for v in rows]
    books = [np.array([x[p] for x in cut[:entries]]) for p in range(parts)]
    for k in range(rounds + 1):
        d = [[((x[p] - books[p]) ** 2).sum(1) for p in range(parts)] for x in cut]
        code = [[int(np.argmin(y)) for y in x] for x in d]
        if k < rounds:
            for p in range(parts):
                for e in range(len(books[p])):
                    own = [x[p] for x, c in zip(cut, code, strict=True) if c[p] == e]
                    if own:
                        books[p][e] = [math.floor(sum(int(z[j]) for z in own) / len(own)) for j in range(len(own[0]))]
    return code, [sum(int(y.min()) for y in x) for x in d], books


@pytest.mark.parametrize("seed", range(6))
def test_bounds_give_what_full_searches_give(seed):
    rng = np.random.default_rng(seed)
    spread = [3, 40, 1 << 20][seed % 3]  # of 3, most parts are ties
    x = rng.integers(-spread, spread + 1, (3000, 4))
    book = rng.integers(-spread, spread + 1, (1 + seed * 12, 4))
    code, first, second = C.nearest(x, book)
    upper, lower = C._narrow(C.above(first), np.inf).astype(float), C._narrow(C.below(second), -np.inf).astype(float)
    measured = 0
    for _ in range(4):
        new = book + rng.integers(-max(1, spread // 8), max(1, spread // 8) + 1, book.shape)
        m = C.Moves(book[None], new[None])
        code, upper, lower, n = C.reassign(x, code, upper, lower, new, m.own[0], m.others[0], m.half[0])
        want, nearest, other = C.nearest(x, new)
        assert (code == want).all() and (upper**2 >= nearest * (1 - 1e-12)).all() and (lower**2 <= other * (1 + 1e-12)).all()
        upper, lower = C._narrow(upper, np.inf).astype(float), np.maximum(C._narrow(lower, -np.inf), 0).astype(float)
        book, measured = new, measured + n
    if len(book) > 1 and spread > 3:
        assert measured < 4 * len(x)  # some full searches are spared


def test_codes_equal_plain_ones(spark):
    rng = np.random.default_rng(3)
    rows = [(k, [float(np.float32(x)) for x in rng.normal(0, 0.2, 12)], k % 3, "x", 1) for k in range(150)]
    rows += [(500 + k, rows[k % 5][1], None, "x", 1) for k in range(40)]
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(5)
    coded, books = C.compress(vectors, keep=("vec_id", "label"), parts=4, entries=20)
    got = {r.vec_id: (list(r.code), r.error) for r in coded.collect()}
    whole = [[math.floor(256 * x) for x in r[1]] for r in rows]
    code, error, want = plain_codes(whole, 4, 20, 2)
    assert [got[r[0]] for r in rows] == [(c, e) for c, e in zip(code, error, strict=True)]
    assert all((books[p] == want[p]).all() for p in range(4)) and C.digest(books) == C.digest(np.array(want))
    back = C.expand(bytes(code[0]), books)
    assert round(((back * 256 - np.array(whole[0])) ** 2).sum()) == error[0]


def test_defined_cases(spark, tmp_path):
    v = [0.5, -0.25, 0.125, 1.0]
    rows = [(3, v, 1, "", 0), (3, v, 1, "", 0), (None, [0.25] * 4, 2, "", 0), (4, [0.5, None, 0.1, 0.2], 1, "", 0), (5, None, 1, "", 0), (6, [float("nan")] * 4, 1, "", 0), (7, [float("inf")] * 4, 1, "", 0)]
    rows += [(8, [], None, "", 0), (9, [1e30, -1e30, 0.0, 0.0], None, "", 0), (10, [0.5], 1, "", 0)]
    table = spark.createDataFrame(rows, SCHEMA)
    coded, books = C.compress(table, keep=("vec_id", "label"), parts=2, entries=3)
    assert sorted((r.vec_id is None, r.vec_id or 0) for r in coded.collect()) == [(False, 3), (False, 3), (False, 8), (False, 9), (False, 10), (True, 0)]
    assert books.shape == (2, 3, 2)
    few, books = C.compress(table.where("vec_id = 3"), parts=2, entries=3)
    assert [(bytes(r.code), r.error) for r in few.collect()] == [(b"\0\0", 0)] * 2 and books.shape == (2, 2, 2)
    assert C.compress(table.limit(0), keep=("vec_id",))[0].collect() == []
    for part, n in ((table, 6), (table.limit(0), 0)):
        part.write.mode("overwrite").parquet(f"{tmp_path}/embeddings.parquet")
        got = C.op11_vector_codes(spark, str(tmp_path)).collect()
        assert len(got) == n
        assert all(r.label_error == sum(x.error for x in got if x.label_error == r.label_error and r.vec_id in (8, 9)) for r in got if r.vec_id in (8, 9))
