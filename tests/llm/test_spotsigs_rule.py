"""One fingerprint rule for all texts: anchors choose the chains, content words stand in where anchors are missing."""

import pyarrow as pa
from tests.llm.test_spotsigs import jaccard, plain_sets, texts

from voltarc.llm import _text as X
from voltarc.llm import spotsigs as S


def with_anchors(every):
    body = [f"w{k}" for k in range(200)]
    for k in range(200 // every):
        body.insert((every + 1) * k + 3, "the")
    return " ".join(body)


def near_pair():
    """A text with an anchor every four words, and its copy without one of them."""
    text = with_anchors(4)
    return text, text.replace(" the ", " ", 1)


def likeness(a, b):
    found, counts = S.signatures(X.text_column(pa.array([a, b])))
    return S.likeness(found[: counts[0]], found[counts[0] :])


def test_query_has_one_rule(spark, tmp_path):
    rows = [(k, t) for k, t in enumerate([*texts(60, 4), *near_pair(), None, "", "the of"])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in S.op1_spot_signatures(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows) and got[60].near_next > 0.9
    for k, t in rows:
        t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        edited = t[: len(t) - len(t) // 4] + after[: len(t) // 4]
        assert len(S.read(got[k].fingerprint)) == len(plain_sets(t))
        assert abs(got[k].near_edited - jaccard(plain_sets(t), plain_sets(edited))) < 1e-9
        assert abs(got[k].near_next - jaccard(plain_sets(t), plain_sets(after))) < 1e-9


def test_near_duplicates_has_one_rule(spark):
    rows = [(k, t) for k, t in enumerate(near_pair())]
    got = [r.class_id for r in S.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert len(got) == 2 and len(set(got)) == 1


def test_most_chains_follow_an_anchor():
    """Over the driver's documents: what share of the chains anchors choose, and that edits leave texts alike."""
    import pyarrow.parquet as pq

    docs = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["doc_id", "text"]).sort_by("doc_id")
    whole = [t or "" for t in docs["text"].to_pylist()]
    sets = [plain_sets(t) for t in whole]
    anchored = sum(s[0] != "*" for x in sets for s in x)
    assert anchored > 0.8 * sum(map(len, sets))
    _, counts = S.signatures(X.text_column(pa.array(whole, pa.large_string())))
    assert counts.tolist() == [len(x) for x in sets]
    long = [k for k, t in enumerate(whole) if len(t) > 400]
    near = [jaccard(sets[k], plain_sets(whole[k][: -(len(whole[k]) // 4)] + whole[k - 1][: len(whole[k]) // 4])) for k in long]
    assert sum(near) / len(near) > 0.58
    few = [k for k, x in zip(long, near, strict=True) if x < 0.35]  # texts that repeat one word many times have small sets
    assert len(few) < len(long) / 20 and min(near) > 0.2


def test_words_stand_in_for_missing_anchors():
    """A list of 200 words has the chains of all of them; a changed word costs two. Lost anchors cost what they chose."""
    words = [f"w{k}" for k in range(200)]
    plain = " ".join(words)
    assert len(plain_sets(plain)) == 200 and likeness(plain, plain.replace(" w70 ", " x ")) > 0.95
    body = list(words)
    for k in range(14):
        body.insert(12 * k + 3, "the")
    sparse = " ".join(body)
    lost = likeness(sparse, sparse.replace(" the ", " ", 4))
    assert 0.5 < lost < 0.6  # four of 14 anchors gone, and the words between them stand in
    # an anchor at the head speaks for its neighbourhood alone: the tail is the same in both
    tail = " ".join(words[20:])
    assert likeness("the " + tail, tail) > 0.9
