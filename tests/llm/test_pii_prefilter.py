"""The look for what patterns need is true wherever the pattern matches."""

import random

from pyspark.sql import functions as F

from voltarc.llm import pii

HELD = [
    "Jean-Pierre Dupont left.", "Anna-Maria Schmidt left.", "so ...Anna Schmidt left", "-Dr. Meyer left", "_Frau Meyer_", "г-н Каренин", "(г-жа Каренина)", "x’Anna Schmidt",
    "key abcdefabcdefabcdefabcdefabcdefab", "host abcd:abcd:abcd:abcd:abcd:abcd:abcd:abcd", "PASSWORD = 'huntershunters'", "apiİkey: 'huntershunters'",
]


def test_true_for_every_match(spark):
    rng = random.Random(5)
    parts = [*pii.TITLES, *(n for x in pii.GIVEN.values() for n in x.split()), "Meyer", "Каренин", "O’Neill", "token", "Secret", "api key", "huntershunters", "abcdef" * 6, "a@b.com", "1", "ab:cd", "x", "É"]
    glue = [" ", " ", " ", ".", "-", "...", ". ", "’", "'", '"', "=", ": ", "_", "#", "\n", "/", ""]
    rows = HELD + ["".join(rng.choice(parts) + rng.choice(glue) for _ in range(rng.choice([2, 3, 5]))) for _ in range(4000)]
    df = spark.createDataFrame([(t,) for t in rows], "text string")
    got = df.select("text", F.col("text").rlike(pii.PATTERN).alias("matches"), pii.may_hold(F.col("text")).alias("looked")).collect()
    assert [r.text for r in got if r.matches and not r.looked] == []
    assert all(r.matches for r in got if r.text in HELD) and sum(r.matches for r in got) > 500


def test_names_beside_points_and_hyphens_are_replaced(spark):
    rows = [(k, t) for k, t in enumerate(HELD[:8])]
    for r in pii.with_surrogates(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert r.n_entities == 1 and not any(n in r.text for n in ("Dupont", "Schmidt", "Meyer", "Каренин"))
