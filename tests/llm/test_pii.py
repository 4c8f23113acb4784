"""Surrogates: found, typed, formatted, distinct and coreferent."""

import re

from voltarc.llm import pii

ROWS = [
    (1, "Mail the.72@mail3.example.com or THE.72@MAIL3.EXAMPLE.COM!! now"),
    (2, "Call +1 (826) 555-4081 190.137.223.204 or 826-555-4081; +44 20 7946 0958 3.76.85.226."),
    (3, "Card 4111111111111111### and 4111 1111 1111 1111, order 4111111111111112 stays."),
    (4, 'token = "4d44c79e8bf7c55759c4958dd60ed83d2ef8cd4e" TOKEN = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"!! password: "hunter2hunter"'),
    (5, "Frau Anna Schmidt met Herr Peter Schmidt and Mary O’Neill. Herr Schmidt left with Анна Каренина."),
    (6, "Nothing here: 999.300.1.1, 12 apples, 3.14, 2024-01-01, v1.2.3, a@b, 1234567890123456."),
    (7, None),
    (8, ""),
    (9, "again the.72@mail3.example.com"),
    (10, "SSN 078-05-1120, DE89370400440532013000 and DE89 3704 0044 0532 0130 00, 2001:0db8:85a3:0000:0000:8a2e:0370:7334"),
    (3, "Card 4111111111111111### and 4111 1111 1111 1111, order 4111111111111112 stays."),
    (None, "x 10.0.0.1 y"),
]


def luhn(s):
    d = [int(c) for c in re.sub(r"\D", "", s)][::-1]
    return sum(x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(d)) % 10 == 0


def test_texts(spark):
    df = spark.createDataFrame([(a, b, "n") for a, b in ROWS], "doc_id long, text string, n_entities string")
    made = pii.with_surrogates(df)
    assert sorted(made.columns) == sorted(df.columns)
    got = {r.doc_id: r for r in made.collect()}
    assert len(made.collect()) == len(ROWS)
    a, b = re.search(r"Mail (\S+) or (\S+)!! now$", got[1].text).groups()
    assert a.upper() == b and re.fullmatch(r"[a-z]{3}\.\d\d@[a-z]{8}\.example\.(com|net|org)", a) and got[9].text == f"again {a}" and "72" not in a
    m = re.fullmatch(r"Call \+1 (\(\d{3}\) \d{3}-\d{4}) (\S+) or (\d{3}-\d{3}-\d{4}); \+44 (\d\d \d{4} \d{4}) (\S+)\.", got[2].text)
    assert m and "555" not in m[1] + m[3] and all(0 < int(x) < 255 for k in (2, 5) for x in m[k].split(".")) and got[2].n_entities == 5
    m = re.fullmatch(r"Card (\d{16})### and (\d{4} \d{4} \d{4} \d{4}), order 4111111111111112 stays\.", got[3].text)
    assert m and luhn(m[1]) and m[2].replace(" ", "") == m[1] != "4111111111111111"
    m = re.fullmatch(r'token = "([0-9a-f]{40})" TOKEN = "([0-9A-F]{40})"!! password: "([a-z]{6}\d[a-z]{6})"', got[4].text)
    assert m and m[1][:8] != "4d44c79e" and m[3] != "hunter2hunter"
    m = re.fullmatch(r"Frau (\S+) (\S+) met Herr (\S+) (\S+) and (\S+) (\S+)\. Herr (\S+) left with (\S+) (\S+)\.", got[5].text)
    assert m and m[2] == m[4] == m[7] != "Schmidt"
    women, men = pii.GIVEN["latin-f"].split(), pii.GIVEN["latin-m"].split()
    assert m[1] in women and m[1] != "Anna" and m[3] in men and m[5] in women and m[8] in pii.GIVEN["cyrillic-f"].split() and re.fullmatch("[А-Я][а-я]+", m[9])
    assert got[6].text == dict(ROWS)[6] and got[6].n_entities == 0
    assert got[7].text is None and got[7].n_entities == 0 and got[8].text == ""
    m = re.fullmatch(r"SSN (\d{3}-\d{2}-\d{4}), (DE\d{20}) and (DE\d\d( \d{4}){4} \d\d), ([0-9a-f]{4}:){7}[0-9a-f]{4}", got[10].text)
    assert m and m[3].replace(" ", "") == m[2] != "DE89370400440532013000"
    assert got[None].text != "x 10.0.0.1 y" and got[None].n_entities == 1


def test_colliding_surnames_are_redrawn(spark, monkeypatch):
    monkeypatch.setattr(pii, "SYLLABLES", {"latin": ["ta", "to", "ti", "te"], "cyrillic": ["ба", "бо"]})
    names = ["B" + a + b for a in "aeiou" for b in ("lm", "rn", "st", "nd", "ck", "ll", "nk", "pp", "rr", "ss")] + ["Tatata", "Tetite"]
    rows = [(k, f"Mr {n} and again Mr {n}") for k, n in enumerate(names)]
    got = pii.with_surrogates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    made = {}
    for r in got:
        a, b = re.fullmatch(r"Mr (\w+) and again Mr (\w+)", r.text).groups()
        assert a == b and r.n_entities == 2
        made[names[r.doc_id]] = a
    assert len(set(made.values())) == len(names) and not set(made.values()) & set(names)


def test_key_and_plan(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").coalesce(2)
    a = {(r.doc_id, r.text) for r in pii.with_surrogates(df, "one").collect()}
    assert a == {(r.doc_id, r.text) for r in pii.with_surrogates(df.repartition(3), "one").collect()}
    assert a != {(r.doc_id, r.text) for r in pii.with_surrogates(df, "two").collect()}
    plan = pii.with_surrogates(df, "one")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan.replace("PythonRDD", ""))
    assert pii.with_surrogates(df.limit(0)).count() == 0
    stage = pii.mask_stage(spark, df.withColumn("n_chars", pii.F.lit(0).cast("long")), "")
    assert stage.columns == ["doc_id", "text", "n_chars"] and all(r.n_chars == (None if r.text is None else len(r.text)) for r in stage.collect())
