"""The stages one after another, against what is planted in small tables."""

import random

import corpus_pipeline


def test_stages(spark, tmp_path):
    rng = random.Random(8)
    words = {"en": ["the", "with", "house", "water", "thing", "which", "about", "under"], "fr": ["les", "avec", "maison", "leur", "chose", "quelle", "être", "sous"]}
    rows = []
    for k in range(160):
        lang = "en" if k % 2 else "fr"
        vocabulary = words[lang] + [rng.choice(words[lang]) + rng.choice(words[lang]) for _ in range(300)]
        rows.append([k, " ".join(rng.choice(vocabulary) for _ in range(120)), lang, "s", 0])
    for k in range(20):  # junk, as the labels say
        rows.append([200 + k, " ".join(w + "###" for w in rows[k][1].split()), rows[k][2], "s", 0])
    rows.append([300, rows[5][1], "en", "s", 0])
    rows.append([301, rows[7][1] + " tail", "en", "s", 0])
    rows.append([302, "too short", "en", "s", 0])
    rows.append([303, "1 2 3 4 5 6 7 8 9 " * 1 + " ".join(str(k) for k in range(80)), None, "s", 0])
    rows.append([304, None, None, "s", 0])
    rows[9][1] += " write to some.one@mail.example.org now"
    rows = [(a, b, c, d, len(b or "")) for a, b, c, d, _ in rows]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(k, 1, 0) for k in range(60)] + [(200 + k, 0, 0) for k in range(15)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, seen = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append(docs.toPandas())
        assert k == 4 or docs.columns == columns
    good, known, single, masked, packed = seen
    clean = set(range(160))
    assert set(good["doc_id"]) == clean | {300, 301, 303}
    assert set(known["doc_id"]) == clean | {300, 301}
    assert set(single["doc_id"]) == clean
    text = dict(zip(masked["doc_id"], masked["text"], strict=True))
    assert set(text) == clean and "some.one@" not in text[9] and "@" in text[9] and all(text[k] == rows[k][1] for k in clean - {9})
    assert all(n == len(text[k]) for k, n in zip(masked["doc_id"], masked["n_chars"], strict=True))
    assert set(packed["doc_id"]) == clean and packed.groupby("sequence_id")["length"].sum().max() <= 4096
    whole = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert sorted(map(tuple, whole[["doc_id", "length", "ids_crc32"]].values.tolist())) == sorted(map(tuple, packed[["doc_id", "length", "ids_crc32"]].values.tolist()))
