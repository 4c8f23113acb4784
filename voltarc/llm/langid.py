"""Language ID with n-gram filters that answer for all languages at once.

A filter is an array of slots; each slot holds one bit a language (a bit-sliced Bloom filter: slice l is language l's own
Bloom filter). An n-gram is put into every language in whose training texts it is common; looking it up ANDs its slots and
yields the bitmask of all languages that contain it. A document's popcount for a language is the number of its n-grams
whose mask has that bit; it is corrected for the slice's false-positive rate, and the largest corrected count decides.

Defined cases: a null text, and one without a letter, is ``und`` with score 0; without training rows every text is
``und``; n-grams that no language has leave the commonest training language with score 0; ties go to the first language
in alphabetical order; giant texts are read in windows cut at blanks; rows are judged each for itself, so repeated rows agree; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..session import quoted, settle, ship
from . import _text as X
from .quality import numbered

#: Training texts a language at most, chosen by a hash of doc_id.
TRAIN_PER_LANGUAGE = 3_000
#: N-grams a language at most that enter the filter, the commonest first; of equally common ones all or none.
GRAMS_PER_LANGUAGE = 30_000
#: An n-gram belongs to each language whose rate is at least this share of the largest rate of any language.
RATE_SHARE = 0.34
SLOTS_LOG2 = 20
HASHES = 3
UNDETERMINED = "und"
#: Below this share of the corrected counts the pipeline drops a document.
MIN_SCORE = 0.30
#: The pipeline also wants a coverage (corrected count over all n-grams of the document) midway between these quantiles of
#: a language's own training texts and of the other languages' ones.
OWN_QUANTILE, OTHER_QUANTILE = 0.02, 0.98
BINS = 1000

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True


def grams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """4-byte windows of lower-cased texts, non-letters as one blank, and the position each begins at.

    A window holds a blank only at its ends, and lies inside one document.
    """
    if data.size < 4:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    low = X.lowered(data)
    letter = _LETTER[low]
    low[~letter] = 32
    wide = low.astype(np.uint32)
    window = wide[:-3] | (wide[1:-2] << np.uint32(8)) | (wide[2:-1] << np.uint32(16)) | (wide[3:] << np.uint32(24))
    good = letter[1:-2] & letter[2:-1] & (letter[:-3] | letter[3:])
    for border in (1, 2, 3):
        at = off[1:-1] - border
        good[at[(at >= 0) & (at < good.size)]] = False
    first = np.flatnonzero(good)
    return window[first], first


def slots(gram: np.ndarray) -> list[np.ndarray]:
    h = X.mix(gram.astype(np.uint64) + np.uint64(0x9E37))
    step = (h >> np.uint64(32)) | np.uint64(1)
    return [((h + np.uint64(k) * step) & np.uint64((1 << SLOTS_LOG2) - 1)).astype(np.int64) for k in range(HASHES)]


@dataclass
class Filter:
    languages: list[str]
    default: int
    masks: np.ndarray  # (words of 64 languages, slots)
    false_rate: np.ndarray

    @staticmethod
    def build(members: dict[str, np.ndarray], default: str) -> Filter:
        """``members``: the n-grams of each language."""
        names = sorted(members)
        masks = np.zeros(((len(names) + 63) // 64, 1 << SLOTS_LOG2), np.uint64)
        for i, name in enumerate(names):
            for s in slots(members[name]):
                masks[i // 64, s] |= np.uint64(1 << (i % 64))
        fill = np.array([((masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(names))])
        if len(names) <= 8:
            masks = masks.astype(np.uint8)
        return Filter(names, names.index(default), masks, fill**HASHES)

    def lookup(self, gram: np.ndarray) -> np.ndarray:
        """Bitmasks of the languages that contain each n-gram."""
        out = None
        for s in slots(gram):
            out = self.masks[:, s] if out is None else out & self.masks[:, s]
        return out

    def known(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Corrected counts (languages, documents) of a block, and the numbers of n-grams."""
        if data.size > X.WINDOW_BYTES:  # giant texts by windows that share the blank between them
            parts = [[self._raw(text[a : b + 1], np.array([0, text[a : b + 1].size])) for a, b in X.windows(text)] for text in (data[x:y] for x, y in zip(off[:-1], off[1:], strict=True))]
            counts, total = (np.concatenate([sum(p[k] for p in own) for own in parts], axis=-1) for k in (0, 1))
        else:
            counts, total = self._raw(data, off)
        rate = self.false_rate[:, None]
        return np.maximum(0.0, (counts - total * rate) / (1 - rate)), total

    def _raw(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Popcounts (languages, documents), and the numbers of n-grams."""
        n = off.size - 1
        gram, first = grams(data, off)
        doc = X.doc_of(first, off)
        total = np.bincount(doc, minlength=n).astype(float)
        distinct, which = np.unique(gram, return_inverse=True)
        mask = self.lookup(distinct)[:, which]
        one = mask.dtype.type(1)
        counts = np.stack([np.bincount(doc, weights=((mask[i // 64] >> mask.dtype.type(i % 64)) & one), minlength=n) for i in range(len(self.languages))])
        return counts, total

    def decide(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language, score and coverage of each document of a block."""
        real, total = self.known(data, off)
        n = total.size
        best, everything = real.argmax(0), real.sum(0)
        top = real.max(0)
        return np.where(top > 0, best, self.default), np.divide(top, everything, out=np.zeros(n), where=everything > 0), np.divide(top, total, out=np.zeros(n), where=total > 0)


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each language: in how many documents an n-gram is found."""
    X.begin()
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        for a, b, data, off in X.blocks(X.text_column(batch.column(1))):
            gram, first = grams(data, off)
            doc = X.doc_of(first, off)
            for lang in sorted(set(langs[a:b])):
                own = (langs[a:b] == lang)[doc]
                pair = np.unique((doc[own].astype(np.uint64) << np.uint64(32)) | gram[own])
                found, n = np.unique((pair & np.uint64(0xFFFFFFFF)).astype(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * found.size, pa.string()), pa.array(found), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])


def training_texts(labelled: DataFrame, per_language: int = TRAIN_PER_LANGUAGE) -> tuple[DataFrame, dict[str, int]]:
    """The rows to learn from, and how many each language has before they are drawn; rows without text or lang don't count."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return rows, sizes
    share = F.create_map(*[F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, min(1.0, per_language / n))])
    return rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.element_at(share, F.col("lang")) * 1_000_000), sizes


def train(labelled: DataFrame, per_language: int = TRAIN_PER_LANGUAGE, most: int = GRAMS_PER_LANGUAGE) -> Filter | None:
    """Learn a filter from (doc_id, text, lang); rows without text or lang don't count. None if there are no rows."""
    spark = labelled.sparkSession
    ship(spark)
    drawn, sizes = training_texts(labelled, per_language)
    if not sizes:
        return None
    counts = drawn.select("lang", "text").mapInArrow(_gram_counts, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    used = {lang: max(1.0, min(per_language, n)) for lang, n in sizes.items()}
    rate = F.col("n") / F.element_at(F.create_map(*[F.lit(x) for pair in sorted(used.items()) for x in pair]), F.col("lang"))
    rated = counts.where("n >= 2").groupBy("gram").agg(F.collect_list(F.struct("lang", "n", rate.alias("rate"))).alias("at")).withColumn("most", F.expr("array_max(transform(at, x -> x.rate))"))
    member = settle(rated.select("gram", F.explode(F.filter("at", lambda x: x["rate"] >= RATE_SHARE * F.col("most"))).alias("x")).select("gram", "x.lang", "x.n"), "grams")
    cut = _least_kept(member.groupBy("lang", "n").agg(F.count("*").alias("grams")).collect(), most)  # at most ``per_language`` counts a language
    kept = member.where(F.col("n") >= F.element_at(F.create_map(*[F.lit(x) for lang in sorted(sizes) for x in (lang, cut.get(lang, 0))]), F.col("lang"))).select("lang", "gram").toPandas()
    members = {lang: np.sort(kept["gram"][kept["lang"] == lang].to_numpy()).astype(np.uint32) for lang in sorted(sizes)}
    default = min(sizes, key=lambda k: (-sizes[k], k))
    return Filter.build(members, default)


def _least_kept(histogram: list, most: int) -> dict[str, int]:
    """For each language: in how many texts an n-gram must be found, so that no more than ``most`` are left."""
    out: dict[str, int] = {}
    for lang in {r["lang"] for r in histogram}:
        total = 0
        for row in sorted((r for r in histogram if r["lang"] == lang), key=lambda r: -r["n"]):
            total += row["grams"]
            if total > most:
                out[lang] = row["n"] + 1
                break
    return out


def least_coverage(labelled: DataFrame, model: Filter) -> np.ndarray:
    """For each language of a model: the coverage under which a text isn't in it, learned from the training texts."""
    names = model.languages
    shared = labelled.sparkSession.sparkContext.broadcast(model)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        X.begin()
        model = shared.value
        found = np.zeros((len(names), 2, BINS + 1), np.int64)  # language, own text or not, coverage
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for a, b, data, off in X.blocks(X.text_column(batch.column(1))):
                real, total = model.known(data, off)
                some = total > 0
                share = np.minimum(BINS, real[:, some] / total[some] * BINS).astype(np.int64)
                for k, name in enumerate(names):
                    np.add.at(found[k], ((langs[a:b][some] == name).astype(np.int64), share[k]), 1)
        at = np.nonzero(found)
        yield pa.RecordBatch.from_arrays([*(pa.array(x.astype(np.int64)) for x in at), pa.array(found[at])], names=["k", "own", "bin", "n"])

    rows = training_texts(labelled)[0].select("lang", "text").mapInArrow(binned, "k bigint, own bigint, bin bigint, n bigint").groupBy("k", "own", "bin").agg(F.sum("n").alias("n")).collect()  # at most 2 x BINS a language
    found = np.zeros((len(names), 2, BINS + 1))
    for row in rows:
        found[row["k"], row["own"], row["bin"]] = row["n"]

    def quantile(n: np.ndarray, q: float) -> float:
        return float(np.searchsorted(np.cumsum(n), q * n.sum())) / BINS if n.sum() else 0.0

    own = np.array([quantile(x[1], OWN_QUANTILE) for x in found])
    other = np.array([quantile(x[0], OTHER_QUANTILE) for x in found])
    return np.minimum(own, (own + other) / 2)


def predict(df: DataFrame, model: Filter | None, keep: list[str] | None = None, text: str = "text", least: np.ndarray | None = None) -> DataFrame:
    """``keep`` (all columns unless given) of ``df``, with lang_pred and score for the whole text.

    With ``least``, the coverage each language wants, texts under that of their language are ``und`` with their score.
    """
    there, back = numbered(df, [c for c in (df.columns if keep is None else keep) if c not in ("lang_pred", "score")])
    return _judged(df.select(*there, F.col(quoted(text)).alias("_text")), model, least).select(*back, "lang_pred", "score")


def _judged(rows: DataFrame, model: Filter | None, least: np.ndarray | None) -> DataFrame:
    """``rows`` but for its last column, a text, with that text's lang_pred and score."""
    spark = rows.sparkSession
    ship(spark)
    kept = rows.columns[:-1]
    shared = spark.sparkContext.broadcast(model)  # at most 2**20 slots

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        X.begin()
        model = shared.value
        for batch in batches:
            texts = X.text_column(batch.column(batch.num_columns - 1))
            names, score = np.full(len(texts), UNDETERMINED, object), np.zeros(len(texts))
            for a, b, data, off in X.blocks(texts) if model else ():
                best, sure, share = model.decide(data, off)
                plain = X.per_doc(((data | 32) >= 97) & ((data | 32) <= 122), off) > 0
                for k in np.flatnonzero(~plain & (off[1:] > off[:-1])):  # no ASCII letter: look at each character
                    plain[k] = any(map(str.isalpha, texts[a + int(k)].as_py()))
                named = plain if least is None else plain & (share >= least[best]) & (share > 0)
                names[a:b] = np.where(named, np.array(model.languages, object)[best], UNDETERMINED)
                score[a:b] = np.where(plain, sure, 0.0)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(kept))), pa.array(names, pa.string()), pa.array(score)], names=[*kept, "lang_pred", "score"])

    return rows.mapInArrow(judged, StructType([*(rows.schema[c] for c in kept), StructField("lang_pred", StringType()), StructField("score", DoubleType())]))


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A language of every text, learned from the rows that aren't held out; nulls, ties and repeats as the module states."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.where(~held_out()))
    return predict(docs.select("doc_id", "text"), model, ["doc_id"]).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def keep_known(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: drops documents without a language, of too little coverage, or with a score under MIN_SCORE.

    Null texts and those without letters go; repeated rows are judged each for itself; without labelled rows nothing is
    known and all go; columns named lang_pred or score, or with dots, come out as they were; an empty table stays empty.
    """
    labelled = docs.where(~held_out())
    model = train(labelled)
    there, back = numbered(docs, docs.columns)
    judged = _judged(docs.select(*there, F.col("text").alias("_text")), model, least_coverage(labelled, model) if model else None)
    return judged.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= MIN_SCORE)).select(*back)
