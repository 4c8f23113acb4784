"""Quality rules: a decision list learned by sequential covering, emitted as ordered Spark conditional expressions.

``text_statistics`` measures whole texts; ``learn`` grows and prunes threshold conjunctions that name low-quality
documents (each rule grown on two thirds of the labelled rows by information gain, pruned on the last third), and
``verdict`` turns the list into one ``CASE`` expression over the statistics.

Defined cases: a null or empty text has no words and fails the base rule; repeated rows are judged each for itself;
without labels, or with labels of one kind, the list is empty and the base rule alone decides; an empty table gives an
empty result; columns of the input that have a statistic's name are replaced in the output of ``with_statistics``; texts of
any length are measured whole; of tests that gain the same, the first in the order of RATIOS and the lowest threshold win.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import quoted, settle, ship
from . import _text as X

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_digits", "n_punct", "n_lines", "n_code_points")
#: Ratios that rules may test: (name, numerator, denominator).
RATIOS = (
    ("symbols_per_word", "n_symbols", "n_words"),
    ("repeated_share", "n_repeat_words", "n_words"),
    ("dup_line_share", "n_dup_lines", "n_lines"),
    ("mean_word", "word_chars", "n_words"),
    ("upper_share", "n_upper", "word_chars"),
    ("digit_share", "n_digits", "word_chars"),
    ("punct_per_word", "n_punct", "n_words"),
)
#: Labelled documents that the learner reads at most; drawn by a hash of doc_id, of DRAWN values.
MAX_LABELLED = 20_000
DRAWN = 1 << 30
MIN_WORDS = 50

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[ord(c) for c in "!?.,;:"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def _repeated(words: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Words of each document that lie in a 3-word window which the document holds twice or more."""
    window, first = X.ngram_hashes(words, doc, 3)
    if not first.size:
        return np.zeros(n_docs, np.int64)
    key = X.mix(window + X.mix(doc[first].astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    again = np.zeros(first.size, bool)
    again[1:] |= same
    again[:-1] |= same
    hit = first[order[again]]
    covered = np.zeros(words.size, bool)
    for k in range(3):
        covered[hit + k] = True
    return np.bincount(doc[covered], minlength=n_docs)


def _line_counts(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those of them that equal an earlier line; compared as bytes."""
    lines, again = np.zeros(off.size - 1, np.int64), np.zeros(off.size - 1, np.int64)
    whole = data.tobytes()
    for k in range(off.size - 1):
        parts = [x for x in whole[off[k] : off[k + 1]].split(b"\n") if x and not x.isspace()]
        lines[k] = len(parts)
        again[k] = len(parts) - len(set(parts)) if len(parts) > 1 else 0
    return lines, again


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """COUNTS of each text of a large_string array."""
    out = {c: np.zeros(len(texts), np.int64) for c in COUNTS}
    for a, b, data, off in X.blocks(texts):
        word = ~X.SEPARATOR[data]
        starts, ends = X.spans(word, off)
        doc = X.doc_of(starts, off)
        points = X.code_points(data)
        out["n_words"][a:b] = np.bincount(doc, minlength=b - a)
        out["word_chars"][a:b] = X.per_doc(word & points, off)
        out["n_code_points"][a:b] = X.per_doc(points, off)
        for c, table in (("n_symbols", _SYMBOLS), ("n_upper", _UPPER), ("n_digits", _DIGIT), ("n_punct", _PUNCT)):
            out[c][a:b] = X.per_doc(table[data], off)
        out["n_repeat_words"][a:b] = _repeated(X.span_hashes(data, starts, ends), doc, b - a)
        out["n_lines"][a:b], out["n_dup_lines"][a:b] = _line_counts(data, off)
    return out


def numbered(df: DataFrame, names: list[str]) -> tuple[list[Column], list[Column]]:
    """Columns under the plain names _0, _1 and so on, and these under their own names again, whatever those are."""
    return [F.col(quoted(c)).alias(f"_{k}") for k, c in enumerate(names)], [F.col(f"_{k}").alias(c) for k, c in enumerate(names)]


def _measured(rows: DataFrame) -> DataFrame:
    """``rows`` but for its last column, a text, and COUNTS of that; no column may have a name of COUNTS."""
    ship(rows.sparkSession)
    kept = rows.columns[:-1]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        X.begin()
        for batch in batches:
            found = statistics(X.text_column(batch.column(batch.num_columns - 1)))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(kept))), *(pa.array(found[c]) for c in COUNTS)], names=[*kept, *COUNTS])

    return rows.mapInArrow(measured, StructType([*(rows.schema[c] for c in kept), *(StructField(c, LongType()) for c in COUNTS)]))


def with_statistics(df: DataFrame, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """``keep`` (all columns unless given) of ``df`` and COUNTS of the whole text."""
    there, back = numbered(df, [c for c in (df.columns if keep is None else keep) if c not in COUNTS])
    return _measured(df.select(*there, F.col(quoted(text)).alias("_text"))).select(*back, *COUNTS)


def ratio_columns() -> dict[str, Column]:
    return {name: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0)) for name, a, b in RATIOS} | {"n_words": F.col("n_words").cast("double")}


@dataclass(frozen=True)
class Rule:
    """A conjunction of (feature, '<=' or '>', threshold)."""

    tests: tuple[tuple[str, str, float], ...]

    def column(self) -> Column:
        have, out = ratio_columns(), F.lit(True)
        for name, op, at in self.tests:
            out = out & ((have[name] <= at) if op == "<=" else (have[name] > at))
        return out

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(table.values()))), bool)
        for name, op, at in self.tests:
            out &= (table[name] <= at) if op == "<=" else (table[name] > at)
        return out


def _best_test(table: dict[str, np.ndarray], bad: np.ndarray, covered: np.ndarray) -> tuple[tuple[str, str, float], float]:
    """The threshold test with the largest information gain among the covered rows."""
    y = bad[covered]
    p0, n0 = y.sum(), (~y).sum()
    base = np.log2(p0 / (p0 + n0))
    best, gain = ("", "", 0.0), 0.0
    for name, values in table.items():
        v = values[covered]
        order = np.argsort(v, kind="stable")
        v, z = v[order], y[order]
        cut = np.flatnonzero(v[1:] > v[:-1])
        if not cut.size:
            continue
        p = np.cumsum(z)[cut]
        n = np.cumsum(~z)[cut]
        for op, pos, neg in (("<=", p, n), (">", p0 - p, n0 - n)):
            with np.errstate(divide="ignore", invalid="ignore"):
                g = np.where(pos > 0, pos * (np.log2(pos / (pos + neg)) - base), -1.0)
            k = int(np.argmax(g))
            if g[k] > gain + 1e-9:
                best, gain = (name, op, float((v[cut[k]] + v[cut[k] + 1]) / 2)), float(g[k])
    return best, gain


def learn(table: dict[str, np.ndarray], bad: np.ndarray, max_rules: int = 12, max_tests: int = 4, min_precision: float = 0.9, min_cover: int = 3) -> list[Rule]:
    """Sequential covering: rules for the rows where ``bad`` holds, the most telling first.

    Each rule is grown greedily on two thirds of the rows that no earlier rule covers, then its last tests are dropped
    while that doesn't lower (p - n) / (p + n) on the other third. A rule stays if, over both parts, it covers
    ``min_cover`` rows at least with a Laplace precision of ``min_precision``; else learning ends. Rows left over are kept.
    """
    rules: list[Rule] = []
    left = np.ones(bad.size, bool)
    part = np.arange(bad.size) % 3 == 2
    while len(rules) < max_rules and (bad & left).sum() >= min_cover:
        grow, check = left & ~part, left & part
        covered, tests = grow.copy(), []
        while len(tests) < max_tests and bad[covered].any() and not bad[covered].all():
            test, gain = _best_test(table, bad, covered)
            if not test[0] or gain <= 0:
                break
            tests.append(test)
            covered = grow & Rule(tuple(tests)).holds(table)
        if not tests:
            break

        def worth(k: int, tests: list = tests, check: np.ndarray = check) -> float:
            hit = check & Rule(tuple(tests[:k])).holds(table)
            return float(((bad & hit).sum() - (~bad & hit).sum()) / max(1, hit.sum()))

        keep = max(range(1, len(tests) + 1), key=lambda k: (round(worth(k), 9), -k))
        rule = None
        for k in range(keep, len(tests) + 1):  # the pruned rule, or the shortest longer one that is sure enough
            hit = left & Rule(tuple(tests[:k])).holds(table)
            if hit.sum() >= min_cover and ((bad & hit).sum() + 1) / (hit.sum() + 2) >= min_precision:
                rule = Rule(tuple(tests[:k]))
                break
        if rule is None:
            break
        rules.append(rule)
        left &= ~rule.holds(table)
    return rules


def verdict(rules: list[Rule]) -> Column:
    """True where the document is kept: CASE WHEN rule 1 THEN false WHEN rule 2 ... ELSE true."""
    out = F.lit(True)
    for rule in reversed(rules):
        out = F.when(rule.column(), F.lit(False)).otherwise(out)
    return out


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def labelled_texts(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame | None:
    """(doc_id, text, quality) of about ``most`` labelled documents, drawn by a hash of doc_id before a text is read.

    Of rows with one doc_id the smallest text counts, and its lowest label, so that repeated rows don't weigh more.
    """
    marks = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    marks = settle(marks, "labels")
    n = marks.count()
    if not n:
        return None
    chosen = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(DRAWN)) < F.lit(int(min(1.0, most / n) * DRAWN)))  # about ``most`` rows at any size
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("quality").alias("quality"))


def learn_from(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> list[Rule]:
    """Rules learned from ``labels`` (doc_id, quality: 1 good, 0 bad) on ``most`` documents that pass the base rule, at most."""
    drawn = labelled_texts(docs, labels, most)
    if drawn is None:
        return []
    names = [n for n, _, _ in RATIOS] + ["n_words"]
    have = ratio_columns()
    rows = (
        _measured(drawn.select("doc_id", "quality", "text")).where(~base_failed())
        .select("doc_id", "quality", *[have[n].alias(f"f_{n}") for n in names])
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).toPandas()
    )
    bad = rows["quality"].to_numpy() == 0
    if not bad.any() or bad.all():
        return []
    return learn({n: rows[f"f_{n}"].to_numpy(float) for n in names}, bad)


def judge(measured: DataFrame, rules: list[Rule]) -> DataFrame:
    """base_failed and kept for rows that have COUNTS."""
    return measured.withColumns({"base_failed": base_failed(), "kept": F.when(base_failed(), F.lit(False)).otherwise(verdict(rules))})


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every text, the base rule and the learned list's verdict; nulls, empty tables and repeats as the module states."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rules = learn_from(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judge(with_statistics(docs, ["doc_id"]), rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the rules keep, with the columns they came with.

    Null, empty and short texts go, as the base rule says; repeated rows are judged each for itself; columns named like a
    statistic, a verdict or with dots come out as they were; an empty table stays empty.
    """
    rules = learn_from(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"))
    there, back = numbered(docs, docs.columns)
    return judge(_measured(docs.select(*there, F.col("text").alias("_text"))), rules).where("kept").select(*back)
