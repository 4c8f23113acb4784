"""Filter interaction audit: what filters remove alone, together and in every order; duplicates by partition refinement.

Each text is measured once: which of the filters A to D it fails, its length in code points, and hashes of its successive
blocks, which double in length. Rows of one part, mask, label and refinement key are counted together from there on, so
that a group of copies of any size is a few rows. Refinement begins with classes of equal length; each round splits the
classes by the next block's hash and drops those with one row left. Only texts of classes that come through the last round
are compared, whole: an aggregate by the text itself, which sends each distinct text of a task once. Rows that aren't the
smallest id of their text fail E. Should two texts agree in length and all hashes, their class is told apart by its texts.

From the counts by mask, a filter's figures follow from the set of filters before it, 16 for each filter, whatever the order.

Defined cases: a null text counts as empty, a null source as the empty part; a row without doc_id has no label, and never
fails E nor makes others fail; rows that repeat an id and a text don't make each other fail; of several labels of one id any
counts; texts of any length are read whole, their words told apart by 64-bit hashes; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle, ship, unsettle
from . import _text as X

LETTERS = "ABCDE"
#: Words that A asks for; share of distinct words for B, of capitals for C, in percent.
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 2
#: Bytes of a text's first block; each block is as long as all before it together.
FIRST_BLOCK = 256
#: Bits of the filter that keeps texts of no class out of the comparison: so many a class, and at most so many in all.
FILTER_BITS_EACH, FILTER_BITS = 16, 1 << 26

_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in "#$%&*|"]] = True

SpanHashes = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def _distinct(words: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    order = np.lexsort((words, doc))
    w, d = words[order], doc[order]
    first = np.ones(w.size, bool)
    first[1:] = (w[1:] != w[:-1]) | (d[1:] != d[:-1])
    return np.bincount(d[first], minlength=n_docs)


def _word_counts(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and distinct words of each text; a giant one goes window by window, and of each only its distinct words stay."""
    n = off.size - 1
    if data.size <= X.WINDOW_BYTES:
        starts, ends = X.spans(~X.SEPARATOR[data], off)
        doc = X.doc_of(starts, off)
        return np.bincount(doc, minlength=n), _distinct(X.span_hashes(data, starts, ends), doc, n)
    words, distinct = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for k, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True)):
        seen = np.zeros(0, np.uint64)
        for x, y in X.windows(data[a:b]):
            part = data[a + x : a + y]
            starts, ends = X.spans(~X.SEPARATOR[part], np.array([0, part.size]))
            words[k] += starts.size
            seen = np.union1d(seen, X.span_hashes(part, starts, ends))
        distinct[k] = seen.size
    return words, distinct


def block_hashes(data: np.ndarray, off: np.ndarray, span_hashes: SpanHashes = X.span_hashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the successive blocks of each text, one text after another, and where each text's begin (and the last's end)."""
    size = np.diff(off)
    levels = np.ceil(np.log2(np.maximum(size, 1) / FIRST_BLOCK)).clip(0).astype(np.int64) + (size > 0)
    at = np.concatenate([[0], np.cumsum(levels)])
    doc = np.repeat(np.arange(size.size), levels)
    level = np.arange(at[-1]) - at[doc]
    begin = np.where(level > 0, FIRST_BLOCK << np.maximum(level - 1, 0), 0)
    return span_hashes(data, off[doc] + begin, off[doc] + np.minimum(FIRST_BLOCK << level, size[doc])), at


def signs(points: np.ndarray, hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One number of each text's length and block hashes."""
    doc = np.repeat(np.arange(points.size), np.diff(at))
    placed = X.mix(hashes + X.mix(np.arange(hashes.size, dtype=np.uint64) - at[doc].astype(np.uint64) + np.uint64(1)))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(placed)])
    return X.mix(total[at[1:]] - total[at[:-1]] + X.mix(points.astype(np.uint64))).view(np.int64)


def measured(docs: DataFrame, span_hashes: SpanHashes = X.span_hashes, only: np.ndarray | None = None) -> DataFrame:
    """(doc_id, part, mask of A to D as bits, n code points, blocks, sign) of each row.

    With ``only``, a bit array over signs, just the rows with an id that it holds, and their texts.
    """
    spark = docs.sparkSession
    ship(spark)
    sent = None if only is None else spark.sparkContext.broadcast(only)  # at most FILTER_BITS

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        X.begin()
        for batch in batches:
            texts = X.text_column(batch.column(2))
            mask, points, sign = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            hashes, ends = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
            for a, b, data, off in X.blocks(texts):
                n_words, distinct = _word_counts(data, off)
                n = points[a:b] = X.per_doc(X.code_points(data), off)
                fails = (n_words < LEAST_WORDS, 100 * distinct < DISTINCT_PERCENT * n_words, 100 * X.per_doc(_CAPITAL[data], off) > CAPITAL_PERCENT * n, X.per_doc(_MARK[data], off) > 0)
                mask[a:b] = sum(f.astype(np.int32) << k for k, f in enumerate(fails))
                h, at = block_hashes(data, off, span_hashes)
                sign[a:b] = signs(n, h, at)
                hashes.append(h)
                ends.append(at[1:] + ends[-1][-1])
            blocks = pa.ListArray.from_arrays(pa.array(np.concatenate(ends).astype(np.int32)), pa.array(np.concatenate(hashes).view(np.int64)))
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(mask), pa.array(points), blocks, pa.array(sign)], names=["doc_id", "part", "mask", "n", "blocks", "sign"])
            if sent is not None:
                bit = sign & (sent.value.size * 64 - 1)
                hit = np.flatnonzero((sent.value[bit >> 6] >> (bit & 63)) & 1)
                out = pa.RecordBatch.from_arrays([*out.columns, batch.column(2).cast(pa.large_string()).fill_null("")], names=[*out.schema.names, "text"]).take(pa.array(hit)).drop_columns(["sign"])
                out = out.set_column(5, "text", out.column(5).cast(pa.string()))
            yield out

    kind = docs.schema["doc_id"].dataType.simpleString()
    told = f"doc_id {kind}, part string, mask int, n bigint, blocks array<bigint>" + (", sign bigint" if only is None else ", text string")
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), "text")
    return (rows if only is None else rows.where("doc_id IS NOT NULL")).mapInArrow(found, told)


def refined(rows: DataFrame) -> DataFrame:
    """(n, blocks, sign) of the classes that hold two rows or more, of ``rows`` (n, blocks, sign): split by length, then by block after block.

    Equal rows are counted together first, so that copies are one row of each round.
    """
    alive, depth, more = settle(rows.groupBy("n", "blocks", "sign").agg(F.count("*").alias("rows")), "classes"), 0, True
    while more:
        prefix = F.slice("blocks", 1, depth).alias("prefix")
        sizes = alive.select("n", prefix, "rows").groupBy("n", "prefix").agg(F.sum("rows").alias("together")).where("together > 1").select("n", "prefix")
        replaced, alive = alive, settle(alive.select("*", prefix).join(sizes, ["n", "prefix"], "left_semi").select("n", "blocks", "sign", "rows"), "classes")
        unsettle(replaced)
        depth += 1
        more = bool(alive.where(F.size("blocks") >= depth).limit(1).count())
    return alive


def bits_of(classes: DataFrame) -> np.ndarray:
    """A bit array over the classes' signs: FILTER_BITS_EACH a class and at most FILTER_BITS; beyond that more texts pass, none is lost."""
    bits = min(FILTER_BITS, 1 << max(16, (classes.count() * FILTER_BITS_EACH).bit_length()))
    bit = F.col("sign").bitwiseAND(F.lit(bits - 1))
    words = classes.select(F.shiftright(bit, 6).alias("word"), bit.bitwiseAND(F.lit(63)).cast("int").alias("bit")).groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    out, held = np.zeros(bits // 64, np.int64), words.toArrow()  # at most FILTER_BITS / 64 rows
    out[held["word"].to_numpy()] = held["bits"].to_numpy()
    return out


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with good and toxic, 1 where a label of their doc_id says so."""
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    named = rows.where("doc_id IS NOT NULL").join(known, "doc_id", "left").unionByName(rows.where("doc_id IS NULL"), allowMissingColumns=True)
    return named.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})


def failure_counts(docs: DataFrame, labels: DataFrame, span_hashes: SpanHashes = X.span_hashes) -> DataFrame:
    """(part, mask of A to E as bits, good, toxic, rows) over all rows."""
    rows = settle(measured(docs, span_hashes), "measured")
    classes = refined(rows.where("doc_id IS NOT NULL").select("n", "blocks", "sign"))
    hits = measured(docs, span_hashes, bits_of(classes))
    unsettle(classes)
    texts = hits.groupBy("n", "blocks", "text").agg(F.min("doc_id").alias("lowest"))  # whole texts are the key
    told = settle(texts.groupBy("n", "blocks").agg(F.count("*").alias("texts"), F.min("lowest").alias("lowest")), "told")

    key, last = ["part", "mask", "good", "toxic"], F.lit(1 << LETTERS.index("E"))
    each = labelled(rows.groupBy("doc_id", "part", "mask", "n", "blocks").agg(F.count("*").alias("rows")), labels)
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "rows")))
    alike = each.groupBy(*key, "n", "blocks").agg(F.sum("rows").alias("rows"), first.alias("first"), F.sum(F.when(F.col("doc_id").isNull(), F.col("rows")).otherwise(0)).alias("nameless"))
    alike = alike.join(told, ["n", "blocks"], "left").where("texts IS NULL OR texts = 1")
    stay = F.when(F.col("lowest").isNull(), F.col("rows")).otherwise(F.col("nameless") + F.when(F.col("first.doc_id") == F.col("lowest"), F.col("first.rows")).otherwise(0))
    split = alike.withColumn("stay", stay).select(*key, F.explode(F.array(F.struct(F.lit(0).alias("e"), F.col("stay").alias("rows")), F.struct(last.alias("e"), (F.col("rows") - F.col("stay")).alias("rows")))).alias("x"))
    counts = split.select("part", (F.col("mask") + F.col("x.e")).alias("mask"), "good", "toxic", "x.rows")
    several = told.where("texts > 1").select("n", "blocks")
    if several.limit(1).count():  # texts that agree in length and all hashes: told apart row by row
        apart = settle(hits.join(several, ["n", "blocks"], "left_semi"), "apart")
        lowest = apart.groupBy("n", "blocks", "text").agg(F.min("doc_id").alias("lowest"))
        apart = labelled(apart.join(lowest, ["n", "blocks", "text"]).select("doc_id", "part", (F.col("mask") + F.when(F.col("doc_id") > F.col("lowest"), last).otherwise(0)).alias("mask")), labels)
        nameless = rows.where("doc_id IS NULL").join(several, ["n", "blocks"], "left_semi").select("part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
        counts = counts.unionByName(apart.select(*key).unionByName(nameless).withColumn("rows", F.lit(1).cast("long")))
    return counts.groupBy(*key).agg(F.sum("rows").alias("rows")).where("rows > 0")


def audit(counts: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) from the counts by mask."""
    bits, spark = range(len(LETTERS)), counts.sparkSession
    sets = [(1 << b, s) for b in bits for s in range(1 << len(LETTERS)) if not s >> b & 1]
    lone = F.explode(F.array(*[F.struct(F.lit(b).alias("bit"), F.lit(s).alias("before")) for b, s in sets]))
    df = counts.select("part", "mask", "good", "toxic", "rows", lone.alias("at")).select("*", "at.*")
    fails, passed = F.col("mask").bitwiseAND(F.col("bit")) > 0, F.col("mask").bitwiseAND(F.col("before")) == 0

    def total(when: Column) -> Column:
        return F.sum(F.when(when, F.col("rows")).otherwise(0))

    sums = df.groupBy("part", "bit", "before").agg(
        total(~fails & passed).alias("kept"), total(fails & passed).alias("removed"), total(fails & ~passed).alias("redundant"), total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(fails & passed & (F.col("good") == 1)).alias("good_lost"), total(fails & passed & (F.col("toxic") == 1)).alias("toxic_lost"),
    )
    n_before, others = F.bit_count("before"), len(LETTERS) - 1
    orders = F.factorial(n_before) * F.factorial(F.lit(others) - n_before)  # in which just these filters come before
    shares = sums.groupBy("part", "bit").agg(F.sum(F.col("removed") * orders).alias("shapley"))
    steps = [("".join(p), k + 1, 1 << LETTERS.index(x), sum(1 << LETTERS.index(y) for y in p[:k])) for p in permutations(LETTERS) for k, x in enumerate(p)]
    table = F.broadcast(spark.createDataFrame(steps, "filter_order string, step int, bit int, before int"))  # 600 rows
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return sums.join(shares, ["part", "bit"]).join(table, ["bit", "before"]).select("part", "filter_order", "step", *names)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five filters' audit over all documents; nulls, ties and repeats as the module states."""
    counts = failure_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return audit(settle(counts, "counts"))
