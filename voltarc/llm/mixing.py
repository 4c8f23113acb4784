"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame functions only.

A source's documents are shuffled by a digest of their ids and laid end to end; the words are cut into blocks of equal
size (a source's last one may be shorter). A source with target T and S words takes its blocks T div S times whole and once
up to word T mod S. Each of these block uses is a slot. The slots of all sources divide a line by cumulative counts, and
the van der Corput point of a place of the schedule, its bits reversed, says whose turn it is; reversing bits undoes
itself, so each source finds its own places without a search. Its slots are ranked by place, and the rank names the block
and the turn. So every stretch of the schedule holds each source nearly by its share, and the whole takes exactly what
the targets say, rounded to words.

Targets: weights go to the sources in the order of their code points, null last, and divide all words; a target stops at
MOST_TURNS times its source's words, and the excess goes to the others by weight until none is above.

Work grows with documents and blocks; what is in one task is a slice of a source's documents, of a source's places or the
list of sources. Defined cases: a null or empty text has no words and is never taken; a text of any length lies in as many
blocks as it needs; rows that repeat are documents each; rows with one doc_id stand in the order of their sizes and
checksums; sources without words have target 0; a table without words takes nothing; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import settle

WEIGHTS = (5, 2, 1)
MOST_TURNS = 3
BLOCK_WORDS = 256
#: Slices of a source's documents, each ordered in a task of its own, by the first three digits of the digest.
SLICE_DIGITS = 3
#: Places are ranked in slices of at least 2 ** LEAST_PLACES, and at most 2 ** MOST_SLICES of them; they are made in runs of RUN.
LEAST_PLACES, MOST_SLICES, RUN = 10, 16, 1 << 16
SEED = "mix"
_S = ["_source", "_none"]


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """(doc_id, size, mark, key, slice) of each row and its source as two columns without nulls."""
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(seed)).cast("binary"))
    text = F.coalesce("text", F.lit(""))
    df = docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("_source"), F.col("source").isNull().alias("_none"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("mark"), key.alias("key"),
    )
    return df.withColumn("slice", F.conv(F.substring("key", 1, SLICE_DIGITS), 16, 10).cast("int"))


def slices_of(rows: DataFrame) -> DataFrame:
    """(source, slice, words, before): the words of each slice, and those of its source's slices before it."""
    w = Window.partitionBy(*_S).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    return rows.groupBy(*_S, "slice").agg(F.sum("size").alias("words")).withColumn("before", F.coalesce(F.sum("words").over(w), F.lit(0)))


def targets(slices: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_TURNS) -> DataFrame:
    """(source, k, source_size, target), a row a source: shares by weight, none above ``most`` times the source.

    Capped sources are those that a share by weight reaches first, so they are found in the order of words over weight.
    """
    order = Window.partitionBy(F.lit(0)).orderBy("_none", "_source")
    s = slices.groupBy(*_S).agg(F.sum("words").alias("source_size")).withColumn("k", F.row_number().over(order) - 1)
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("k") % len(weights) + 1))
    everything = Window.partitionBy(F.lit(0))
    first = everything.orderBy(F.col("source_size") / F.col("weight"), "k")
    upto = first.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = s.withColumns({"_all": F.sum("source_size").over(everything), "_w": F.sum("weight").over(everything), "_cap": F.sum("source_size").over(upto) * most, "_cw": F.sum("weight").over(upto)})
    # what a unit of weight gets if the sources before this one are capped; it is capped too if that is more than it can take
    unit = (F.col("_all") - (F.col("_cap") - F.col("source_size") * most)) / (F.col("_w") - (F.col("_cw") - F.col("weight")))
    s = s.withColumn("_full", unit * F.col("weight") > F.col("source_size") * most)
    left = F.col("_all") - F.sum(F.when(F.col("_full"), F.col("source_size") * most).otherwise(0)).over(everything)
    shared = F.sum(F.when(F.col("_full"), 0).otherwise(F.col("weight"))).over(everything)
    s = s.withColumn("target", F.when(F.col("_full"), (F.col("source_size") * most).cast("double")).otherwise(F.coalesce(F.try_divide(left * F.col("weight"), shared), F.lit(0.0)).cast("double")))
    return s.select(*_S, (F.col("k")).cast("int").alias("k"), "source_size", "target")


def planned(sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Adds blocks, turns (whole ones), rest (words of the last turn), slots and begin (slots of the sources before)."""
    words = F.round("target").cast("long")
    size = F.greatest("source_size", F.lit(1))
    df = sources.withColumns({"blocks": F.ceil(F.col("source_size") / block_words), "turns": F.floor(words / size), "rest": F.pmod(words, size)})
    df = df.withColumn("slots", F.col("turns") * F.col("blocks") + F.ceil(F.col("rest") / block_words))
    return df.withColumn("begin", F.sum("slots").over(Window.partitionBy(F.lit(0)).orderBy("k")) - F.col("slots"))


def bit_reversed(c: Column, bits: int) -> Column:
    """The lowest ``bits`` bits of a non-negative number in the opposite order."""

    def swapped(x: Column, by: int) -> Column:
        mask = F.lit(sum(1 << k for k in range(64) if (k // by) % 2 == 0))
        return F.shiftrightunsigned(x, by).bitwiseAND(mask).bitwiseOR(F.shiftleft(x.bitwiseAND(mask), by))

    return F.shiftrightunsigned(reduce(swapped, (1, 2, 4, 8, 16, 32), c), 64 - bits) if bits else F.lit(0).cast("long")


def schedule(sources: DataFrame) -> DataFrame:
    """(place, k, turn, block) of each slot: places order the mix and are distinct, not gapless."""
    whole = sources.agg(F.sum("slots")).collect()[0][0] or 0
    bits = max(0, whole - 1).bit_length()
    runs = sources.where("slots > 0").select("k", "blocks", "begin", "slots", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / RUN))).alias("run"))
    points = runs.repartition("k", "run").select("k", "blocks", F.explode(F.sequence(F.col("begin") + F.col("run") * RUN, F.col("begin") + F.least("slots", (F.col("run") + 1) * RUN) - 1)).alias("point"))
    slots = points.select("k", "blocks", bit_reversed(F.col("point"), bits).alias("place"))
    slots = slots.withColumn("part", F.shiftright("place", max(LEAST_PLACES, bits - MOST_SLICES)))
    w = Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = slots.groupBy("k", "part").agg(F.count("*").alias("n")).select("k", "part", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
    ranked = slots.withColumn("nth", F.row_number().over(Window.partitionBy("k", "part").orderBy("place"))).join(parts, ["k", "part"])
    rank = F.col("before") + F.col("nth") - 1
    return ranked.select("k", "place", F.floor(rank / F.col("blocks")).alias("turn"), F.pmod(rank, F.col("blocks")).alias("block"))


def laid_out(rows: DataFrame, slices: DataFrame, sources: DataFrame) -> DataFrame:
    """(k, doc_id, size, start, nth, turns, rest): each document's place in its source's words; k, start and nth are a row's alone."""
    order = Window.partitionBy(*_S, "slice").orderBy("key", "size", "mark")
    told = slices.join(sources.select(*_S, "k", "turns", "rest"), _S).select(*_S, "slice", "before", "k", "turns", "rest")
    placed = rows.withColumns({"nth": F.row_number().over(order), "upto": F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))})
    return placed.join(told, [*_S, "slice"]).select("k", "doc_id", "size", (F.col("before") + F.col("upto") - F.col("size")).alias("start"), (F.col("slice") * F.lit(1 << 40) + F.col("nth")).alias("nth"), "turns", "rest")


def pieces(placed: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The part of each document that lies in each block: (block, begin, end) in its source's words; without words, one in a block that isn't there."""
    last = F.col("start") + F.col("size")
    nowhere = F.array(-1 - F.pmod(F.xxhash64("nth"), F.lit(1 << 12)))
    cut = placed.withColumn("block", F.explode(F.when(F.col("size") > 0, F.sequence(F.floor(F.col("start") / block_words), F.floor((last - 1) / block_words))).otherwise(nowhere)))
    return cut.withColumns({"begin": F.greatest("start", F.when(F.col("block") >= 0, F.col("block") * block_words)), "end": F.least(last, F.when(F.col("block") >= 0, (F.col("block") + 1) * block_words))})


class Mix:
    """The mix of a table: its ``sources``, its documents laid out, its ``slots`` and what each slot takes.

    ``taken`` holds a row a piece and use of it: place, source number k, turn, doc_id, size, start, nth, first (word of the
    document, from 0) and words; pieces that no slot takes have no words, and those of unused blocks no place.
    """

    def __init__(self, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_TURNS, block_words: int = BLOCK_WORDS, seed: str = SEED) -> None:
        rows = settle(sized(docs, seed), "sized")
        slices = settle(slices_of(rows), "slices")
        self.sources = settle(planned(targets(slices, weights, most), block_words), "sources")
        self.documents = laid_out(rows, slices, self.sources)
        self.slots = schedule(self.sources)
        used = pieces(self.documents, block_words).join(self.slots, ["k", "block"], "left")
        until = F.when(F.col("turn") < F.col("turns"), F.col("end")).when(F.col("turn").isNotNull(), F.least("end", F.greatest("begin", "rest"))).otherwise(F.col("begin"))
        self.taken = used.select("place", "k", "turn", "doc_id", "size", "start", "nth", (F.col("begin") - F.col("start")).alias("first"), (until - F.col("begin")).alias("words"))


def op12_source_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document; nulls, ties and repeats as the module states."""
    mix = Mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    per_doc = mix.taken.groupBy("k", "start", "nth", "doc_id", "size").agg(F.sum("words").alias("taken"))
    return per_doc.join(mix.sources.select("k", "source_size", "target"), "k").select("doc_id", "size", "source_size", "target", "taken")
