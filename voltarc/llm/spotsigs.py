"""SpotSigs fingerprints: chains of content words after common-word anchors, compared by Jaccard.

Every common word of a text is an anchor; the next CHAIN content words after it, with the anchor, are a spot signature.
A text's fingerprint is the set of its signatures, written as sorted hexadecimal words. Where anchors are missing, content
words stand in for them: one that has no anchor among the GAP words before it begins a chain of its own, so that lists,
headings and other languages have a fingerprint too. The rule looks at no more than the words before, in every text, so an
edit changes chains near itself alone.

``near_duplicates`` compares a whole table by ``setjoin``: its size classes partition the sets by length, each set meets its
own class and the next, and inside a block sets are pruned by length and by the signatures that they can still share. Empty
texts get no class there.

Defined cases: a null text counts as empty; empty texts have the empty fingerprint and likeness 1 to each other, 0 to any
other; texts without words have one signature, of their characters; texts of any length are fingerprinted whole, and the
words of a giant one are hashed in windows; repeated rows are documents of their own, in the order
of doc_id and then text; null doc_ids come first; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from . import _text as X
from .setjoin import jaccard_components

CHAIN = 2
#: A content word with no anchor among so many words before it begins a chain too.
GAP = 12
#: Documents in a range of doc_id, and the most ranges; a range is a task of its own and streamed, so its size bounds no memory.
ROWS_A_RANGE = 4000
MOST_RANGES = 20_000
#: Common words of English, French, German and Spanish (fixed values).
ANCHORS = (
    "a an the of and to in is it that was for on are as with be at by this from or were not have had has will would can could there which "
    "le la les un une des du de et en est dans par pour que qui sur au aux avec ne pas ce il elle se "
    "der die das ein eine und zu den dem im von mit ist nicht auf für als auch es an "
    "el los las una y es del al lo con no su para como más se por"
).split()

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = True
_WORD[128:] = True


def _hash_words(words: list[str]) -> np.ndarray:
    data = " ".join(sorted(set(words))).encode()
    flat = np.frombuffer(data, np.uint8)
    starts, ends = X.spans(_WORD[flat], np.array([0, flat.size]))
    return np.sort(X.span_hashes(flat, starts, ends))


_ANCHOR_HASHES = _hash_words(ANCHORS)


def signatures(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 32-bit signatures of each text of a large_string array, and their numbers."""
    found, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for a, b, data, off in X.blocks(texts):
        n = b - a
        low = X.lowered(data)
        starts, ends = X.spans(_WORD[data], off)
        words, doc = X.span_hashes(low, starts, ends), X.doc_of(starts, off)
        anchor = _ANCHOR_HASHES[np.minimum(np.searchsorted(_ANCHOR_HASHES, words), _ANCHOR_HASHES.size - 1)] == words
        content, owner = words[~anchor], doc[~anchor]
        after = np.cumsum(~anchor)  # content words up to and with each word
        spots = np.flatnonzero(anchor)
        parts = [_chains(words[spots], doc[spots], after[spots], content, owner)]
        far = np.flatnonzero(_far(anchor, doc, n))
        parts.append(_chains(np.full(far.size, 7, np.uint64), doc[far], after[far] - 1, content, owner))
        bare = np.flatnonzero((np.bincount(doc, minlength=n) == 0) & (off[1:] > off[:-1]))
        whole = np.array([int.from_bytes(hashlib.sha256(data[off[k] : off[k + 1]].tobytes()).digest()[:8], "little") for k in bare], np.uint64)
        only = np.flatnonzero((np.bincount(owner, minlength=n) == 0) & (np.bincount(doc, minlength=n) > 0))  # common words alone
        lone = np.isin(doc, only)
        sig = np.concatenate([*(p[0] for p in parts), whole, words[lone]])
        at = np.concatenate([*(p[1] for p in parts), bare, doc[lone]])
        key = np.unique((at.astype(np.uint64) << np.uint64(32)) | (X.mix(sig) >> np.uint64(32)))
        found.append((key & np.uint64(0xFFFFFFFF)).astype(np.uint32))
        counts.append(np.bincount((key >> np.uint64(32)).astype(np.int64), minlength=n))
    return np.concatenate(found), np.concatenate(counts)


def _far(anchor: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Whether each word is a content word without an anchor among the GAP words of its document before it."""
    place = np.arange(anchor.size)
    last = np.maximum.accumulate(np.where(anchor, place, -1))  # place of the last anchor, in whatever document
    first = np.searchsorted(doc, np.arange(n))[doc]
    return ~anchor & (last < np.maximum(first, place - GAP))


def _chains(head: np.ndarray, doc: np.ndarray, first: np.ndarray, content: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signature of each head with up to CHAIN content words from place ``first`` on, as far as its document goes."""
    sig, any_word = head.copy(), np.zeros(head.size, bool)
    for k in range(CHAIN):
        at = first + k
        inside = at < content.size
        inside[inside] = owner[at[inside]] == doc[inside]
        sig[inside] = X.mix(sig[inside] * np.uint64(0x100000001B3) + content[at[inside]])
        any_word |= inside
    return sig[any_word], doc[any_word]


def written(found: np.ndarray, counts: np.ndarray) -> list[str]:
    """Fingerprints as text: 8 hexadecimal digits a signature."""
    data = found.astype(">u4").tobytes().hex()
    end = (np.cumsum(counts) * 8).tolist()
    return [data[a:b] for a, b in zip([0, *end[:-1]], end, strict=True)]


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").astype(np.uint32)


def likeness(x: np.ndarray, y: np.ndarray, least: float = 0.0) -> float:
    """Jaccard of two sorted sets; 0 without counting if their lengths allow no more than ``least``."""
    if not x.size or not y.size:
        return float(x.size == y.size)
    if min(x.size, y.size) < least * max(x.size, y.size):
        return 0.0
    both = np.concatenate([x, y])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return shared / (x.size + y.size - shared)


def length_sets(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signature sets of texts given as bytes and offsets, as 64-bit hashes in order."""
    texts = pa.LargeStringArray.from_buffers(off.size - 1, pa.py_buffer(np.ascontiguousarray(off, np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
    sig, counts = signatures(texts)
    h = X.mix(sig.astype(np.uint64) + np.uint64(1))
    order = np.lexsort((h, np.repeat(np.arange(counts.size), counts)))
    return h[order], counts


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, n_signatures, class_id): documents whose fingerprints have a Jaccard of ``percent`` / 100 or more are in a class."""
    return jaccard_components(docs, percent=percent, sets_of=length_sets).select("doc_id", F.col("n_shingles").alias("n_signatures"), F.col("component_id").alias("class_id"))


def in_ranges(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows (at, follows, doc_id, text, bucket) dealt to ranges of doc_id, and the number of ranges.

    Borders are quantiles of doc_id. The documents with the first doc_id of a range go to the range before it as well,
    where they only follow (``follows``).
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("at"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ids = rows.select("at")
    n = ids.count()
    many = max(1, min(MOST_RANGES, -(-n // ROWS_A_RANGE)))
    cuts = sorted({int(c) for c in ids.approxQuantile("at", [k / many for k in range(1, many)], 0.25 / many)}) if many > 1 else []
    bucket = _range_of(F.col("at"), cuts)
    low = {r["bucket"]: r["low"] for r in ids.select(bucket.alias("bucket"), "at").groupBy("bucket").agg(F.min("at").alias("low")).collect()}  # at most ``many`` rows
    order = sorted(low)
    place = F.array(*[F.lit(order.index(b) if b in low else 0) for b in range(len(cuts) + 1)])
    first = F.array(*[F.lit(low.get(b, 0)).cast("long") for b in range(len(cuts) + 1)])
    dealt = rows.withColumn("b", bucket).withColumns({"bucket": F.get(place, F.col("b")), "first": F.get(first, F.col("b")) == F.col("at")})
    last = max(len(order) - 1, 0)

    def copy(follows: bool, to: Column) -> Column:
        return F.struct(F.lit(follows).alias("follows"), to.cast("int").alias("bucket"))

    own = copy(False, F.col("bucket"))
    wraps = F.col("at") == F.lit(low[order[0]] if order else 0).cast("long")  # after the last document comes the first
    copies = F.when(wraps, F.array(own, copy(True, F.lit(last)))).when(F.col("first"), F.array(own, copy(True, F.col("bucket") - 1))).otherwise(F.array(own))
    spread = dealt.withColumn("c", F.explode(copies)).select((F.col("c.follows") & (F.col("c.bucket") == last) & (F.col("bucket") == 0)).alias("wrapped"), F.col("c.follows").alias("follows"), F.col("c.bucket").alias("bucket"), "at", "doc_id", "text")
    return spread, len(order)


def _range_of(at: Column, cuts: list[int]) -> Column:
    """How many of the sorted cuts are at or below ``at``: first among every 64th, then among the 64 after it."""
    if not cuts:
        return F.lit(0)
    heads = F.array(*[F.lit(c).cast("long") for c in cuts[::64]])
    tails = F.array(*[F.array(*[F.lit(c).cast("long") for c in cuts[k : k + 64]]) for k in range(0, len(cuts), 64)])
    block = F.size(F.filter(heads, lambda c: c <= at)) - 1
    return F.when(block < 0, 0).otherwise(block * 64 + F.size(F.filter(F.get(tails, block), lambda c: c <= at)))


def with_next(docs: DataFrame) -> DataFrame:
    """One row a document with its fingerprint, its edited text's, and their likenesses."""
    ship(docs.sparkSession)
    spread, ranges = in_ranges(docs)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        X.begin()
        held = None  # (bucket, doc_id, text) of the last row, whose successor is still to come
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                bucket, follows = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                ids, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
                rows = ([held] if held else []) + list(zip(bucket, follows, ids, texts, strict=True))
                held = rows[-1]
                pairs = [k for k in range(len(rows) - 1) if not rows[k][1] and rows[k][0] == rows[k + 1][0]]
                if pairs:
                    yield _compared([(rows[k][2], rows[k][3]) for k in range(len(rows))], pairs, batch.schema.field(2).type, names)

    if not ranges:
        return docs.sparkSession.createDataFrame([], schema)
    # the wrapped copies of the first document come last in the last range
    dealt = spread.repartitionById(ranges, F.col("bucket")).sortWithinPartitions("bucket", "wrapped", "at", "text", "follows")
    return dealt.select("bucket", "follows", "doc_id", "text").mapInArrow(compared, schema)


def _compared(rows: list[tuple], pairs: list[int], kind: pa.DataType, names: list[str]) -> pa.RecordBatch:
    texts = [t for _, t in rows]
    edited = []
    for k in pairs:
        n = len(texts[k])
        edited.append(texts[k][: n - n // 4] + texts[k + 1][: n // 4])
    found, counts = signatures(X.text_column(pa.array(texts, pa.large_string())))
    own, prints = np.split(found, np.cumsum(counts)[:-1]), written(found, counts)
    found, counts = signatures(X.text_column(pa.array(edited, pa.large_string())))
    other, edited_prints = np.split(found, np.cumsum(counts)[:-1]), written(found, counts)
    columns = [
        pa.array([rows[k][0] for k in pairs], kind), pa.array([len(texts[k]) for k in pairs], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
        pa.array([prints[k] for k in pairs]), pa.array(edited_prints), pa.array([likeness(own[k], e) for k, e in zip(pairs, other, strict=True)]), pa.array([likeness(own[k], own[k + 1]) for k in pairs]),
    ]
    return pa.RecordBatch.from_arrays(columns, names=names)


def op1_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text, and their likenesses; nulls, ties and repeats as the module states."""
    return with_next(spark.read.parquet(f"{sf_dir}/documents.parquet"))
