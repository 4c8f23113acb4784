"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly.

The unit is a group of equal texts. Groups too small to matter alone are bundled by a hash of their text; a group that is
a sizeable part of a shard is its own unit, and one that no shard should hold whole is dealt over hashed slices. Units go,
the largest first, to the shard where the dot product of their vector with the residual capacity is highest. The number of
units is bounded by the shards alone, so placing them on the driver costs the same at any size.

Defined cases: a null text has size 1 and checksum 0 of no bytes, as the empty one; equal texts share a shard unless
their group is dealt, which the result tells and ``whole_groups`` rules out; repeated rows are rows of one group; texts of any length are measured whole;
of shards with equal products the first is taken; tokens are counted as words; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle

SHARDS = 8
#: Bundles a shard; a bundle is about 1 / 512 of a shard.
BUNDLES_PER_SHARD = 512
#: A group over this share of a shard's bytes or rows stands alone; over DEALT_SHARE of a shard it is dealt over slices.
ALONE_SHARE = 1 / 64
DEALT_SHARE = 0.9
SLICES = 64
#: Rows of a shard that are numbered in one window, as far as MOST_SLICES windows go; larger ones spill.
SLICE_ROWS = 250_000
MOST_SLICES = 8192


def place(units: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unit (rows of bytes, tokens, rows): highest dot product with what each shard has left."""
    total = units.sum(0).astype(float)
    part = units / np.where(total > 0, total, 1)
    left = np.full((shards, units.shape[1]), 1.0 / shards)
    out = np.zeros(len(units), np.int64)
    for k in np.argsort(-part.max(1), kind="stable"):
        out[k] = int(np.argmax(left @ part[k]))
        left[out[k]] -= part[k]
    return out


def even_out(units: np.ndarray, at: np.ndarray, shards: int, passes: int = 400) -> np.ndarray:
    """Move or swap units between the fullest and the emptiest shard by bytes, while that brings these nearer.

    Of all exchanges that at least halve the gap, or else of those that narrow it, the one that leaves the gaps in tokens
    and rows smallest is made. A shard with a unit larger than a whole share takes no part: the others share the rest.
    """
    at = at.copy()
    mean = np.maximum(units.sum(0) / shards, 1)
    level = np.setdiff1d(np.arange(shards), at[units[:, 0] > mean[0]])
    for _ in range(passes if level.size else 0):
        load = np.stack([np.bincount(at, weights=u, minlength=shards) for u in units.T], 1)
        high, low = int(level[load[level, 0].argmax()]), int(level[load[level, 0].argmin()])
        gap = load[high] - load[low]
        a, b = np.flatnonzero(at == high), np.append(np.flatnonzero(at == low), -1)
        if gap[0] <= 1 or not a.size:
            break
        back = np.concatenate([units[b[:-1]], np.zeros((1, units.shape[1]), units.dtype)])
        after = np.abs(gap - 2 * (units[a][:, None, :] - back[None, :, :]))  # of bytes, tokens and rows, for each exchange
        good = after[:, :, 0] <= max(gap[0] / 2, 1)
        if not good.any():
            good = after[:, :, 0] < gap[0]
        if not good.any():
            break
        cost = np.where(good, (after[:, :, 1:] / mean[1:]).sum(2) + after[:, :, 0] / mean[0], np.inf)
        i, j = np.unravel_index(int(cost.argmin()), cost.shape)
        at[a[i]] = low
        if b[j] >= 0:
            at[b[j]] = high
    return at


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, tokens, group) of each row; tokens are counted as runs of non-separators."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"),
        F.substring(F.sha2(text.cast("binary"), 256), 1, 32).alias("group"),
    )


def _bundle(shards: int) -> Column:
    return F.pmod(F.xxhash64("group"), F.lit(shards * BUNDLES_PER_SHARD)).cast("string")


def shard(docs: DataFrame, shards: int = SHARDS, whole_groups: bool = False) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, dealt) of each row, under the law ``bytes``.

    ``dealt`` marks the rows of a group of equal texts that no shard should hold whole; with ``whole_groups`` every group
    stays in one shard, however full that gets.
    """
    rows = settle(measured(docs), "measured")
    sums = [F.sum(c).alias(c) for c in ("size", "tokens")] + [F.count("*").alias("rows")]
    whole = rows.agg(*sums).collect()[0]
    if not whole["rows"]:
        return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), F.lit(False).alias("dealt"))
    groups = rows.groupBy("group").agg(*sums)
    share = F.greatest(*[F.col(c) * F.lit(shards / max(1, whole[c])) for c in ("size", "tokens", "rows")])
    # at most 3 * shards / ALONE_SHARE groups
    alone = settle(groups.withColumn("share", share).where(F.col("share") > ALONE_SHARE).select("group", ((F.col("share") > DEALT_SHARE) & F.lit(not whole_groups)).alias("dealt")), "alone")
    marked = rows.join(F.broadcast(alone), "group", "left")
    piece = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(SLICES)).cast("string")
    unit = F.when(F.col("dealt"), F.concat(F.lit("d"), "group", F.lit("-"), piece)).when(F.col("dealt").isNotNull(), F.concat(F.lit("g"), "group")).otherwise(F.concat(F.lit("b"), _bundle(shards)))
    united = marked.withColumn("unit", unit)
    found = united.groupBy("unit").agg(*sums).orderBy("unit").toPandas()  # bounded: bundles, lone groups and their slices
    vectors = found[["size", "tokens", "rows"]].to_numpy(np.int64)
    found["shard"] = even_out(vectors, place(vectors, shards), shards)
    spark = docs.sparkSession
    slices = min(MOST_SLICES, max(SLICES, -(-whole["rows"] // (shards * SLICE_ROWS))))
    chosen = F.broadcast(spark.createDataFrame(list(zip(found["unit"].tolist(), found["shard"].tolist(), strict=True)), "unit string, shard int"))
    placed = united.join(chosen, "unit").withColumn("part", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(slices)).cast("int"))
    placed = settle(placed.select("doc_id", "size", "text_crc32", "shard", "part", F.coalesce("dealt", F.lit(False)).alias("dealt")), "placed")
    return slotted(placed, shards, slices)


def slotted(placed: DataFrame, shards: int, slices: int = SLICES) -> DataFrame:
    """Number the rows of each shard from 0 without gaps: ranks in ``slices`` parts of a shard, moved by the parts before."""
    from pyspark.sql import Window

    counts = {(r["shard"], r["part"]): r["n"] for r in placed.groupBy("shard", "part").agg(F.count("*").alias("n")).collect()}  # at most shards * MOST_SLICES
    before, rows = {}, []
    for s in range(shards):
        at = 0
        for p in range(slices):
            before[s, p] = at
            at += counts.get((s, p), 0)
            rows.append((s, p, before[s, p]))
    starts = placed.sparkSession.createDataFrame(rows, "shard int, part int, before long")
    order = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")
    ranked = placed.withColumn("nth", F.row_number().over(order)).join(F.broadcast(starts), ["shard", "part"])
    return ranked.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before") + F.col("nth") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "dealt")


def op6_vector_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; nulls, ties and repeats as the module states."""
    return shard(spark.read.parquet(f"{sf_dir}/documents.parquet"))
