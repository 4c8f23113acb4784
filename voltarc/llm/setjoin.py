"""N-gram Jaccard join: exact links between documents whose word-shingle sets overlap enough, by T-occurrence search.

1. Each document's set gets a key; equal sets are one node from here on, so copies cost nothing more.
2. Blocks. Linked sets x, y differ in at most D = (|x| + |y|) (1 - t) / (1 + t) shingles. If the hash range is cut into
   more than D parts, one part holds the same shingles of both. Each set emits a signature of every non-empty part, under
   the number of parts of its size class and, near a border, of the next. Some parts are to spare: a set with no more empty
   parts than that meets every set linked to it. Otherwise it is cut anew by other hashes, and emits these parts as well,
   until that holds; of two linked sets, the one that stops first stops where both have emitted. The first cut leaves out
   the commonest shingles, so that a passage which many documents share makes no candidates by itself. Sets of the smallest
   class emit as many of their rarest and smallest hashes as can't all be missing from a linked set. Sets that share a
   signature are joined to its smallest one, after a map-side pass that leaves a task at most one row a signature; the
   components of these edges are the blocks, and no link leaves one.
3. T-occurrence search in each block with DivideSkip: a set needs T shingles in common; its longest inverted lists are
   left aside, the short ones are merged and sets that reach T less the number of long lists are probed in those by binary
   search. Pairs that are connected already are not probed. With the number of texts ever more blocks grow together by
   chance. Members of blocks over the size limit of whose shingles too few are found elsewhere leave before any text is
   sent. Those that stay are compared as bit arrays, of two bits or so a shingle, which differ in no more places than their
   sets do; the components of pairs that may be linked are blocks of their own. What is still large is cut into chunks by
   hash, and every pair of chunks is a task of its own, after members linked to the block's first sets have been contracted.
4. Components of the links, and the smallest doc_id of each.

The cost follows the number of shingles and signatures; links are exact but for 64-bit hash collisions. Defined cases:
texts that are null or without words have an empty set and are linked with nothing, equal sets always are linked; texts
with fewer words than a shingle are one shingle, their whole sequence; repeated rows are equal sets; a null doc_id is
neither compared nor returned as a component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import all_columns, settle, ship, unsettle
from . import _text as X
from ._chunks import ragged
from .graph import components

#: Sets up to this size emit single shingles; above it parts are used, in size classes growing by CLASS_RATIO.
SMALL = 42
CLASS_RATIO = 1.5
#: Signatures that a map task combines at once.
COMBINE = 1 << 19
#: Members and shingles of a block, or of a chunk of a larger block, in one task.
BLOCK_MEMBERS = 3000
BLOCK_SHINGLES = 1 << 20
#: First sets of a block over that limit, of which the one with the most links stands for its group.
PIVOTS = 4
#: Tables of one row a block with at most so many rows may be broadcast; beyond that Spark chooses.
SMALL_BLOCK_LIST = 64
#: Cost of passing an entry of a long list, and of probing for one more candidate, relative to one call of a probe.
MERGE_COST = 0.0005
PROBE_COST = 0.01
#: Ways to cut a set into parts; the first leaves out the COMMON commonest shingles that are found COMMON_FROM times or more.
CUTS = 8
COMMON = 1 << 18
#: Bits of the filter that keeps texts without candidates out of the shuffle: so many a candidate, and at most so many in
#: all; beyond that more texts pass. An exact join follows it.
FILTER_BITS_EACH = 16
FILTER_BITS = 1 << 26
COMMON_FROM = 16
#: Sets from this size on are asked for the part SAMPLE / 8 of the hash range alone when it is counted what is found elsewhere.
LONG = 512
SAMPLE = 3
#: Members and bytes of bit arrays in half of a task that compares them; the fewest bits of one, as a power of two.
BITS_MEMBERS = 8192
BITS_BYTES = 4 << 20
LEAST_BITS = 6


SetsOf = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def shingle_sets(data: np.ndarray, off: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each document's distinct shingles, sorted within it, and their number in each document."""
    low = X.ascii_lowered(data)
    starts, ends = X.spans(~X.SEPARATOR[data], off)
    words, doc = X.span_hashes(low, starts, ends), X.doc_of(starts, off)
    n_docs = off.size - 1
    n_words = np.bincount(doc, minlength=n_docs)
    found, at = X.ngram_hashes(words, doc, width)
    parts, owner = [X.mix(found + np.uint64(width))], [doc[at]]
    for n in range(1, width):
        own = n_words[doc] == n
        if own.any():
            h, first = X.ngram_hashes(words[own], doc[own], n)
            parts.append(X.mix(h + np.uint64(n)))
            owner.append(doc[own][first])
    h, d = np.concatenate(parts), np.concatenate(owner)
    if len(parts) > 1:
        order = np.argsort(d, kind="stable")
        h, d = h[order], d[order]
    border = np.searchsorted(d, np.arange(n_docs + 1))
    for a, b in zip(border[:-1].tolist(), border[1:].tolist(), strict=True):
        h[a:b].sort()
    fresh = np.ones(h.size, bool)
    fresh[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return h[fresh], np.bincount(d[fresh], minlength=n_docs)


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.zeros(values.size + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    end = np.cumsum(counts)
    return total[end] - total[end - counts]


def set_keys(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """An even 64-bit key of each set; 0 for the empty one."""
    key = X.mix(_sums(X.mix(h ^ np.uint64(0xA5A5A5A55A5A5A5A)), counts) + counts.astype(np.uint64)) & ~np.uint64(1)
    return np.where(counts > 0, key, np.uint64(0)).view(np.int64)


class Scheme:
    """Size classes and the number of parts of each, for a threshold of ``percent`` / 100."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.tops = [SMALL]
        while self.tops[-1] < 1 << 40:
            self.tops.append(int(self.tops[-1] * CLASS_RATIO))
        self.edges = np.array(self.tops, np.int64)
        most = 2 * self.edges * (100 - percent) // (100 + percent)
        self.spare = np.array([self._spare(float(d), float(e) * percent / 100 / CLASS_RATIO, float(e)) for d, e in zip(most, self.edges, strict=True)], np.int64)
        self.parts = most + 1 + self.spare

    @staticmethod
    def _spare(most: float, smallest: float, largest: float) -> int:
        """Parts to spare for which the fewest signatures are expected, repeated cuts included.

        A set of s shingles has about p exp(-s / p) empty parts of p, and is cut again if they are more than the spare ones.
        """
        size = np.linspace(smallest, largest, 9)
        spare = np.unique(np.geomspace(1, most + 8, 60).astype(np.int64))
        parts = most + 1 + spare[:, None]
        empty = parts * np.exp(-size / parts)
        z = (spare[:, None] + 0.5 - empty) / np.sqrt(empty)
        again = 1 / (1 + np.exp(np.clip(1.702 * z, -60, 60)))  # about the upper tail of the normal distribution
        return int(spare[((parts - empty) / np.maximum(1 - again, 1 / CUTS)).mean(1).argmin()])

    def class_of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges, sizes)

    def signatures(self, h: np.ndarray, counts: np.ndarray, keys: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(odd signature, key of its set) of all sets of a block; ``common``: the commonest shingles, sorted."""
        own, up = self.class_of(counts), self.class_of(counts * 100 // self.percent)
        rare = np.ones(h.size, bool)
        if common.size and h.size:
            rare = common[np.minimum(np.searchsorted(common, h), common.size - 1)] != h
        end = np.cumsum(counts)
        out_sig, out_key = [], []
        differ = (counts + counts * 100 // self.percent) * (100 - self.percent) // (100 + self.percent) > 0
        for k in np.flatnonzero((own == 0) & differ):
            s = int(counts[k])
            need = s - -(-self.percent * s // 100) + 1
            part, first = h[end[k] - s : end[k]], rare[end[k] - s : end[k]]
            out_sig.append(X.mix(np.concatenate([part[first], part[~first]])[:need] + np.uint64(1)))
            out_key.append(np.full(need, keys[k]))
        for level, use in ((own, own > 0), (up, up > own)):
            for cut in range(CUTS):
                which = np.flatnonzero(use)
                if not which.size:
                    break
                keep = np.repeat(use, counts) & (rare if cut == 0 else True)
                row = np.searchsorted(which, np.repeat(np.arange(counts.size), counts)[keep])
                v = h[keep]
                place = v if cut < 2 else X.mix(v + np.uint64(cut))
                p = self.parts[level[which]].astype(np.uint64)
                part = ((place >> np.uint64(32)) * p[row]) >> np.uint64(32)
                if cut > 1:
                    order = np.lexsort((part, row))
                    v, row, part = v[order], row[order], part[order]
                first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (part[1:] != part[:-1]))) if v.size else np.zeros(0, np.int64)
                tag = X.mix(part[first] + (level[which][row[first]].astype(np.uint64) << np.uint64(40)) + np.uint64(cut << 56))
                if v.size:
                    out_sig.append(X.mix(np.add.reduceat(X.mix(v ^ np.uint64(0x0F0F0F0FF0F0F0F0)), first) + tag))
                    out_key.append(keys[which[row[first]]])
                empty = p.astype(np.int64) - np.bincount(row[first], minlength=which.size)
                lacking = empty > self.spare[level[which]]
                if cut == CUTS - 1:  # as good as never: the empty parts count as parts
                    for k in np.flatnonzero(lacking):
                        gone = np.setdiff1d(np.arange(int(p[k]), dtype=np.uint64), part[first][row[first] == k])
                        out_sig.append(X.mix(gone + (np.uint64(level[which[k]]) << np.uint64(40))))
                        out_key.append(np.full(gone.size, keys[which[k]]))
                use = np.zeros(counts.size, bool)
                use[which[lacking]] = True
        sig = (np.concatenate([np.zeros(0, np.uint64), *out_sig]) >> np.uint64(8)) | np.uint64(1)  # 56 bits: a byte less for each in the shuffle
        return sig.view(np.int64), np.concatenate([np.zeros(0, np.int64), *out_key])


def _combined(sig: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One row (signature, smallest key) a signature, and rows (key, smallest key) for the others that share it."""
    order = np.lexsort((key, sig))
    sig, key = sig[order], key[order]
    first = np.append(True, sig[1:] != sig[:-1]) if sig.size else np.zeros(0, bool)
    low = key[np.maximum.accumulate(np.where(first, np.arange(sig.size), 0))] if sig.size else key
    more = np.flatnonzero(key != low)
    pairs = np.unique(np.stack([key[more], low[more]], 1), axis=0)
    sig, key = sig[first], key[first]
    order = np.argsort(key, kind="stable")  # equal keys side by side take less room in the shuffle
    return np.concatenate([sig[order], pairs[:, 0]]), np.concatenate([key[order], pairs[:, 1]])


def with_sets(docs: DataFrame, sets_of: SetsOf) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, mark, n_shingles, set_key) of each row, a hash of its text as its mark and set_key 0 for the empty set; and the commonest shingles.

    Shingles are counted over all documents by lossy counting: of every COMBINE shingles of different sets, those found
    more than once are sent on. The commonest of them, at most COMMON, change the order of the search, never its result.
    """
    ship(docs.sparkSession)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        X.begin()
        pool, pooled, seen = [], 0, set()

        def counted() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(pool), return_counts=True)
            found, n = found[n > 1].view(np.int64), n[n > 1]
            none = pa.nulls(found.size, pa.int64())
            return pa.RecordBatch.from_arrays([none.cast(key_type), none, none, none, pa.array(found), pa.array(n)], names=names)

        for batch in batches:
            key_type = batch.schema.field(0).type
            n, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for _, _, data, off in X.blocks(X.text_column(batch.column(2))):
                h, counts = sets_of(data, off)
                own = set_keys(h, counts)
                new = np.zeros(own.size, bool)
                new[np.unique(own, return_index=True)[1]] = True
                new &= np.fromiter((k not in seen for k in own.tolist()), bool, own.size)
                seen.update(own[new].tolist())
                pool.append(h[np.repeat(new, counts)])
                pooled += pool[-1].size
                if pooled >= COMBINE:
                    yield counted()
                    pool, pooled, seen = [], 0, set()
                n.append(counts)
                keys.append(own)
            n, keys = np.concatenate(n), np.concatenate(keys)
            none = pa.nulls(n.size, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n), pa.array(keys), none, none], names=names)
        if pooled:
            yield counted()

    names = ["doc_id", "mark", "n_shingles", "set_key", "shingle", "n"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    both = settle(docs.select("doc_id", F.xxhash64("text").alias("mark"), "text").mapInArrow(keyed, f"doc_id {kind}, mark bigint, n_shingles bigint, set_key bigint, shingle bigint, n bigint"), "sets")
    counted = settle(both.where("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= COMMON_FROM), "common")
    step = F.floor(F.log2("n") * 16)
    common = counted.where(step > F.lit(_step_above(counted.groupBy(step.alias("at")).agg(F.count("*").alias("rows")).collect(), COMMON)))
    return both.where("shingle IS NULL").select("doc_id", "mark", "n_shingles", "set_key"), np.sort(common.select("shingle").toPandas()["shingle"].to_numpy(np.int64).view(np.uint64))


def _step_above(histogram: list, most: int) -> int:
    """The step above which a histogram of (at, rows) holds no more than ``most`` rows."""
    total = 0
    for row in sorted(histogram, key=lambda r: -r["at"]):
        total += row["rows"]
        if total > most:
            return row["at"]
    return -1


def block_edges(docs: DataFrame, sets_of: SetsOf, percent: int, common: np.ndarray) -> DataFrame:
    """Edges (a, b) between set keys whose components are the blocks."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(common)  # at most COMMON hashes

    def emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        X.begin()
        scheme, sigs, keys, held = Scheme(percent), [], [], 0

        def flush() -> pa.RecordBatch:
            a, b = _combined(np.concatenate(sigs), np.concatenate(keys))
            sigs.clear()
            keys.clear()
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            for _, _, data, off in X.blocks(X.text_column(batch.column(0))):
                h, counts = sets_of(data, off)
                sig, key = scheme.signatures(h, counts, set_keys(h, counts), shared.value)
                sigs.append(sig)
                keys.append(key)
                held += sig.size
                if held >= COMBINE:
                    held = 0
                    yield flush()
        if sigs:
            yield flush()

    def starred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sig, low = None, None  # of the last row, whose run may go on
        for batch in batches:
            a, b = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            if not a.size:
                continue
            edge = (a & 1) == 0
            run_a, run_b = a[~edge], b[~edge]
            out_a, out_b = [a[edge]], [b[edge]]
            if run_a.size:
                first = np.append(True, run_a[1:] != run_a[:-1])
                least = run_b[np.maximum.accumulate(np.where(first, np.arange(run_a.size), 0))]
                if sig is not None and run_a[0] == sig:
                    least[run_a == sig] = low
                more = least != run_b
                out_a.append(run_b[more])
                out_b.append(least[more])
                sig, low = run_a[-1], least[-1]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])

    rows = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("text").mapInArrow(emitted, "a bigint, b bigint")
    return rows.repartition("a").sortWithinPartitions("a", "b").mapInArrow(starred, "a bigint, b bigint")


def divide_skip(sets: list[np.ndarray], percent: int, root: np.ndarray | None = None) -> np.ndarray:
    """A label for each set: equal for those that are connected by links (Jaccard >= percent / 100).

    ``sets``: sorted distinct hashes. ``root``: labels that are known to be connected already.
    """
    m = len(sets)
    label = np.arange(m) if root is None else root.copy()
    sizes = np.array([s.size for s in sets], np.int64)
    order = np.argsort(sizes, kind="stable")  # a set is sought among those that are no larger
    flat = np.concatenate([sets[k] for k in order])
    owner = np.repeat(np.arange(m), sizes[order])
    token = np.unique(flat, return_inverse=True)[1].astype(np.int32)
    postings = owner.astype(np.int32)[np.argsort(token, kind="stable")]
    df = np.bincount(token)
    begin = np.cumsum(df) - df
    end = np.cumsum(sizes[order])
    size = sizes[order]
    label = label[order]
    for x in range(1, m):
        s = int(size[x])
        need = -(-percent * s // 100)
        smallest = int(np.searchsorted(size, need))
        if smallest >= x or (label[smallest:x] == label[x]).all():
            continue
        own = token[end[x] - s : end[x]]
        own = own[np.argsort(df[own], kind="stable")]
        n_long = max(0, need - 1)
        short, long = own[: s - n_long], own[s - n_long :]
        hits = merge_short([postings[begin[t] : begin[t] + df[t]] for t in short.tolist()], smallest, x, m)
        candidates = np.flatnonzero(hits >= need - n_long)
        candidates = candidates[label[candidates] != label[x]]
        if not candidates.size:
            continue
        shared = hits[candidates]
        wanted = -(-percent * (s + size[candidates]) // (100 + percent))
        entries = int(df[long].sum())
        if entries * MERGE_COST < long.size * (1 + candidates.size * PROBE_COST):  # so many candidates that one pass over the long lists is cheaper
            shared = shared + np.bincount(ragged(postings, begin[long], df[long]), minlength=m)[candidates]
            long = long[:0]
        left = long.size
        for t in long.tolist():
            possible = shared + left >= wanted
            if not possible.all():
                candidates, shared, wanted = candidates[possible], shared[possible], wanted[possible]
                if not candidates.size:
                    break
            entry = postings[begin[t] : begin[t] + df[t]]
            at = np.minimum(np.searchsorted(entry, candidates), entry.size - 1)
            shared = shared + (entry[at] == candidates)
            left -= 1
        linked = candidates[shared >= wanted]
        if linked.size:
            label[np.isin(label, label[linked])] = label[x]
    out = np.empty(m, np.int64)
    out[order] = label
    return out


def merge_short(lists: list[np.ndarray], low: int, high: int, m: int) -> np.ndarray:
    """Occurrences of each member from ``low`` to below ``high`` in short sorted lists, merged by a heap; many entries are counted in one pass."""
    lists = [x for x in lists if x.size and x[0] < high and x[-1] >= low]
    out = np.zeros(m, np.int64)
    if sum(x.size for x in lists) > 64:
        out = np.bincount(np.concatenate(lists), minlength=m)
    else:
        for k in heapq.merge(*(x.tolist() for x in lists)):
            out[k] += 1
    out[:low] = 0
    out[high:] = 0
    return out


def _sets_of_texts(texts: pa.Array, keys: np.ndarray, sets_of: SetsOf) -> list[np.ndarray | None]:
    """The set of each text; None where it isn't the one of that key, since another row has the same doc_id."""
    out: list[np.ndarray | None] = []
    for a, b, data, off in X.blocks(X.text_column(texts)):
        h, counts = sets_of(data, off)
        end = np.cumsum(counts)
        same = set_keys(h, counts) == keys[a:b]
        out += [h[e - n : e].copy() if ok else None for e, n, ok in zip(end.tolist(), counts.tolist(), same.tolist(), strict=True)]
    return out


def _search(percent: int, sets_of: SetsOf):  # noqa: ANN202
    """Runs divide_skip on each (block, task) of rows sorted by it; edges from each set to the first of its component."""

    def solved(keys: np.ndarray, known: np.ndarray, sets: list[np.ndarray]) -> pa.RecordBatch:
        _, once = np.unique(keys, return_index=True)
        keys, known, sets = keys[once], known[once], [sets[k] for k in once]
        _, root = np.unique(known, return_inverse=True)
        label = divide_skip(sets, percent, root)
        _, first = np.unique(label, return_index=True)
        lead = np.zeros(int(label.max()) + 1, np.int64)
        lead[label[first]] = keys[first]
        low = lead[label]
        more = low != keys
        return pa.RecordBatch.from_arrays([pa.array(keys[more]), pa.array(low[more])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        X.begin()
        now, keys, known, sets = None, [], [], []

        def ended() -> Iterator[pa.RecordBatch]:
            if len(keys) > 1:
                yield solved(np.array(keys, np.int64), np.array(known, np.int64), sets)
            for x in (keys, known, sets):
                x.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            block, task, key, root = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            found = _sets_of_texts(batch.column(4), key, sets_of)
            border = np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (task[1:] != task[:-1])))
            for a, b in zip(border.tolist(), [*border[1:].tolist(), block.size], strict=True):
                if now != (block[a], task[a]):
                    yield from ended()
                now = (block[a], task[a])
                for k in range(a, b):
                    if found[k] is not None and (not keys or keys[-1] != key[k]):  # repeated rows of a doc_id come one after another
                        keys.append(int(key[k]))
                        known.append(int(root[k]))
                        sets.append(found[k])
        yield from ended()

    return run


def _with_texts(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(block, set_key, n, chunks, text) of the members (set_key, doc_id, n, block, chunks).

    A bit array over the members' doc_ids, joined by its words, keeps most other texts from being sent. Where a doc_id
    repeats, a member meets all its texts; the search leaves those out that have another key.
    """
    words, word, hit = id_bits(members)
    rows = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", word)
    rows = rows.join(F.broadcast(words), "_word").where(hit)
    return rows.select("doc_id", "text").join(members.select("doc_id", "set_key", "n", "block", "chunks"), "doc_id").select("block", "set_key", "n", "chunks", "text")


def id_bits(ids: DataFrame) -> tuple[DataFrame, Column, Column]:
    """A bit array over doc_ids as a table of words, at most FILTER_BITS / 64 of them; the word of a row, and whether its bit
    is set once it has met the words (false where it met none)."""
    wanted = ids.count() * FILTER_BITS_EACH
    bits = min(FILTER_BITS, 1 << max(16, wanted.bit_length()))
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    word, at = F.shiftright(bit, 6).alias("_word"), bit.bitwiseAND(F.lit(63)).cast("int")
    words = ids.select(word, at.alias("_bit")).groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))
    return words, word, F.call_function("shiftright", F.coalesce("_bits", F.lit(0).cast("long")), at).bitwiseAND(F.lit(1)) == 1


def without_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without the rows of ``ids`` (doc_id). Rows whose id isn't in a bit array over them pass as they lie; only the
    others, few more than those that go, are dealt out for the exact comparison."""
    words, word, hit = id_bits(ids)
    marked = docs.select("doc_id", F.struct(*all_columns(docs)).alias("_row"), word).join(F.broadcast(words), "_word", "left")
    stay = marked.where(~hit).select("_row")
    asked = marked.where(hit).select("doc_id", "_row").join(ids.select("doc_id"), "doc_id", "left_anti").select("_row")
    return stay.unionByName(asked).select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])


def link_sets(docs: DataFrame, sets: DataFrame, sets_of: SetsOf, percent: int, common: np.ndarray) -> DataFrame:
    """(id, root): the component of each set that is linked with another, by set keys."""
    blocks = settle(components(block_edges(docs, sets_of, percent, common)), "blocks")
    first = sets.where("set_key <> 0").groupBy("set_key").agg(F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n"))
    inside = settle(first.join(blocks.select(F.col("id").alias("set_key"), F.col("root").alias("block")), "set_key"), "members")
    chunks = F.greatest(F.ceil(F.count("*") / BLOCK_MEMBERS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    large = settle(inside.groupBy("block").agg(F.count("*").alias("members"), chunks.alias("chunks")).where("chunks > 1"), "large")
    blocks_cut = large.count()
    sent_to_all = F.broadcast if blocks_cut <= SMALL_BLOCK_LIST else (lambda df: df)
    small = inside.join(sent_to_all(large), "block", "left_anti") if blocks_cut else inside
    rows = _with_texts(docs, small.withColumn("chunks", F.lit(1))).select("block", F.lit(0).alias("task"), "set_key", F.col("set_key").alias("known"), "text")
    found = settle(rows.repartition("block").sortWithinPartitions("block", "set_key").mapInArrow(_search(percent, sets_of), "a bigint, b bigint"), "links")
    if not blocks_cut:
        return components_of_stars(found)
    cut = settle(inside.join(sent_to_all(large), "block").select("set_key", "doc_id", "n", "block"), "members")
    near = settle(near_others(docs, cut, sets_of, percent), "near")
    texts = settle(_with_texts(docs, near.withColumn("chunks", F.lit(1))), "texts")
    # those that are left are dealt to blocks anew
    apart = settle(components(alike(texts, sets_of, percent)), "apart")
    near = near.select("set_key", "n").join(apart.select(F.col("id").alias("set_key"), F.col("root").alias("block")), "set_key")
    sizes = settle(near.groupBy("block").agg(chunks.alias("chunks")), "sizes")
    near = settle(near.join(sizes, "block").select("set_key", "n", "block", "chunks"), "near")
    texts = texts.select("set_key", "text").join(near, "set_key").select("block", "set_key", "n", "chunks", "text")
    links = large_links(texts, near, sets_of, percent, sizes.count())
    return components(found.unionByName(links))


def near_others(docs: DataFrame, members: DataFrame, sets_of: SetsOf, percent: int) -> DataFrame:
    """The ``members`` (set_key, doc_id, n, block) that can be linked with another.

    A link takes percent / 100 of a set's shingles, so one of which more are found nowhere else has none. Each shingle of
    the members' texts is sent once at most, so this grows as the texts do, and no text is sent. Of sets from LONG on only
    those in a part of the hash range are asked for, and sets that are too large for a link with a smaller one send no
    others. Shingles that occur twice among COMBINE of them are settled before anything is sent: a task sends one row for
    each, without its owner. A few other documents, or other texts of an id, are counted too: then more members stay.
    """
    ship(docs.sparkSession)
    kinds, names = "a bigint, b bigint", ["a", "b"]
    asked = np.uint64(SAMPLE << 61)

    def rows_of(h: np.ndarray, owner: np.ndarray, key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        """Rows (odd shingle, owner or 0) and rows (set key, n); set keys are even."""
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([h, key])), pa.array(np.concatenate([owner, n.astype(np.int64)]))], names=names)

    def emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        X.begin()
        pool, owners, held = [], [], 0

        def flush() -> pa.RecordBatch:
            h, owner = np.concatenate(pool), np.concatenate(owners)
            pool.clear()
            owners.clear()
            order = np.lexsort((owner, h))
            h, owner = h[order], owner[order]
            first = np.append(True, h[1:] != h[:-1])
            alone = first & np.append(first[1:], True)
            key, at = np.unique(owner, return_inverse=True)
            n = np.bincount(at, alone)
            known = key != 0
            return rows_of(h[first], np.where(alone, owner, 0)[first], key[known], n[known])

        for batch in batches:
            for _, _, data, off in X.blocks(X.text_column(batch.column(0))):
                h, counts = sets_of(data, off)
                keys = set_keys(h, counts)
                part = h < asked
                part_sent = part | np.repeat(counts * percent // 100 < LONG, counts)
                owner = np.where(part | np.repeat(counts < LONG, counts), np.repeat(keys, counts), 0)
                pool.append((X.mix(h[part_sent]) | np.uint64(1)).view(np.int64))
                owners.append(owner[part_sent])
                held += pool[-1].size
                if held >= COMBINE:
                    held = 0
                    yield flush()
        if held:
            yield flush()

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, waiting = None, 0  # the last row's shingle, and its owner while it is the first of its run
        for batch in batches:
            a, b = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            told = (a & 1) == 0
            h, owner = a[~told], b[~told]
            found = [np.zeros(0, np.int64)]
            if h.size:
                same = np.append(last is not None and h[0] == last, h[1:] == h[:-1])
                shared = same | np.append(same[1:], False)
                found.append(owner[shared & (owner != 0)])
                if same[0] and waiting:
                    found.append(np.array([waiting], np.int64))
                last, waiting = h[-1], 0 if shared[-1] else int(owner[-1])
            key, n = np.unique(np.concatenate(found), return_counts=True)
            yield rows_of(a[told], b[told], key, -n)

    words, word, hit = id_bits(members)
    rows = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("text", F.col("doc_id"), word).join(F.broadcast(words), "_word").where(hit).select("text")
    there = rows.mapInArrow(emitted, kinds).repartition("a").sortWithinPartitions("a").mapInArrow(met, kinds)
    alone = there.groupBy(F.col("a").alias("set_key")).agg(F.sum("b").alias("_alone"))
    return members.join(alone, "set_key").where(F.col("_alone") * 100 <= F.col("n") * (100 - percent)).select("set_key", "doc_id", "n", "block")


def bit_level(n: int) -> int:
    """The power of two that a bit array for ``n`` shingles has bits."""
    return max(LEAST_BITS, (n - 1).bit_length())


def alike(texts: DataFrame, sets_of: SetsOf, percent: int) -> DataFrame:
    """Edges (a, b) between the sets of ``texts`` (block, set_key, n, text); each linked pair is in one of their components.

    The bit arrays of two sets differ in no more places than the sets do in shingles, so a pair whose arrays differ in more
    than a link allows has none. A set emits arrays of its own length and of those of the larger sets that it can be linked
    with. Of the pairs of chunks of a block and length each is a task, which gives a forest of the pairs that stay.
    """
    ship(texts.sparkSession)

    def emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        X.begin()
        for batch in batches:
            key = batch.column(1).to_numpy(zero_copy_only=False)
            row, level, n, bits = [], [], [], []
            for k, s in enumerate(_sets_of_texts(batch.column(2), key, sets_of)):
                if s is None or not s.size:
                    continue
                for at in range(bit_level(s.size), bit_level(s.size * 100 // percent) + 1):
                    marks = np.zeros(1 << at, np.uint8)
                    marks[(s & np.uint64((1 << at) - 1)).astype(np.int64)] = 1
                    row.append(k)
                    level.append(at)
                    n.append(s.size)
                    bits.append(np.packbits(marks).tobytes())
            kept = batch.take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([kept.column(0), pa.array(level, pa.int32()), kept.column(1), pa.array(n, pa.int64()), pa.array(bits, pa.binary())], names=["block", "level", "set_key", "n", "bits"])

    def forest(keys: list[int], sizes: list[int], bits: list[bytes]) -> pa.RecordBatch:
        size, once = np.array(sizes, np.int64), np.unique(np.array(keys, np.int64), return_index=True)[1]
        order = once[np.argsort(size[once], kind="stable")]
        key, size = np.array(keys, np.int64)[order], size[order]
        marks = np.frombuffer(b"".join(bits[k] for k in order.tolist()), np.uint64).reshape(key.size, -1)
        label = np.arange(key.size)
        smallest = np.searchsorted(size, -(-percent * size // 100))
        for x in range(1, key.size):
            low = int(smallest[x])
            if low >= x or (label[low:x] == label[x]).all():
                continue
            differ = np.bitwise_count(marks[low:x] ^ marks[x]).sum(1, dtype=np.int64)
            close = low + np.flatnonzero(differ * (100 + percent) <= (size[low:x] + size[x]) * (100 - percent))
            if close.size and (label[close] != label[x]).any():
                label[np.isin(label, label[close])] = label[x]
        lead = key[label]
        more = lead != key
        return pa.RecordBatch.from_arrays([pa.array(key[more]), pa.array(lead[more])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        X.begin()
        now, keys, sizes, bits = None, [], [], []
        for batch in batches:
            task = list(zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True))
            for at, key, n, b in zip(task, batch.column(4).to_pylist(), batch.column(5).to_pylist(), batch.column(6).to_pylist(), strict=True):
                if at != now:
                    if len(keys) > 1:
                        yield forest(keys, sizes, bits)
                    now, keys, sizes, bits = at, [], [], []
                keys.append(key)
                sizes.append(n)
                bits.append(b)
        if len(keys) > 1:
            yield forest(keys, sizes, bits)

    made = settle(texts.select("block", "set_key", "text").mapInArrow(emitted, "block bigint, level int, set_key bigint, n bigint, bits binary"), "bits")
    half = F.greatest(F.ceil(F.count("*") / BITS_MEMBERS), F.ceil(F.sum(F.length("bits")) / BITS_BYTES)).cast("int")
    halves = settle(made.groupBy("block", "level").agg(half.alias("halves")), "halves")
    dealt = made.join(halves, ["block", "level"]).withColumn("own", F.pmod(F.xxhash64("set_key"), "halves").cast("int"))
    others = F.when(F.col("halves") == 1, F.array(F.lit(0))).otherwise(F.expr("filter(sequence(0, halves - 1), s -> s <> own)"))  # pairs of a chunk meet beside any other
    dealt = dealt.withColumn("other", F.explode(others)).select("block", "level", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "set_key", "n", "bits")
    task = ["block", "level", "low", "high"]
    found = settle(dealt.repartition(*task).sortWithinPartitions(*task, "set_key").mapInArrow(run, "a bigint, b bigint"), "alike")
    unsettle(made)
    return found


def large_links(texts: DataFrame, members: DataFrame, sets_of: SetsOf, percent: int, n_blocks: int) -> DataFrame:
    """Star edges between linked sets of blocks that are cut into chunks: texts (block, set_key, n, chunks, text) of members.

    Members linked to the best of the block's PIVOTS first sets take it as their known root; the others are strays. Only
    strays are searched, against each other and against every chunk: a huge group of near copies costs a few comparisons a
    member. Pivots are copied to each chunk of their block, and meet the members there; no side is broadcast.
    """
    drawn = members.groupBy("block", "chunks").agg(F.array(*[F.min(F.struct(F.xxhash64("set_key", F.lit(k)), F.col("set_key").alias("pivot")))["pivot"] for k in range(PIVOTS)]).alias("pivots"))
    drawn = settle(drawn.select("block", "chunks", F.explode(F.array_distinct("pivots")).alias("set_key")), "drawn")
    dealt = texts.withColumn("chunk", F.pmod(F.xxhash64("set_key"), "chunks").cast("int")).select("block", "chunk", "chunks", "set_key", "text")
    small = n_blocks <= SMALL_BLOCK_LIST  # then the few rows (block, set_key) of the pivots may go to all
    dealt = settle(dealt, "dealt")
    pivots = dealt.join((F.broadcast if small else (lambda df: df))(drawn.select("block", "set_key")), ["block", "set_key"], "left_semi")
    pivots = pivots.select("block", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "chunks", "set_key", "text")
    both = pivots.withColumn("member", F.lit(False)).unionByName(dealt.withColumn("member", F.lit(True)))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        X.begin()
        now, pivots, last = None, {}, None
        for batch in batches:
            block, chunk, key = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 3))
            member = batch.column(5).to_numpy(zero_copy_only=False)
            found = _sets_of_texts(batch.column(4), key, sets_of)
            out, row = [], []
            for k in range(batch.num_rows):
                if now != (block[k], chunk[k]):
                    now, pivots, last = (block[k], chunk[k]), {}, None
                if found[k] is None or last == key[k]:  # another text of a doc_id that repeats, or the same one again
                    continue
                if not member[k]:
                    pivots[int(key[k])] = found[k]
                    continue
                last = key[k]
                row.append(k)
                out.append([p for p, s in pivots.items() if (100 + percent) * np.intersect1d(s, found[k], assume_unique=True).size >= percent * (s.size + found[k].size)])
            kept = batch.take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([*(kept.column(c) for c in range(5)), pa.array(out, pa.list_(pa.int64()))], names=["block", "chunk", "chunks", "set_key", "text", "near"])

    sorted_rows = both.select("block", "chunk", "set_key", "chunks", "text", "member").select("block", "chunk", "chunks", "set_key", "text", "member")
    sorted_rows = sorted_rows.repartition("block", "chunk").sortWithinPartitions("block", "chunk", "member", "set_key")
    met = settle(sorted_rows.mapInArrow(near, "block bigint, chunk int, chunks int, set_key bigint, text string, near array<bigint>"), "met")
    unsettle(dealt)
    best = met.select("block", F.explode("near").alias("pivot")).groupBy("block", "pivot").agg(F.count("*").alias("n")).groupBy("block").agg(F.max(F.struct("n", "pivot"))["pivot"].alias("pivot"))
    sizes = met.groupBy("block", "chunks").agg(F.count("*").alias("members"))
    told = settle(sizes.join(best, "block", "left"), "best")
    linked = F.coalesce(F.array_contains("near", F.col("pivot")), F.lit(False))
    labelled = met.join((F.broadcast if small else (lambda df: df))(told.select("block", "pivot", "members")), "block").select("block", "chunk", "chunks", "members", "set_key", "text", F.when(linked, F.col("pivot")).otherwise(F.col("set_key")).alias("known"), (~linked).alias("stray"))
    strays = settle(labelled.where("stray").groupBy("block").agg(F.count("*").alias("strays")), "strays")
    sent = labelled.join((F.broadcast if small else (lambda df: df))(strays), "block")  # without strays, the block is one group already
    sent = sent.withColumn("stray_chunks", F.ceil(F.col("chunks") * F.col("strays") / F.col("members")).cast("int")).withColumn("own", F.pmod(F.xxhash64("set_key"), "stray_chunks").cast("int"))
    met_by = "transform(sequence(0, stray_chunks - 1), s -> stray_chunks * chunks + least(own, s) * stray_chunks + greatest(own, s))"
    tasks = F.when(F.col("stray"), F.expr(f"concat(transform(sequence(0, chunks - 1), c -> own * chunks + c), {met_by})")).otherwise(F.expr("transform(sequence(0, stray_chunks - 1), s -> s * chunks + chunk)"))
    rows = sent.select("block", F.explode(tasks).alias("task"), "set_key", "known", "text")
    found = settle(rows.repartition("block", "task").sortWithinPartitions("block", "task", "set_key").mapInArrow(_search(percent, sets_of), "a bigint, b bigint"), "links")
    stars = settle(labelled.where("NOT stray").select(F.col("set_key").alias("a"), F.col("known").alias("b")), "stars")
    unsettle(met)
    return found.unionByName(stars)


def components_of_stars(stars: DataFrame) -> DataFrame:
    """(id, root) of edges that already lead from every member to one root."""
    return stars.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(stars.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())


def jaccard_components(docs: DataFrame, width: int = 4, percent: int = 85, sets_of: SetsOf | None = None) -> DataFrame:
    """(doc_id, mark, n_shingles, set_key, group_key, component_id) of each row.

    ``group_key`` is equal for linked documents, null for the empty set; ``component_id`` is the smallest doc_id of the group.
    ``sets_of`` takes the place of word shingles: from bytes and offsets of texts to sorted hashes and their numbers.
    """
    if sets_of is None:

        def sets_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            return shingle_sets(data, off, width)

    sets, common = with_sets(docs, sets_of)
    linked = settle(link_sets(docs, sets, sets_of, percent, common), "components")
    grouped = sets.join(linked.withColumnRenamed("id", "set_key"), "set_key", "left").withColumn("group_key", F.when(F.col("set_key") != 0, F.coalesce("root", "set_key"))).drop("root")
    # written first, so that a hot group's rows in the join below can be split
    lowest = settle(grouped.where("group_key IS NOT NULL").groupBy("group_key").agg(F.min("doc_id").alias("lowest")), "lowest")
    return grouped.join(lowest, "group_key", "left").select("doc_id", "mark", "n_shingles", "set_key", "group_key", F.when(F.col("doc_id").isNotNull(), F.coalesce("lowest", "doc_id")).alias("component_id"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents by 4-word shingles at 85 percent; nulls, ties and repeats as the module states."""
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_shingles", "component_id")


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the first document of each group of five-word shingle sets with a Jaccard similarity of 0.8 or more.

    Rows without shingles or without doc_id belong to no group and stay. Where a doc_id repeats, each row is judged by its
    own text: of equal rows of a group one stays, of different texts in one group that with the lowest hash, and texts of
    different groups all stay that are their groups' first. An empty table stays empty; all columns stay as they came.
    """
    grouped = settle(jaccard_components(docs, 5, 80).select("doc_id", "mark", "group_key", "component_id"), "grouped")
    first = F.col("group_key").isNull() | (F.col("doc_id") == F.col("component_id"))
    ids = grouped.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(first).alias("stays"), F.count("*").alias("n"))
    ids = settle(ids.where("NOT stays OR n > 1"), "ids")
    kept = without_ids(docs, ids)
    repeated = ids.where("stays AND n > 1").select("doc_id")
    if not repeated.limit(1).count():
        return kept
    own = grouped.join(repeated, "doc_id", "left_semi")
    lone = own.where("group_key IS NULL").select("doc_id", "mark").distinct()
    lead = own.where("group_key IS NOT NULL AND doc_id = component_id").groupBy("doc_id", "group_key").agg(F.min("mark").alias("mark")).select("doc_id", "mark")
    marked = docs.select("doc_id", F.xxhash64("text").alias("mark"), F.struct(*all_columns(docs)).alias("row"))
    once = marked.join(lead, ["doc_id", "mark"], "left_semi").groupBy("doc_id", "mark").agg(F.first("row").alias("row"))
    rest = once.select("row").unionByName(marked.join(lone, ["doc_id", "mark"], "left_semi").select("row"))
    return kept.unionByName(rest.select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))
