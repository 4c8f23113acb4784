"""Best-fit packing of token pieces into sequences, by the linear grouping scheme.

Only the histogram of piece lengths (at most ``capacity`` counts) is planned on the driver; documents never are.
``plan`` rounds the large lengths up within groups of about equal cardinality, fills bins with the few rounded sizes by
repeatedly taking the configuration that fills a bin best (a knapsack over the remaining group counts) as often as the
counts allow, substitutes the actual lengths into the configurations, and adds the small pieces best fit: each into the
fullest bin that still takes it. Bins with the same content are planned as one class with a count, so a plan's size
depends on the capacity alone. Every piece then finds its place by its rank among the pieces of its length.

Defined cases: a null or empty text is one piece, its end token; longer documents are cut into pieces of ``capacity``;
repeated rows are packed each for itself; pieces of one length are interchangeable, and ties among them go by doc_id; giant
texts are encoded in windows; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle, ship
from . import _text as X
from .tokens import WORD_VOCABULARY, vocabulary, word_encoder

CAPACITY = 4096
END_TOKEN = 1
#: Attempts: lengths over this share of the capacity are rounded up in so many groups; the rest is placed best fit.
ATTEMPTS = ((1 / 3, 400), (1 / 2, 400), (1 / 3, 1600))
#: Pieces of one length are dealt to blocks before they are ranked: of BLOCK_PIECES, or larger ones where a table has more
#: than MOST_BLOCKS of these.
BLOCK_PIECES = 256
MOST_BLOCKS = 100_000


@dataclass
class BinClass:
    """``count`` bins of the same content: (length, how many of it in a bin), and the room left in each."""

    count: int
    content: tuple[tuple[int, int], ...]
    room: int


def linear_groups(lengths: list[int], counts: dict[int, int], groups: int) -> dict[int, int]:
    """Rounded size of each length: the largest of its group. Groups hold about the same number of pieces."""
    total = sum(counts[x] for x in lengths)
    target, out, held, members = max(1, -(-total // groups)), {}, 0, []
    for x in sorted(lengths):
        if members and (counts[x] >= target or x == max(lengths)):  # a common length, and the largest, stand alone
            out |= dict.fromkeys(members, members[-1])
            members, held = [], 0
        members.append(x)
        held += counts[x]
        if held >= target:
            out |= dict.fromkeys(members, x)
            members, held = [], 0
    return out | (dict.fromkeys(members, members[-1]) if members else {})


def _best_configuration(sizes: list[int], left: dict[int, int], capacity: int) -> list[tuple[int, int]]:
    """The configuration of remaining sizes that begins with the largest one and leaves the least room."""
    first = sizes[-1]
    room = capacity - first
    reach = np.full(room + 1, -1, np.int64)  # which size was added last to reach a sum
    reach[0] = len(sizes)
    for k in range(len(sizes) - 1, -1, -1):
        s = sizes[k]
        free = min(left[s] - (s == first), room // s)
        used = np.zeros(room + 1, np.int64) if free else None
        for _ in range(free):
            at = np.flatnonzero(reach[: room + 1 - s] >= 0)
            at = at[(reach[at + s] < 0) & (used[at] < free)]
            if not at.size:
                break
            reach[at + s] = k
            used[at + s] = used[at] + 1
        if reach[room] >= 0:
            break
    total = int(np.flatnonzero(reach >= 0)[-1])
    chosen = {first: 1}
    while total:
        s = sizes[reach[total]]
        chosen[s] = chosen.get(s, 0) + 1
        total -= s
    return sorted(chosen.items(), reverse=True)


def configurations(rounded: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(how often, [(size, copies in a bin)]) until the counts of the rounded sizes are used up."""
    left = {s: n for s, n in rounded.items() if n}
    out = []
    while left:
        best = _best_configuration(sorted(left), left, capacity)
        times = min(left[s] // n for s, n in best)
        out.append((times, best))
        for s, n in best:
            left[s] -= times * n
            if not left[s]:
                del left[s]
    return out


def substitute(configs: list[tuple[int, list[tuple[int, int]]]], size_of: dict[int, int], counts: dict[int, int], capacity: int) -> list[BinClass]:
    """Put actual lengths into the slots of the rounded sizes, the largest first; runs of equal bins stay one class."""
    queue: dict[int, list[list[int]]] = {}
    for x in sorted(size_of):
        queue.setdefault(size_of[x], []).append([x, counts[x]])
    classes = []
    for times, slots in configs:
        flat = [s for s, n in slots for _ in range(n)]
        while times:
            used: dict[tuple[int, int], int] = {}
            for s in flat:  # the next length of this size that isn't used up by the slots before
                for run in reversed(queue[s]):
                    if run[1] > used.get((s, run[0]), 0):
                        break
                used[s, run[0]] = used.get((s, run[0]), 0) + 1
            n = min(times, *(next(r[1] for r in queue[s] if r[0] == x) // k for (s, x), k in used.items()))
            content: dict[int, int] = {}
            for (s, x), k in used.items():
                content[x] = content.get(x, 0) + k
                for run in queue[s]:
                    if run[0] == x:
                        run[1] -= n * k
                queue[s] = [r for r in queue[s] if r[1]]
            classes.append(BinClass(n, tuple(sorted(content.items(), reverse=True)), capacity - sum(x * k for x, k in content.items())))
            times -= n
    return classes


def best_fit(classes: list[BinClass], small: dict[int, int], capacity: int) -> list[BinClass]:
    """Add the small lengths, the largest first, each into the fullest bin that takes it; new bins open when none does."""
    by_room: dict[int, list[BinClass]] = {}
    for c in classes:
        by_room.setdefault(c.room, []).append(c)
    rooms = sorted(by_room)

    def put(c: BinClass) -> None:
        if c.room not in by_room:
            by_room[c.room] = []
            insort(rooms, c.room)
        by_room[c.room].append(c)

    for x in sorted(small, reverse=True):
        left = small[x]
        while left:
            at = bisect_left(rooms, x)
            if at == len(rooms):
                per = capacity // x
                put(BinClass(max(1, left // per), (), capacity))
                at = bisect_left(rooms, x)
            room = rooms[at]
            c = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
                rooms.pop(at)
            per = min(room // x, left)
            full = min(c.count, left // per)
            put(BinClass(full, (*c.content, (x, per)), room - x * per))
            left -= full * per
            if c.count > full:
                put(BinClass(c.count - full, c.content, room))
    return [c for own in by_room.values() for c in own if c.content]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[BinClass]:
    """Classes of bins that hold exactly the pieces of the histogram ``counts``; of several attempts, the fewest bins."""
    counts = {x: n for x, n in counts.items() if n}
    best: list[BinClass] | None = None
    bound = -(-sum(x * n for x, n in counts.items()) // capacity)
    for share, groups in ATTEMPTS:
        large = [x for x in counts if x > capacity * share]
        size_of = linear_groups(large, counts, groups)
        rounded: dict[int, int] = {}
        for x in large:
            rounded[size_of[x]] = rounded.get(size_of[x], 0) + counts[x]
        classes = substitute(configurations(rounded, capacity), size_of, counts, capacity)
        found = best_fit(classes, {x: n for x, n in counts.items() if x <= capacity * share}, capacity)
        if best is None or sum(c.count for c in found) < sum(c.count for c in best):
            best = found
        if sum(c.count for c in best) == bound:
            break
    return best or []


@dataclass
class Places:
    """For each length, runs of ranks: first rank, first sequence, offset in the sequence, copies a sequence."""

    begin: np.ndarray  # of a length's runs in the arrays below; capacity + 2 entries
    rank: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    copies: np.ndarray

    @staticmethod
    def of(classes: list[BinClass], capacity: int) -> Places:
        runs: dict[int, list[tuple[int, int, int, int]]] = {}
        used: dict[int, int] = {}
        sequence = 0
        for c in classes:
            offset = 0
            for x, n in c.content:
                runs.setdefault(x, []).append((used.get(x, 0), sequence, offset, n))
                used[x] = used.get(x, 0) + n * c.count
                offset += x * n
            sequence += c.count
        begin = np.zeros(capacity + 2, np.int64)
        for x, own in runs.items():
            begin[x + 1] = len(own)
        table = np.array([r for x in sorted(runs) for r in runs[x]], np.int64).reshape(-1, 4)
        return Places(np.cumsum(begin), *table.T.copy())

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the pieces with these lengths and ranks."""
        at = np.zeros(length.size, np.int64)
        for x in np.unique(length):
            own = length == x
            a, b = self.begin[x], self.begin[x + 1]
            at[own] = a + np.searchsorted(self.rank[a:b], rank[own], "right") - 1
        nth = rank - self.rank[at]
        return self.sequence[at] + nth // self.copies[at], self.offset[at] + nth % self.copies[at] * length


def pieces(df: DataFrame, name: str = WORD_VOCABULARY, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of each document's ids followed by the end token."""
    ship(df.sparkSession)
    path = vocabulary(name)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        X.begin("tokens")
        encoder = word_encoder(path)
        for batch in batches:
            for first, _, data, off in X.blocks(X.text_column(batch.column(1))):
                ids, counts = encoder.ids(data, off)
                end = np.cumsum(counts)
                row, piece, start, length, crc = [], [], [], [], []
                for k, (a, b) in enumerate(zip((end - counts).tolist(), end.tolist(), strict=True)):
                    own = np.append(ids[a:b], END_TOKEN).astype("<u4").tobytes()
                    for p, at in enumerate(range(0, len(own), 4 * capacity)):
                        part = own[at : at + 4 * capacity]
                        row.append(first + k)
                        piece.append(p)
                        start.append(at // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    kind = df.schema["doc_id"].dataType.simpleString()
    return df.select("doc_id", "text").mapInArrow(cut, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces with a ``length``.

    Ranks within a length are counted in blocks, so that a length which many pieces share isn't one task's. What reaches
    the driver are the counts of at most ``capacity`` lengths and of at most capacity + MOST_BLOCKS blocks.
    """
    spark = cut.sparkSession
    ship(spark)
    found = settle(cut, "pieces")
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    size = max(BLOCK_PIECES, -(-sum(counts.values()) // MOST_BLOCKS))
    salts = np.zeros(capacity + 1, np.int64)
    for x, n in counts.items():
        salts[x] = -(-n // size)
    begin = np.append(0, np.cumsum(salts))  # of a length's blocks among all
    of_length = F.get(F.array(*[F.lit(int(n)) for n in salts]), F.col("length").cast("int"))
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.greatest(of_length, F.lit(1))).cast("int"))
    held = np.zeros(int(begin[-1]), np.int64)
    for row in salted.groupBy("length", "salt").agg(F.count("*").alias("n")).toLocalIterator():
        held[begin[row["length"]] + row["salt"]] = row["n"]
    before = np.cumsum(held) - held
    before -= np.repeat(before[np.minimum(begin[:-1], max(0, held.size - 1))] if held.size else begin[:-1], salts)
    shared = spark.sparkContext.broadcast((begin, before, Places.of(plan(counts, capacity), capacity)))
    names = [*cut.columns, "sequence_id", "offset"]
    schema = ", ".join([f"`{c}` {t}" for c, t in cut.dtypes] + ["sequence_id bigint", "`offset` bigint"])
    width = len(cut.columns)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin, before, places = shared.value
        seen: dict[int, int] = {}  # pieces so far of a block, whose rows are sorted together
        for batch in batches:
            length, salt = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "salt"))
            key = begin[length] + salt
            border = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if key.size else np.zeros(0, np.int64)
            nth = np.arange(key.size) - np.repeat(border, np.diff(np.append(border, key.size)))
            if key.size:
                head = int(key[0])
                carried = seen.get(head, 0)
                nth[: border[1] if border.size > 1 else key.size] += carried
                seen = {int(key[-1]): int(nth[-1]) + 1}
            sequence, offset = places.find(length, before[key] + nth)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(width)), pa.array(sequence), pa.array(offset)], names=names)

    dealt = salted.repartition("length", "salt").sortWithinPartitions("length", "salt", "doc_id", "piece", "ids_crc32")
    return dealt.mapInArrow(placed, schema)


def best_fit_order(lengths: list[int], capacity: int) -> int:
    """Bins of plain best-fit decreasing over single pieces; a yardstick for tests and small inputs."""
    rooms: list[int] = []
    for x in heapq.nlargest(len(lengths), lengths):
        at = bisect_left(rooms, x)
        room = rooms.pop(at) if at < len(rooms) else capacity
        insort(rooms, room - x)
    return len(rooms)


def pack_documents(docs: DataFrame) -> DataFrame:
    return pack(pieces(docs)).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places; nulls, ties and repeats as the module states."""
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the packed pieces of all documents that are left; null and empty texts are their end token alone."""
    return pack_documents(docs)
