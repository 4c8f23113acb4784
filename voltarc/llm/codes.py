"""Vector code compression: a code of one byte a part, from codebooks refined by Lloyd's rounds with Hamerly's bounds.

Components become integers, vectors are cut into equal parts, and each part position has its own codebook. A round assigns
every part to its nearest entry and replaces each entry by the mean of its parts. Each part keeps an upper bound of the
distance to its entry and a lower bound of that to all others, in the settled table of its vector: when entries have moved,
the bounds move by as much, and only a part whose bounds don't say strictly that its entry is still nearest is measured,
first against its own entry, then against all. Distances are integers, bounds are rounded outwards, and a tie fails the
strict test, so that each part gets what a full search gives it, the lower index in ties included.

Vectors stay on the executors; the driver sees the first entries and, each round, sums and counts of the entries.

Defined cases: a null vector, or one with a null or a component that isn't finite, is left out; repeated rows and ids are
vectors each; a null vec_id comes last in the order that gives the first entries, equal vec_ids in the order of their
vectors; with fewer vectors than entries all are entries, and equal entries leave the later ones unused; vectors of other
lengths than the longest, or of a length that the parts don't divide, count as longer by zeros; integers are held within
LARGEST of zero, so that sums of squares fit 64 bits; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle, ship, unsettle

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: So that the squared distances of 4096 components still fit 64 bits.
LARGEST = 1 << 24
#: Parts that are measured against all entries at once.
AT_ONCE = 4096
#: More than the error of a square root, a sum or a difference of doubles, relatively.
SLACK = 2.0**-50


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the nearest entry of each row, the lower one in ties, and the squared distances to it and to the second nearest."""
    index, first, second = np.empty(len(x), np.int64), np.empty(len(x), np.int64), np.empty(len(x), np.float64)
    squares = (book * book).sum(1)
    for a in range(0, len(x), AT_ONCE):
        part = x[a : a + AT_ONCE]
        d = (part * part).sum(1)[:, None] - 2 * (part @ book.T) + squares
        rows = np.arange(len(part))
        best = d.argmin(1)
        index[a : a + AT_ONCE], first[a : a + AT_ONCE] = best, d[rows, best]
        if len(book) == 1:
            second[a : a + AT_ONCE] = np.inf
        else:
            d[rows, best] = np.iinfo(np.int64).max
            second[a : a + AT_ONCE] = d.min(1)
    return index, first, second


def above(squared: np.ndarray) -> np.ndarray:
    """An upper bound of the root."""
    return np.sqrt(squared.astype(np.float64)) * (1 + SLACK)


def below(squared: np.ndarray) -> np.ndarray:
    """A lower bound of the root."""
    return np.sqrt(squared.astype(np.float64)) * (1 - SLACK)


def _narrow(x: np.ndarray, to: float) -> np.ndarray:
    """As 32-bit numbers, rounded towards ``to``."""
    return np.nextafter(x.astype(np.float32), np.float32(to))


class Moves:
    """How the entries of all codebooks have moved, as Hamerly's tests need it."""

    def __init__(self, old: np.ndarray, new: np.ndarray) -> None:
        n = new.shape[1]
        self.own = above(((new - old) ** 2).sum(2))  # by part and entry
        ranked = np.sort(self.own, 1)
        last = ranked[:, -1:]
        self.others = np.where(self.own == last, ranked[:, -2:-1] if n > 1 else 0.0, last)
        between = ((new[:, :, None, :] - new[:, None, :, :]) ** 2).sum(3)
        between[:, np.arange(n), np.arange(n)] = np.iinfo(np.int64).max
        self.half = below(between.min(2)) / 2 if n > 1 else np.full(self.own.shape, np.inf)


def reassign(x: np.ndarray, code: np.ndarray, upper: np.ndarray, lower: np.ndarray, book: np.ndarray, own: np.ndarray, others: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """One part position after its entries have moved: new codes and bounds, and how many parts were measured against all entries."""
    code = code.copy()
    upper = (upper + own[code]) * (1 + SLACK)
    lower = np.maximum(lower - others[code] * (1 + SLACK), 0) * (1 - SLACK)
    safe = np.maximum(lower, half[code])
    near = np.flatnonzero(~(upper < safe))
    if near.size:
        diff = x[near] - book[code[near]]
        upper[near] = above((diff * diff).sum(1))
    full = near[~(upper[near] < safe[near])]
    if full.size:
        code[full], first, second = nearest(x[full], book)
        upper[full], lower[full] = above(first), below(second)
    return code, upper, lower, full.size


def _matrix(column: pa.Array, n: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(kind)


def _lists(table: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = table.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(np.ascontiguousarray(table).ravel(), kind))


def integers(vectors: DataFrame, vector: str, keep: list[str], parts: int, scale: int) -> DataFrame:
    """``keep`` and v, the components as integers, of the vectors that count."""
    ok = F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(vector, lambda x: F.greatest(F.least(F.floor(x.cast("double") * scale), F.lit(LARGEST)), F.lit(-LARGEST)).cast("int"))
    rows = settle(vectors.where(ok).select(*keep, whole.alias("v")), "vectors")
    sizes = rows.agg(F.min(F.size("v")).alias("least"), F.max(F.size("v")).alias("most")).collect()[0]
    wide = max(1, -(-(sizes["most"] or 0) // parts)) * parts
    if sizes["least"] in (None, wide):
        return rows
    out = settle(rows.select(*keep, F.concat("v", F.array_repeat(F.lit(0), F.lit(wide) - F.size("v"))).alias("v")), "vectors")
    unsettle(rows)
    return out


def _assigned(rows: DataFrame, keep: list[str], books: np.ndarray, moves: Moves | None, last: bool) -> DataFrame:
    """Rows with codes for ``books``: bounds are carried on, or in the last assignment replaced by the errors."""
    parts = len(books)
    plain = rows.select(*keep).schema
    kept = len(keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain) + (", code binary, error bigint" if last else ", v array<int>, code binary, upper array<float>, lower array<float>")
    own = moves and (moves.own, moves.others, moves.half)

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = _matrix(batch.column(kept), n, np.int64).reshape(n, parts, -1)
            code, upper, lower = np.empty((n, parts), np.uint8), np.empty((n, parts)), np.empty((n, parts))
            if own:
                before = np.frombuffer(b"".join(batch.column(kept + 1).to_pylist()), np.uint8).reshape(n, parts).astype(np.int64)
                high, low = _matrix(batch.column(kept + 2), n, np.float64), _matrix(batch.column(kept + 3), n, np.float64)
            for p in range(parts):
                if own:
                    code[:, p], upper[:, p], lower[:, p], _ = reassign(x[:, p], before[:, p], high[:, p], low[:, p], books[p], *(t[p] for t in own))
                else:
                    code[:, p], first, second = nearest(x[:, p], books[p])
                    upper[:, p], lower[:, p] = above(first), below(second)
            out = [batch.column(k) for k in range(kept if last else kept + 1)]
            flat = code.tobytes()
            out.append(pa.array([flat[k * parts : (k + 1) * parts] for k in range(n)], pa.binary()))
            if last:
                off = x - np.stack([books[p][code[:, p]] for p in range(parts)], 1)
                out.append(pa.array((off * off).sum((1, 2)), pa.int64()))
            else:
                out += [_lists(_narrow(upper, np.inf), pa.float32()), _lists(np.maximum(_narrow(lower, -np.inf), 0), pa.float32())]
            yield pa.RecordBatch.from_arrays(out, names=[*plain.names, *(("code", "error") if last else ("v", "code", "upper", "lower"))])

    return rows.mapInArrow(assigned, schema)


def means(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Floored means of the parts of each entry; entries without parts stay. Each task sends one row a number of the codebooks."""
    parts, entries, width = books.shape

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = _matrix(batch.column(0), n, np.int64).reshape(n, parts, -1)
            code = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(n, parts).astype(np.int64)
            for p in range(parts):
                np.add.at(total[p], code[:, p], x[:, p])
                count[p] += np.bincount(code[:, p], minlength=entries)
        part, entry = np.nonzero(count)
        columns = [part.repeat(width), entry.repeat(width), np.tile(np.arange(width), part.size), total[part, entry].ravel(), count[part, entry].repeat(width)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["part", "entry", "place", "s", "n"])

    sent = rows.select("v", "code").mapInArrow(summed, "part bigint, entry bigint, place bigint, s bigint, n bigint")
    out = books.copy()
    for r in sent.groupBy("part", "entry", "place").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).toLocalIterator():  # a row a number of the codebooks
        out[r["part"], r["entry"], r["place"]] = int(r["s"]) // r["n"]
    return out


def compress(vectors: DataFrame, vector: str = "embedding", order: str = "vec_id", keep: tuple[str, ...] = ("vec_id",), parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """``keep``, code (a byte a part) and error of each vector that counts, and the codebooks (part, entry, place)."""
    ship(vectors.sparkSession)
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte a part")
    names = list(keep)
    rows = integers(vectors, vector, names, parts, scale)
    first = rows.orderBy(F.col(order).asc_nulls_last(), "v").limit(entries).select("v").collect()
    if not first:
        return rows.select(*names, F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error")), np.zeros((parts, 0, 0), np.int64)
    books = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    moves = None
    for k in range(rounds + 1):
        replaced, rows = rows, settle(_assigned(rows, names, books, moves, k == rounds), "codes")
        unsettle(replaced)
        if k < rounds:
            old, books = books, means(rows, books)
            moves = Moves(old, books)
    return rows, books


def expand(code: bytes, books: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The vector that a code stands for."""
    return np.concatenate([books[p][k] for p, k in enumerate(code)]) / scale


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and errors of all embeddings; nulls, ties and repeats as the module states."""
    coded, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), keep=("vec_id", "label"))
    # written first, so that a hot label's rows in the join can be split
    labels = settle(coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label"), "labels")
    joined = coded.join(labels, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
