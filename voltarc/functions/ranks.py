"""Exact quantiles of groups of any size: ranks of large groups are found by counting over bit prefixes, so that none is held.

Values are counted by group first, so that ties are one row. Each value has a 64-bit number that orders as it does. A round
counts a group's rows by the next 16 bits of that number, among the rows that share the bits found so far, and the running
count says which 16 bits the wanted rank has; after four rounds the value is known. A round's counts are at most 65,536 rows
a group and wanted rank, whatever the group's size, and partial counts are made before anything is sent.

Defined cases: nulls don't count; a group without values has null; NaN comes last; 0.0 and -0.0 are equal; a median of an
even count is the mean of the two in the middle; a null key is a group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle
from .stats import nearest_quantile

#: Rows of a group that one task may sort in memory: 8 bytes a value and some for its place.
HELD = 1 << 17
BITS = 16
ROUNDS = 64 // BITS


def ordered_bits(value: Column) -> Column:
    """A long that orders as the double does, NaN last."""
    bits = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value + F.lit(0.0)).cast("long")
    return F.when(bits < 0, bits.bitwiseXOR(F.lit((1 << 63) - 1))).otherwise(bits)


def _ranks(q: float | None) -> list[Column]:
    """The ranks, from 0, that a quantile needs of n values: the nearest one, or the two in the middle for a median (None)."""
    last = F.col("_total") - 1
    return [F.floor(last / 2), F.ceil(last / 2)] if q is None else [F.round(last * F.lit(q))]


def quantiles(rows: DataFrame, keys: Sequence[str], wants: Mapping[str, tuple[str, float | None]]) -> DataFrame:
    """(keys, wants): for each name the quantile (column, q) of a group: the element at round((n - 1) q), or the median if q is None."""
    columns = sorted({c for c, _ in wants.values()})
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("which"), (F.col(c).cast("double") + 0.0).alias("value")) for k, c in enumerate(columns)]))
    values = rows.select(*keys, each.alias("_x")).select(*keys, F.col("_x.which").alias("_c"), F.col("_x.value").alias("_v")).where("_v IS NOT NULL")
    counted = settle(values.groupBy(*keys, "_c", "_v").agg(F.count("*").alias("_n")).withColumn("_bits", ordered_bits(F.col("_v"))), "counted")

    asked = [(2 * k + j, columns.index(c), r) for k, (c, q) in enumerate(wants.values()) for j, r in enumerate(_ranks(q))]
    rank = [F.when(F.col("_c") == c, F.struct(F.lit(k).alias("want"), r.cast("long").alias("rank"))) for k, c, r in asked]
    group = [*keys, "_c"]
    at = None
    for turn in range(ROUNDS):
        digit = F.shiftright("_bits", 64 - BITS * (turn + 1))
        if at is None:
            # all groups: their totals say the ranks
            counts = counted.groupBy(*group, digit.alias("_p")).agg(F.sum("_n").alias("_n"))
            run = Window.partitionBy(*group).orderBy("_p")
            counts = counts.withColumns({"_upto": F.sum("_n").over(run.rowsBetween(Window.unboundedPreceding, 0)), "_total": F.sum("_n").over(Window.partitionBy(*group))})
            counts = counts.withColumn("_w", F.explode(F.array_compact(F.array(*rank)))).withColumns({"_want": F.col("_w.want"), "_rank": F.col("_w.rank")})
        else:
            same = reduce(lambda a, b: a & b, [F.col(f"c.{x}").eqNullSafe(F.col(f"h.{x}")) for x in group])
            near = counted.withColumn("_q", F.shiftright("_bits", 64 - BITS * turn)).alias("c").join(at.alias("h"), same & (F.col("c._q") == F.col("h._p")))
            more = [F.min("c._v").alias("_v")] if turn == ROUNDS - 1 else []
            counts = near.groupBy(*[F.col(f"c.{x}").alias(x) for x in group], "h._want", "h._rank", digit.alias("_p")).agg(F.sum("c._n").alias("_n"), *more)
            counts = counts.withColumn("_upto", F.sum("_n").over(Window.partitionBy(*group, "_want").orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)))
        found = counts.where((F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_n")))
        at = found.select(*group, "_want", (F.col("_rank") - F.col("_upto") + F.col("_n")).alias("_rank"), "_p", *(["_v"] if turn == ROUNDS - 1 else []))
    out = []
    for k, (name, (column, q)) in enumerate(wants.items()):
        low, high = (F.max(F.when(F.col("_want") == k * 2 + j, F.col("_v"))) for j in (0, 1))
        kind = rows.schema[column].dataType.simpleString()
        out.append(((low + high) / 2 if q is None else low.cast(kind)).alias(name))
    return at.groupBy(*keys).agg(*out)


def held(df: DataFrame, keys: Sequence[str], wants: Mapping[str, tuple[str, float | None]], *others: Column) -> DataFrame:
    """``wants`` of groups that a task may hold, by Spark's own aggregates."""
    own = [(F.median(c) if q is None else nearest_quantile(F.col(c), q)).alias(name) for name, (c, q) in wants.items()]
    return df.groupBy(*keys).agg(*others, *own)


def aggregate(df: DataFrame, keys: Sequence[str], wants: Mapping[str, tuple[str, float | None]], *others: Column, needs: Sequence[str] = (), most: int = HELD) -> DataFrame:
    """``df`` grouped by ``keys``: other aggregates, which read the columns ``needs``, and ``wants``; ``df`` is read once.

    Groups of up to ``most`` rows are sorted in memory; the ranks of larger ones are found by counting. Both are exact.
    """
    read = list(dict.fromkeys([*keys, *(c for c, _ in wants.values()), *needs]))
    rows = settle(df.select(*read), "ranked")
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("_rows"))
    if (sizes.agg(F.max("_rows")).collect()[0][0] or 0) <= most:
        return held(rows, keys, wants, *others)
    if not keys:
        found = quantiles(rows, keys, wants)
        return rows.agg(*others).crossJoin(found) if others else found  # one row each
    large = settle(sizes.where(F.col("_rows") > most).select(*[F.col(k).alias(f"_{k}") for k in keys], F.lit(True).alias("_large")), "large")
    here = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    parted = rows.join(large, here, "left")
    small, big = parted.where("_large IS NULL").select(*read), parted.where("_large").select(*read)
    plain = big.groupBy(*keys).agg(*(others or [F.lit(1).alias("_one")]))
    same = reduce(lambda a, b: a & b, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    joined = plain.alias("a").join(quantiles(big, keys, wants).alias("b"), same, "left")
    counted = joined.select(*[F.col(f"a.{c}") for c in plain.columns if c != "_one"], *[F.col(f"b.{c}") for c in wants])
    return held(small, keys, wants, *others).unionByName(counted)
