"""Series for charts: few points a curve, scales of the axes and bands around cohort medians."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.series import thinned

#: Points of a curve on a page, at most.
MOST_POINTS = 120


def curves(df: DataFrame, keys: Sequence[str], x: Column, y: Column, most: int = MOST_POINTS) -> DataFrame:
    """(keys, points, n, shown): each series as an array of (x, y) in order, thinned to ``most`` points if it has more of them.

    A series is one array, so it has to be bounded (months or bins, not raw rows). Points without x or y are left out; of one
    x with several y all stay. ``n`` and ``shown`` say how many there are and how many are drawn.
    """
    known = df.select(*keys, x.cast("double").alias("x"), y.cast("double").alias("y")).where("x IS NOT NULL AND y IS NOT NULL")
    packed = known.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("x", "y"))).alias("_all"))
    return packed.select(*keys, thinned(F.col("_all"), most).alias("points"), F.size("_all").alias("n")).withColumn("shown", F.size("points"))


def nice(low: Column, high: Column, ticks: int = 6) -> dict[str, Column]:
    """Ends and step of an axis that holds ``low`` to ``high``: the smallest step of 1, 2 or 5 times a power of ten that needs at most ``ticks`` steps, but for the ends."""
    span = F.when(high > low, high - low).otherwise(F.greatest(F.abs(high), F.lit(1.0)))
    raw = span / ticks
    power = F.pow(F.lit(10.0), F.floor(F.log10(raw)))
    share = raw / power
    step = power * F.when(share <= 1, 1.0).when(share <= 2, 2.0).when(share <= 5, 5.0).otherwise(10.0)
    return {"low": F.floor(low / step) * step, "high": F.ceil(high / step) * step, "step": step}


def scales(df: DataFrame, keys: Sequence[str], columns: Sequence[str], ticks: int = 6) -> DataFrame:
    """(keys, {column}_low, {column}_high, {column}_step): axes that hold all of a page's series, over one aggregate."""
    ends = df.groupBy(*keys).agg(*[f(c).cast("double").alias(f"_{n}_{c}") for c in columns for n, f in (("a", F.min), ("b", F.max))])
    axis = {c: nice(F.col(f"_a_{c}"), F.col(f"_b_{c}"), ticks) for c in columns}
    return ends.select(*keys, *[v.alias(f"{c}_{n}") for c in columns for n, v in axis[c].items()])


def bands(trend: DataFrame, key: str, x: Column, middle: str, low: str, high: str, most: int = MOST_POINTS) -> DataFrame:
    """(key, line, points, n, shown): a cohort's median and the quantiles around it, each as a curve of its own."""
    lines: Mapping[str, str] = {"median": middle, "low": low, "high": high}
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("line"), F.col(c).cast("double").alias("y")) for name, c in lines.items()]))
    return curves(trend.select(key, x.alias("_x"), each.alias("_l")).select(key, "_x", F.col("_l.line").alias("line"), F.col("_l.y").alias("_y")), [key, "line"], F.col("_x"), F.col("_y"), most)
