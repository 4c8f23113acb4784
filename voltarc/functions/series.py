"""Operators on ordered series: runs, rolling outliers, monotone regression, trimming, spines and crossings."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stats import MAD_SCALE, TINY, sorted_median


def seconds(ts: str | Column) -> Column:
    """Whole seconds of a timestamp, with or without time zone."""
    return F.floor(F.unix_micros(F.col(ts).cast("timestamp") if isinstance(ts, str) else ts.cast("timestamp")) / 1_000_000).cast("long")


def month_index(ym: str | Column, kind: str = "int") -> Column:
    """'2024-03' -> 2024 * 12 + 3; the year is all before the hyphen, since a flat line's forecast may have more digits than four."""
    c = F.col(ym) if isinstance(ym, str) else ym
    hyphen = F.locate("-", c, 2)  # one at the first place is a sign
    return F.substring(c, F.lit(1), hyphen - 1).cast(kind) * 12 + F.substring(c, hyphen + 1, F.lit(2)).cast("int")


def month_text(index: Column) -> Column:
    """The inverse of month_index; December stays in its year."""
    i = index.cast("long") - 1
    return F.format_string("%d-%02d", F.floor(i / 12), (F.pmod(i, F.lit(12)) + 1).cast("int"))


def gap_flag(df: DataFrame, device: str, ts: str, hours: float, out: str = "time_gap", before: Column | None = None) -> DataFrame:
    """True at a device's first row and after more than ``hours`` without one; ``before`` is the second of a row ahead of the first."""
    last = F.lag(seconds(ts)).over(Window.partitionBy(device).orderBy(ts))
    return df.withColumn(out, F.coalesce(seconds(ts) - (last if before is None else F.coalesce(last, before)) > hours * 3600, F.lit(True)))


def rest_runs(df: DataFrame, device: str, ts: str, rest: Column, gap_s: float, min_s: float, before: Column | None = None, since: Column | None = None) -> DataFrame:
    """Gaps and islands: adds is_rest, rest_s (seconds since the run began) and run_end (last row of a long run).

    A row after a longer gap is no rest row itself and so can't begin a run; a device's first row is exempt. One exchange
    on the device serves all windows. If rows ahead of these have been left out, ``before`` is the second of the last one and
    ``since`` that in which its run began, null if it is no rest row.
    """
    w = Window.partitionBy(device).orderBy(ts)
    t, last = F.col("_t"), F.lag("_t").over(w)
    base = df.withColumn("_t", seconds(ts)).withColumn("_dt", t - (last if before is None else F.coalesce(last, before)))
    base = base.withColumn("_own", t if since is None else F.when(last.isNull(), F.coalesce(since, t)).otherwise(t))
    base = base.withColumn("is_rest", F.coalesce(rest, F.lit(False)) & F.coalesce(F.col("_dt") <= gap_s, F.lit(True)))
    starts = (F.col("is_rest") & ~F.coalesce(F.lag("is_rest").over(w), F.lit(False))).cast("int")
    runs = base.withColumn("_start", starts).withColumn("_run", F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    began = F.min(F.when(F.col("is_rest"), F.col("_own"))).over(Window.partitionBy(device, "_run"))
    timed = runs.withColumn("rest_s", F.when(F.col("is_rest"), t - began).otherwise(F.lit(0)).cast("long"))
    ends = (F.col("rest_s") >= min_s) & F.col("is_rest") & ~F.coalesce(F.lead("is_rest").over(w), F.lit(False))
    return timed.withColumn("run_end", ends).drop("_t", "_dt", "_own", "_start", "_run")


def rolling_mad(df: DataFrame, keys: Sequence[str], order: str, value: str, window: int, k: float, eligible: Column | None = None) -> DataFrame:
    """Adds is_spike and cleaned: outliers of a centred window of rows, replaced by the median of its other values.

    The window is cut at the ends of a series and needs three values; without spread any deviation is an outlier.
    """
    half = window // 2
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-half, half)
    near = df.withColumn("_near", F.collect_list(value).over(w))
    med = near.withColumn("_med", sorted_median(F.col("_near")))
    dev = med.withColumn("_scale", MAD_SCALE * sorted_median(F.transform("_near", lambda v: F.abs(v - F.col("_med")))))
    off = F.abs(F.col(value) - F.col("_med"))
    spike = (F.size("_near") >= 3) & F.when(F.col("_scale") <= TINY, off > 1e-9).otherwise(off > k * F.col("_scale"))
    marked = dev.withColumn("is_spike", F.coalesce(spike & (F.lit(True) if eligible is None else eligible), F.lit(False)))
    others = F.collect_list(F.when(~F.col("is_spike"), F.col(value))).over(w)
    return marked.withColumn("_others", others).withColumn("cleaned", F.when(F.col("is_spike"), F.coalesce(sorted_median(F.col("_others")), F.col(value))).otherwise(F.col(value))).drop("_near", "_med", "_scale", "_others")


def pava(values: Column, weights: Column) -> Column:
    """Weighted non-increasing regression of an array: blocks are pooled while an earlier one lies below a later one."""
    block = "struct<s:double,w:double,n:int>"

    def level(b: Column) -> Column:
        return b["s"] / b["w"]

    def push(stack: Column, x: Column) -> Column:
        def pool(a: Column, b: Column) -> Column:
            open_ = (F.size(a["kept"]) == 0) & (level(b) < level(a["cur"]))
            both = F.struct((a["cur"]["s"] + b["s"]).alias("s"), (a["cur"]["w"] + b["w"]).alias("w"), (a["cur"]["n"] + b["n"]).alias("n"))
            return F.when(open_, F.struct(both.alias("cur"), a["kept"].alias("kept"))).otherwise(F.struct(a["cur"].alias("cur"), F.array_append(a["kept"], b).alias("kept")))

        start = F.struct(x.alias("cur"), F.array().cast(f"array<{block}>").alias("kept"))
        done = F.aggregate(F.reverse(stack), start, pool)
        return F.array_append(F.reverse(done["kept"]), done["cur"])

    each = F.zip_with(values, weights, lambda v, w: F.struct((v * w).cast("double").alias("s"), w.cast("double").alias("w"), F.lit(1).alias("n")))
    stack = F.aggregate(each, F.array().cast(f"array<{block}>"), push)
    return F.flatten(F.transform(stack, lambda b: F.array_repeat(level(b), b["n"])))


def pava_series(df: DataFrame, keys: Sequence[str], order: str, value: str, weight: str, out: str) -> DataFrame:
    """pava() over each series; a series is one bounded array (months), never a device's raw rows."""
    packed = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), F.col(value).alias("_v"), F.greatest(F.col(weight).cast("double"), F.lit(1.0)).alias("_w")))).alias("_a"))
    fitted = packed.withColumn("_y", pava(F.transform("_a", lambda r: r["_v"]), F.transform("_a", lambda r: r["_w"])))
    rows = fitted.select(*keys, F.explode(F.arrays_zip(F.transform("_a", lambda r: r["_o"]).alias("o"), F.col("_y").alias("y"))).alias("_z"))
    return df.join(rows.select(*keys, F.col("_z.o").alias(order), F.col("_z.y").alias(out)), [*keys, order])


def leading_trim(df: DataFrame, keys: Sequence[str], order: str, ratio: Column, low: float) -> DataFrame:
    """Drop a series' first rows below ``low`` if the rest's median is not: start-up noise, not decline."""
    g = Window.partitionBy(*keys)
    ahead = g.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    marked = df.withColumn("_r", ratio).withColumn("_on", F.max(F.coalesce(F.col("_r") >= low, F.lit(True)).cast("int")).over(ahead) == 1)
    rest = marked.withColumn("_rest", F.median(F.when(F.col("_on"), F.col("_r"))).over(g))
    return rest.where(F.col("_on") | ~F.coalesce(F.col("_rest") >= low, F.lit(False))).drop("_r", "_on", "_rest")


def crossing(df: DataFrame, keys: Sequence[str], x: str, y: str, line: float, start_above: bool = False) -> DataFrame:
    """(keys, x_cross): where a series first meets ``line``, interpolated; ``start_above``: only if it begins at or over it."""
    w = Window.partitionBy(*keys).orderBy(x)
    px, py = F.lag(x).over(w), F.lag(y).over(w)
    steps = df.where(F.col(y).isNotNull()).withColumns({"_px": px, "_py": py, "_y0": F.first(y).over(w)})
    met = (F.col("_py") - line) * (F.col(y) - line) <= 0
    at = F.when(F.col("_py") == F.col(y), F.col("_px")).otherwise(F.col("_px") + (line - F.col("_py")) * F.try_divide(F.col(x) - F.col("_px"), F.col(y) - F.col("_py")))
    hit = steps.where(met & (F.col("_y0") >= line if start_above else F.lit(True))).withColumn("_at", at.cast("double"))
    return hit.groupBy(*keys).agg(F.min_by("_at", x).alias("x_cross"))


def month_spine(df: DataFrame, key: str, first: Column, last: Column) -> DataFrame:
    """(key, mi) for every month index from ``first`` to the key's ``last``."""
    return df.groupBy(key).agg(first.alias("_a"), last.alias("_b")).where("_b >= _a").select(key, F.explode(F.sequence("_a", "_b")).alias("mi"))


def thinned(points: Column, most: int) -> Column:
    """At most ``most`` points of an array of (x, y) in order, for a chart: its ends, and of each stretch between the highest and
    the lowest y and the point that makes the largest triangle with what was taken last and the next stretch's mean.

    Stretches hold equal numbers of points. Highest and lowest points of the whole array always stay; the first of equals is
    taken. Shorter arrays stay as they are; points without y should be left out before.
    """
    n, parts = F.size(points), max(1, (most - 2) // 3)
    cut = lambda k: (F.lit(1) + F.floor((n - 2) * k / parts)).cast("int")
    stretch = lambda k: F.slice(points, cut(k) + 1, F.greatest(cut(k + 1) - cut(k), F.lit(0)))

    def mean(a: Column, of: str) -> Column:
        return F.aggregate(a, F.lit(0.0), lambda s, p: s + p[of]) / F.size(a)

    def step(taken: Column, k: Column) -> Column:
        own, last = stretch(k), F.element_at(taken, -1)
        ahead = F.when(k + 1 < parts, stretch(k + 1)).otherwise(F.slice(points, n, 1))
        ahead = F.when(F.size(ahead) > 0, ahead).otherwise(F.slice(points, n, 1))
        x2, y2 = mean(ahead, "x"), mean(ahead, "y")

        def best(key: Callable[[Column], Column]) -> Column:
            # max of structs: the largest key, then the smallest x
            return F.aggregate(own, F.struct(F.lit(None).cast("double").alias("v"), F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y")),
                               lambda b, p: F.when(b["v"].isNull() | (key(p) > b["v"]), F.struct(key(p).alias("v"), p["x"].alias("x"), p["y"].alias("y"))).otherwise(b))

        area = best(lambda p: F.abs((last["x"] - x2) * (p["y"] - last["y"]) - (last["x"] - p["x"]) * (y2 - last["y"])))
        found = F.array(area, best(lambda p: p["y"]), best(lambda p: -p["y"]))
        chosen = F.array_sort(F.array_distinct(F.transform(F.filter(found, lambda b: b["v"].isNotNull()), lambda b: F.struct(b["x"].alias("x"), b["y"].alias("y")))))
        return F.concat(taken, chosen)

    inner = F.aggregate(F.sequence(F.lit(0), F.lit(parts - 1)), F.slice(points, 1, 1), step)
    return F.when(n <= most, points).otherwise(F.concat(inner, F.slice(points, n, 1)))
