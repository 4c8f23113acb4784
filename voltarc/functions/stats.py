"""Column builders for the statistics that Spark's own functions don't give as needed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

#: Scale of a median absolute deviation that estimates a standard deviation.
MAD_SCALE = 1.4826
TINY = 1e-12


def sorted_median(values: Column) -> Column:
    """Median of an array without nulls; null of an empty one. An even count averages the two in the middle."""
    a, n = F.array_sort(values), F.size(values)
    return F.when(n > 0, (F.get(a, F.floor((n - 1) / 2).cast("int")) + F.get(a, F.floor(n / 2).cast("int"))) / 2)


def nearest_quantile(value: Column, q: float) -> Column:
    """Aggregate: the element at round((n - 1) q) of the sorted non-null values (half away from zero)."""
    return F.get(F.array_sort(F.collect_list(value)), F.round((F.count(value) - 1) * F.lit(q)).cast("int"))


def mad_keep(df: DataFrame, keys: Sequence[str], value: str, k: float, out: str = "keep") -> DataFrame:
    """Mark the rows of a group within k scaled median deviations of its median; groups under three or without spread keep all."""
    g = Window.partitionBy(*keys)
    with_median = df.withColumns({"_n": F.count(value).over(g), "_med": F.median(value).over(g)}).withColumn("_dev", F.abs(F.col(value) - F.col("_med")))
    scale = F.median("_dev").over(g) * MAD_SCALE
    return with_median.withColumn("_scale", scale).withColumn(out, (F.col("_n") < 3) | (F.col("_scale") <= TINY) | (F.col("_dev") <= k * F.col("_scale"))).drop("_n", "_med", "_dev", "_scale")


def weighted_median(df: DataFrame, keys: Sequence[str], value: str, weight: str, out: str = "weighted_median") -> DataFrame:
    """Lower weighted median of each group: the first value, in order, at which half the weight is reached.

    Groups whose weight isn't positive take the plain median. Weights are added up by value before anything is ordered, so
    that a group is as long as its distinct values.
    """
    g = Window.partitionBy(*keys)
    held = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.sum(weight).alias("_w"), F.count("*").alias("_n"))
    summed = held.withColumns({"_cw": F.sum("_w").over(g.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)), "_tw": F.sum("_w").over(g)})
    plain = F.percentile("_v", F.lit(0.5), F.col("_n"))
    return summed.groupBy(*keys).agg(F.when(F.max("_tw") > 0, F.min(F.when(F.col("_cw") >= F.col("_tw") * 0.5, F.col("_v")))).otherwise(plain).alias(out))


def divided(a: Column, b: Column) -> Column:
    """a / b as IEEE 754 has it: infinite over zero, NaN for zero over zero."""
    over_zero = F.when(a == 0, float("nan")).when(a > 0, float("inf")).when(a < 0, float("-inf"))
    return F.when(b == 0, over_zero).otherwise(F.try_divide(a, b))


def ols_slope(y: Column, x: Column, least: int) -> Column:
    """Aggregate: least-squares slope over complete pairs; null under ``least`` of them or if x doesn't vary."""
    return F.when(F.regr_count(y, x) >= least, F.try_divide(F.covar_pop(x, y), F.var_pop(F.when(y.isNotNull(), x))))


def ols_r2(y: Column, x: Column, flat: Column, over: WindowSpec | None = None) -> Column:
    """Aggregate: the share of y's variance that a line explains, over complete pairs; ``flat`` where y doesn't vary.

    It is the squared correlation in the steps of the SQL's regr_r2, to which the last bits belong: the fourth digit may be
    a tie in the numbers themselves. With ``over``, a window in order, they don't hang on the order of a shuffle either.
    """
    own = (lambda c: c) if over is None else (lambda c: c.over(over))
    a, b = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    sxy, sxx, syy = own(F.covar_pop(x, y)), own(F.covar_pop(a, a)), own(F.covar_pop(b, b))
    r = F.try_divide(sxy, F.sqrt(sxx) * F.sqrt(syy))
    return F.when(syy > 0, F.coalesce(r * r, F.lit(0.0))).otherwise(flat)


def half_up(c: Column, digits: int) -> Column:
    """Rounded as the SQL's round() does: of the product with a power of ten, halves away from zero."""
    scale = float(10**digits)
    return F.signum(c) * F.floor(F.abs(c) * scale + 0.5) / scale


def guarded_corr(x: Column, y: Column, least: int = 4) -> Column:
    """Aggregate: Pearson r; null under ``least`` pairs or if either side's deviation is negligible."""
    sx, sy = F.sqrt(F.regr_sxx(y, x) / F.regr_count(y, x)), F.sqrt(F.regr_syy(y, x) / F.regr_count(y, x))
    return F.when((F.regr_count(y, x) >= least) & (sx >= 1e-9) & (sy >= 1e-9), F.regr_sxy(y, x) / F.sqrt(F.regr_sxx(y, x) * F.regr_syy(y, x)))


def interpolated(at: Column, xs: Sequence[float], ys: Sequence[float]) -> Column:
    """Piecewise-linear lookup in a curve with rising xs, clamped at its ends; null stays null."""
    x, y = F.array(*[F.lit(float(v)) for v in xs]), F.array(*[F.lit(float(v)) for v in ys])
    k = F.size(F.filter(x, lambda v: v <= at))
    x0, x1, y0, y1 = F.get(x, k - 1), F.get(x, k), F.get(y, k - 1), F.get(y, k)
    inner = y0 + (at - x0) * F.try_divide(y1 - y0, x1 - x0)
    return F.when(at.isNull(), F.lit(None).cast("double")).when(k == 0, F.lit(float(ys[0]))).when(k >= len(xs), F.lit(float(ys[-1]))).otherwise(inner)


def finite(c: Column) -> Column:
    """NaN and infinities as null."""
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)


def binned_mode(df: DataFrame, keys: Sequence[str], value: Column, width: float) -> DataFrame:
    """(keys, mode, n_rows): the middle of the commonest bin of each group, the lowest of equals, counted before it is compared."""
    counted = df.withColumn("_bin", F.floor(value / width) * width).where("_bin IS NOT NULL").groupBy(*keys, "_bin").agg(F.count("*").alias("_n"))
    return counted.groupBy(*keys).agg((F.max_by("_bin", F.struct(F.col("_n"), -F.col("_bin"))) + width / 2).alias("mode"), F.sum("_n").alias("n_rows"))
