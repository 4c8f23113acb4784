"""Months of a device: robust monthly capacity from its anchors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import MAD_SCALE, TINY, mad_keep

KEYS = ("channel", "device_id", "ym")


def masked(df: DataFrame, keys: Sequence[str], value: str, k: float, least: int) -> DataFrame:
    """Rows of each group without its outliers; groups with fewer than ``least`` rows left go."""
    kept = mad_keep(df, keys, value, k).where("keep").drop("keep")
    return kept.withColumn("_n", F.count("*").over(Window.partitionBy(*keys))).where(F.col("_n") >= least).drop("_n")


def median_by_weight(df: DataFrame, keys: Sequence[str], value: str, weight: str, ties: Sequence[str]) -> DataFrame:
    """Adds what the weighted median of a group is aggregated from: _cw and _tw."""
    g = Window.partitionBy(*keys)
    run = g.orderBy(value, weight, *ties).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({"_cw": F.sum(weight).over(run), "_tw": F.sum(weight).over(g)})


def weighted_median_of(value: str) -> Column:
    return F.when(F.max("_tw") > 0, F.min(F.when(F.col("_cw") >= F.col("_tw") * 0.5, F.col(value)))).otherwise(F.median(value))


def aggregate(scored: DataFrame, least: int = 3, k: float = 3.0, from_month: str | None = None, keys: Sequence[str] = KEYS) -> DataFrame:
    """(channel, device_id, ym, ...) from scored anchors of tier 1 and 2. ``from_month`` prunes rows before they are grouped."""
    df = scored if "ym" in scored.columns else scored.withColumn("ym", F.date_format("ts", "yyyy-MM"))  # a partition column prunes files
    df = df.where((F.col("cap_tier") <= 2) & F.col("capacity_corrected").isNotNull())
    df = df.where(F.col("ym") >= from_month) if from_month else df
    if "model" not in df.columns:
        df = df.withColumn("model", F.lit("unknown"))
    df = median_by_weight(masked(df, keys, "capacity_corrected", k, least), keys, "capacity_corrected", "stat_weight", ["ts"])
    return df.groupBy(*keys).agg(
        weighted_median_of("capacity_corrected").alias("capacity_median"), F.count("*").alias("capacity_count"),
        F.count_if(F.col("cap_tier") == 1).alias("tier1_count"), F.count_if(F.col("cap_tier") == 2).alias("tier2_count"),
        F.avg("temperature").alias("temp_mean"), F.avg("quality_score").alias("score_mean"),
        F.median(F.try_divide("remaining_ah", "c_nom_bms")).alias("soh_bms"),
        F.median("loop_count").alias("loop_median"), F.max("loop_count").alias("loop_max"), F.min("model").alias("model"),
    ).withColumns({"year": F.substring("ym", 1, 4).cast("long"), "month": F.substring("ym", 6, 2).cast("long")})


def from_weights(weights: DataFrame, keys: Sequence[str] = ("device_id", "ym"), k: float = 3.0, least: int = 3) -> DataFrame:
    """(keys, capacity_median, capacity_count, value_mean) from rows (keys, value, w, n), n rows of a value with weight w each.

    The same months as from the rows themselves: medians and deviations count each value as often as it came, so that parts
    of a month can be counted apart and put together.
    """
    g = Window.partitionBy(*keys)
    half = F.lit(0.5)  # percentile() counts a value n times, as F.median does rows
    by = weights.groupBy(*keys, "value", "w").agg(F.sum("n").alias("n")).withColumns({"_med": F.percentile("value", half, F.col("n")).over(g), "_all": F.sum("n").over(g)})
    by = by.withColumn("_dev", F.abs(F.col("value") - F.col("_med"))).withColumn("_scale", F.percentile("_dev", half, F.col("n")).over(g) * MAD_SCALE)
    kept = by.where((F.col("_all") < 3) | (F.col("_scale") <= TINY) | (F.col("_dev") <= k * F.col("_scale")))
    kept = kept.withColumn("_kept", F.sum("n").over(g)).where(F.col("_kept") >= least)
    run = g.orderBy("value", "w").rowsBetween(Window.unboundedPreceding, 0)
    kept = kept.withColumns({"_cw": F.sum(F.col("w") * F.col("n")).over(run), "_tw": F.sum(F.col("w") * F.col("n")).over(g)})
    weighted = F.when(F.max("_tw") > 0, F.min(F.when(F.col("_cw") >= F.col("_tw") * 0.5, F.col("value")))).otherwise(F.percentile("value", half, F.col("n")))
    return kept.groupBy(*keys).agg(weighted.alias("capacity_median"), F.sum("n").alias("capacity_count"), (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("value_mean"))
