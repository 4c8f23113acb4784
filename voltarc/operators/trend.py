"""Trends: exclusions, decay, alerts, dashboards and consistency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions.series import month_index, seconds
from ..functions.stats import divided, guarded_corr, half_up, nearest_quantile, ols_r2, ols_slope

KEYS = ["channel", "device_id"]


def exclusions(soh: DataFrame, low: float = 0.90) -> DataFrame:
    """Devices all of whose months, two or more, are below ``low``: probably old cells under a new id."""
    second = F.get(F.array_sort(F.collect_list(F.struct("ym", "soh"))), F.lit(1))["soh"]
    d = soh.groupBy(*KEYS).agg(
        F.min_by("model", "ym").alias("model"), F.count("*").alias("reliable_months"), F.max("soh").alias("_max"), F.min_by("soh", "ym").alias("soh_first_reliable"),
        second.alias("soh_second_reliable"), F.try_divide(F.max("capacity_median") - F.min("capacity_median"), F.min_by("capacity_median", "ym")).alias("spread_ratio"),
        F.min_by("loop_median", "ym").alias("loop_first"), F.min("ym").alias("ym_first"), F.max("ym").alias("ym_last"),
    )
    return d.where((F.col("reliable_months") >= 2) & (F.col("_max") < low)).drop("_max").withColumn("reasons", F.lit("bms_swap"))


def without(df: DataFrame, gone: DataFrame) -> DataFrame:
    """Null-safe anti join on the device key."""
    g = gone.select(*[F.col(c).alias(f"_{c}") for c in KEYS]).distinct()
    return df.join(g, [df[c].eqNullSafe(g[f"_{c}"]) for c in KEYS], "left_anti")


def decay(soh: DataFrame) -> DataFrame:
    """(channel, device_id, decay_rate_pct_month, r_squared, decay_rate_pct_year) by least squares over month indexes."""
    y, x = F.col("soh"), month_index("ym").cast("double")
    d = soh.groupBy(*KEYS).agg((F.round(ols_slope(y, x, 3) * 100, 4)).alias("decay_rate_pct_month"), F.when(F.regr_count(y, x) >= 3, half_up(ols_r2(y, x, F.lit(None).cast("double")), 4)).alias("r_squared"))
    return d.withColumn("decay_rate_pct_year", F.col("decay_rate_pct_month") * 12)


def analysis(soh: DataFrame, cfg: Config) -> DataFrame:
    """The months of devices that aren't excluded, with their decay: windows over one exchange, no table is read twice.

    A device without a key is excluded as any other is, and has no decay, as a join on its key would give none.
    """
    g = Window.partitionBy(*KEYS)
    timed = g.orderBy("ym").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # sums of doubles in one order, in every run
    y, x = F.col("soh"), month_index("ym").cast("double")
    r2 = ols_r2(y, x, F.lit(None).cast("double"), timed)
    df = soh.withColumns({"_n": F.count("*").over(g), "_max": F.max("soh").over(g), "_c": F.regr_count(y, x).over(timed), "_r2": r2, "_m": F.regr_slope(y, x).over(timed)})
    df = df.where(~((F.col("_n") >= 2) & (F.col("_max") < cfg.get("exclude.soh_low_ratio"))) | F.col("_max").isNull())
    known = (F.col("_c") >= 3) & F.col(KEYS[0]).isNotNull() & F.col(KEYS[1]).isNotNull()
    df = df.withColumns({"decay_rate_pct_month": F.when(known, F.round(F.col("_m") * 100, 4)), "r_squared": F.when(known, half_up(F.col("_r2"), 4))})
    return df.withColumn("decay_rate_pct_year", F.col("decay_rate_pct_month") * 12).drop("_n", "_max", "_c", "_r2", "_m")


def drop_alerts(table: DataFrame, drop: float = 0.05) -> DataFrame:
    """Months whose state of health fell by more than ``drop`` since the device's month before."""
    w = Window.partitionBy(*KEYS).orderBy("ym")
    fell = table.withColumn("_d", F.col("soh") - F.lag("soh").over(w)).where(F.col("_d") < -drop)
    text = F.concat("ym", F.lit(" 跌幅 "), F.format_string("%s", F.round(F.col("_d") * 100, 2)), F.lit("%/月"))
    return fell.select(*KEYS, F.lit("SOH月跌幅异常").alias("alert_type"), text.alias("alert_detail"), F.lit(None).cast("string").alias("detected_at"))


def anchor_rates(scored: DataFrame, *keys: str) -> DataFrame:
    return scored.groupBy(*keys).agg(F.count("*").alias("anchor_total"), F.count_if(F.col("cap_tier") == 1).alias("tier1_count")).withColumn("anchor_rate", F.col("tier1_count") / F.col("anchor_total"))


def rate_alerts(scored: DataFrame, least: float = 0.20) -> DataFrame:
    """Devices whose share of tier-1 anchors is below ``least``."""
    low = anchor_rates(scored, *KEYS).where(F.col("anchor_rate") < least)
    text = F.concat(F.lit("有效锚点率 "), F.format_string("%s", F.round(F.col("anchor_rate") * 100, 1)), F.lit(f"% < {least:.0%}"))
    return low.select(*KEYS, F.lit("数据质量差").alias("alert_type"), text.alias("alert_detail"), F.lit(None).cast("string").alias("detected_at"))


def alerts(table: DataFrame, scored: DataFrame, cfg: Config) -> DataFrame:
    return drop_alerts(table, cfg.get("soh.monthly_drop_alert")).unionByName(rate_alerts(scored, cfg.get("monitoring.device_anchor_rate_min")))


def worst_drop(rates: DataFrame, key: str, order: str, rate: str) -> DataFrame:
    """(key, worst_mom_drop): the largest fall between neighbouring periods, null if there is none."""
    w = Window.partitionBy(key).orderBy(order)
    return rates.withColumn("_d", F.col(rate) - F.lag(rate).over(w)).where("_d < 0").groupBy(key).agg(F.min("_d").alias("worst_mom_drop"))


def dashboard(scored: DataFrame, table: DataFrame) -> DataFrame:
    """One row a channel."""
    total = anchor_rates(scored, "channel").withColumn("tier1_count", F.nullif("tier1_count", F.lit(0)))
    devices = table.select(*KEYS, "decay_rate_pct_year").distinct().groupBy("channel").agg(F.median("decay_rate_pct_year").alias("median_decay_pct_year"), F.countDistinct("device_id").alias("device_count"))
    monthly = anchor_rates(scored.withColumn("ym", F.date_format("ts", "yyyy-MM")), "channel", "ym")
    return total.join(devices, "channel", "left").join(worst_drop(monthly, "channel", "ym", "anchor_rate"), "channel", "left")


def consistency(table: DataFrame, least_months: int = 4, lagging_below: float = 0.3) -> DataFrame:
    """(channel, device_id, corr_with_group, lagging): each device's months against its channel's mean curve."""
    curve = table.groupBy("channel", "ym").agg(F.avg("soh").alias("_mean"))  # partial sums: a month of a channel isn't one task's
    mean = table.join(curve, ["channel", "ym"])
    months = table.groupBy("channel").agg(F.countDistinct("ym").alias("_months")).where(F.col("_months") >= least_months)
    r = mean.join(months, "channel", "left_semi").groupBy(*KEYS).agg(guarded_corr(F.col("soh"), F.col("_mean"), 4).alias("_r"))
    return r.select(*KEYS, F.round("_r", 4).alias("corr_with_group"), F.coalesce(F.col("_r") < lagging_below, F.lit(False)).alias("lagging"))


def full_vs_empty(scored: DataFrame, least: int = 3, tolerance: float = 0.05) -> DataFrame:
    """Per device the median capacity at full and at empty anchors; verdict over all devices that have both, if enough.

    Over an empty median of zero the ratio is infinite, or NaN if the full one is zero as well; both are full_high.
    """
    full = F.median(F.when(F.col("anchor_type").isin("FULL_END", "SWAP_FULL"), F.col("capacity_corrected")))
    empty = F.median(F.when(F.col("anchor_type") == "EMPTY_END", F.col("capacity_corrected")))
    d = scored.groupBy("device_id").agg(full.alias("full_median"), empty.alias("empty_median")).where("full_median IS NOT NULL AND empty_median IS NOT NULL")
    d = d.withColumn("ratio", divided(F.col("full_median"), F.col("empty_median")) - 1)
    n = d.agg(F.count("*").alias("_n"))
    verdict = F.when(F.abs("ratio") < tolerance, "ok").when(F.col("ratio") > 0, "full_high").otherwise("empty_high")
    return d.crossJoin(F.broadcast(n)).where(F.col("_n") >= least).drop("_n").withColumn("verdict", verdict)  # one row is broadcast


def r_drift(scored: DataFrame, least: int = 4) -> DataFrame:
    """(device_id, slope): raw capacity per 30.44 days since the device's first anchor; NaN if all its anchors lie within a day."""
    day = F.floor((seconds("ts") - F.min(seconds("ts")).over(Window.partitionBy("device_id"))) / 86400) / 30.44
    y, x = F.col("capacity_raw"), F.col("_x")
    return scored.withColumn("_x", day).groupBy("device_id").agg(F.when(F.regr_count(y, x) >= least, F.coalesce(ols_slope(y, x, least), F.lit(float("nan")))).alias("slope")).where("slope IS NOT NULL")


def r_drift_verdict(drift: DataFrame) -> DataFrame:
    share = F.avg((F.col("slope") >= 0).cast("double"))
    return drift.agg(F.count("*").alias("devices"), share.alias("nonneg_share"), F.when(share > 0.7, "absolute_untrusted").otherwise("ok").alias("verdict"))


def quantiles(c: Column, *qs: float) -> list[Column]:
    return [nearest_quantile(c, q) for q in qs]
