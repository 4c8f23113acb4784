"""Profile of raw telemetry: is the reported resistance alive, which chemistry and series, which route to take.

Everything a device contributes is aggregated in few passes over one sampled, device-partitioned scan; only one-row results
reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config, Found
from ..functions.params import by_model
from ..functions.series import seconds
from ..functions.stats import nearest_quantile

SERIES = (16, 17, 20, 21, 24, 25)
FLEET_SERIES = {"LFP": (24, 25), "NMC": (20, 21)}
PLATFORM_SLOPE = 0.35


def r_stats(df: DataFrame, least: int = 30) -> DataFrame:
    """(device_id, cv, slope, r_med) of R = remaining / soc, the slope per 30.44 days over whole days since the first row."""
    used = df.where((F.col("soc") > 0.05) & (F.col("remaining_ah") > 0)).withColumn("_r", F.col("remaining_ah") / F.col("soc"))
    day = F.floor((seconds("ts") - F.min(seconds("ts")).over(Window.partitionBy("device_id"))) / 86400) / 30.44
    slope = F.coalesce(F.when(F.regr_count(F.col("_r"), F.col("_x")) >= 12, F.regr_slope("_r", "_x")), F.lit(0.0))
    d = used.withColumn("_x", day).groupBy("device_id").agg(F.count("*").alias("_n"), F.try_divide(F.stddev_pop("_r"), F.avg("_r")).alias("cv"), slope.alias("slope"), F.median("_r").alias("r_med"))
    return d.where(F.col("_n") >= least).drop("_n")


def r_summary(stats: DataFrame, cv_line: float = 0.02) -> DataFrame:
    return stats.agg(
        F.round(F.coalesce(F.median("cv"), F.lit(1.0)), 5).alias("cv_median"), F.round(F.coalesce(F.median("slope"), F.lit(0.0)), 5).alias("slope_median"),
        F.round(F.coalesce(F.avg((F.col("cv") > cv_line).cast("double")), F.lit(0.0)), 4).alias("frac_dynamic"), F.count("*").alias("devices"),
    )


def voltage_range(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max("voltage").alias("vmax"), F.min("voltage").alias("vmin"))


def platform_slope(df: DataFrame, series: float, least: int = 50) -> DataFrame:
    """(device_id, slope): volts a cell over the middle of the charge, at small currents."""
    flat = df.where(F.col("soc").between(0.2, 0.8) & (F.abs("current") < 1))
    return flat.groupBy("device_id").agg(F.when(F.regr_count(F.col("voltage"), F.col("soc")) >= least, F.regr_slope("voltage", "soc") / series).alias("slope")).where("slope IS NOT NULL")


def infer_series(vmax: Column, vmin: Column, cfg: Config, candidates: dict[str, tuple[int, ...]] | None = None) -> Column:
    """struct(err, chemistry, series) whose cell voltages lie nearest to a chemistry's; the first of equals."""
    options, k = [], 0
    for name in ("LFP", "NMC"):
        p = cfg.chem_params(name)
        for s in (candidates or {}).get(name, SERIES if candidates is None else ()):
            err = F.abs(vmax / s - p["cell_v_full"]) + F.abs(vmin / s - p["cell_v_cutoff"])
            options.append(F.struct(err.alias("err"), F.lit(k).alias("ord"), F.lit(name).alias("chemistry"), F.lit(s).alias("series")))
            k += 1
    return F.array_min(F.array(*options))


def gap_minutes(df: DataFrame) -> DataFrame:
    """One row: number of gaps of a minute or more, share under 30, and nearest quantiles."""
    w = Window.partitionBy("device_id").orderBy("ts")
    gaps = df.withColumn("_g", F.floor((seconds("ts") - F.lag(seconds("ts")).over(w)) / 60)).where("_g > 0")
    # counted by length first: the quantiles read one row a distinct gap
    counted = gaps.groupBy("_g").agg(F.count("*").alias("n"))
    a = counted.agg(F.array_sort(F.collect_list(F.struct(F.col("_g").alias("g"), "n"))).alias("a"), F.sum("n").alias("n"), F.sum(F.when(F.col("_g") < 30, F.col("n")).otherwise(0)).alias("short"))

    def at(q: float) -> Column:
        want = F.round((F.col("n") - 1) * F.lit(q)) + 1
        empty = F.struct(F.lit(0).cast("long").alias("c"), F.lit(None).cast("long").alias("g"))
        step = F.aggregate("a", empty, lambda s, x: F.when(s["g"].isNotNull(), s).otherwise(F.struct((s["c"] + x["n"]).alias("c"), F.when(s["c"] + x["n"] >= want, x["g"]).alias("g"))))
        return step["g"]

    return a.select(F.coalesce("n", F.lit(0)).alias("n"), F.try_divide(F.col("short").cast("double"), F.col("n")).alias("frac_lt_30"), at(0.05).alias("p05"), at(0.5).alias("p50"), at(0.95).alias("p95"))


def negative_loops(df: DataFrame) -> DataFrame:
    w = Window.partitionBy("device_id").orderBy("ts")
    return df.withColumn("_d", F.col("loop_count") - F.lag("loop_count").over(w)).where("_d IS NOT NULL").agg(F.coalesce(F.avg((F.col("_d") < 0).cast("double")), F.lit(0.0)).alias("frac_negative"))


def current_sign(df: DataFrame, least: int = 20, share: float = 0.8) -> DataFrame:
    """(device_id, n, median_i3, frac_negative, reversed): the mean current of three rows where the charge rises."""
    w = Window.partitionBy("device_id").orderBy("ts")
    three = w.rowsBetween(-2, 0)
    rising = df.withColumns({"_d": F.col("soc") - F.lag("soc").over(w), "_i3": F.when(F.count("current").over(three) == 3, F.avg("current").over(three))}).where("_d > 0.03 AND _i3 IS NOT NULL")
    d = rising.groupBy("device_id").agg(F.count("*").alias("n"), F.median("_i3").alias("median_i3"), F.avg((F.col("_i3") < 0).cast("double")).alias("frac_negative"))
    return d.where(F.col("n") >= least).withColumn("reversed", F.col("frac_negative") > share)


def near_zero_current(df: DataFrame, amperes: float = 1.0) -> DataFrame:
    return df.agg(F.avg((F.abs("current") < amperes).cast("double")).alias("frac_near_zero"))


def r_bins(df: DataFrame, width: float = 0.5) -> DataFrame:
    """(channel, device_id, bin, n, t0, t1): rows of each bin of R (null without a usable R) and their span; sums of them are those of all rows."""
    r = F.when((F.col("soc") > 0.05) & (F.col("remaining_ah") > 0), F.col("remaining_ah") / F.col("soc"))
    return merged_bins(df.select("channel", "device_id", (F.floor(r / width) * width).alias("bin"), F.lit(1).alias("n"), F.col("ts").alias("t0"), F.col("ts").alias("t1")))


def merged_bins(bins: DataFrame) -> DataFrame:
    return bins.groupBy("channel", "device_id", "bin").agg(F.sum("n").alias("n"), F.min("t0").alias("t0"), F.max("t1").alias("t1"))


def nominal(bins: DataFrame, width: float = 0.5) -> DataFrame:
    """(channel, device_id, c_nom_bms, n_rows, t0, t1) from bins of R: the commonest one, the lowest of equals, and the device's span."""
    used = F.col("bin").isNotNull()
    d = bins.groupBy("channel", "device_id").agg(
        (F.max_by("bin", F.when(used, F.struct(F.col("n"), -F.col("bin")))) + width / 2).alias("c_nom_bms"), F.sum(F.when(used, F.col("n"))).alias("n_rows"),
        F.min("t0").alias("t0"), F.max("t1").alias("t1"),
    )
    return d.where("c_nom_bms IS NOT NULL")


def c_nom(df: DataFrame, width: float = 0.5) -> DataFrame:
    """(channel, device_id, c_nom_bms, n_rows, t0, t1) of raw rows; one scan. Devices without a usable R don't come."""
    return nominal(r_bins(df, width), width)


def anchor_density(df: DataFrame, cfg: Config) -> DataFrame:
    """Mean number of anchor candidates over the device months that have any."""
    soc, v, i, a = F.col("soc"), F.col("voltage"), F.col("current"), cfg.get("anchor")
    hit = ((soc > a["soc_full"]) & (v > cfg.v_full() * a["v_full_ratio"])) | ((soc < a["soc_empty"]) & (v < cfg.v_cutoff() * a["v_cutoff_ratio"])) | (F.abs(i) < cfg.rest_current())
    monthly = df.where(hit).groupBy("device_id", F.date_format("ts", "yyyy-MM").alias("ym")).agg(F.count("*").alias("n"))
    return monthly.agg(F.coalesce(F.avg("n"), F.lit(0.0)).alias("density"))


def verify_models(df: DataFrame, models: DataFrame, cfg: Config) -> DataFrame:
    """(model, vmax, vmin, chemistry, series): what the voltages of each model's devices say."""
    m = voltage_range(df.join(models, "device_id"), "model")
    best = infer_series(F.col("vmax"), F.col("vmin"), cfg)
    return m.withColumn("_b", best).select("model", "vmax", "vmin", F.col("_b.chemistry").alias("chemistry"), F.col("_b.series").alias("series"))


def against_sheet(df: DataFrame, models: DataFrame, cfg: Config, least: int = 50) -> DataFrame:
    """(model, chemistry, series, slope_per_cell, sheet_chemistry, sheet_series, ok): measured in mid-charge at small currents.

    The chemistry goes by the median device's slope per declared cell, the series by the median highest and the nearest
    5 % quantile of the devices' lowest voltages. Models that the sheet lacks have no declared values and aren't ok.
    """
    flat = df.where(F.col("soc").between(0.2, 0.8) & (F.abs("current") < 1)).join(models.select("device_id", "model"), "device_id")
    y, x = F.col("voltage"), F.col("soc")
    d = flat.groupBy("model", "device_id").agg(F.max("voltage").alias("vmax"), F.min("voltage").alias("vmin"), F.when(F.count("*") >= least, F.regr_slope(y, x)).alias("slope"))
    m = d.groupBy("model").agg(F.median("vmax").alias("vmax"), nearest_quantile(F.col("vmin"), 0.05).alias("vmin"), F.coalesce(F.median("slope"), F.lit(0.0)).alias("slope"))
    own = {k: by_model(m, cfg, lambda p, k=k: getattr(p, k), None) for k in ("chemistry", "series")}
    m = m.withColumns({"sheet_chemistry": own["chemistry"].cast("string"), "sheet_series": own["series"].cast("int")})
    per_cell = F.col("slope") / F.coalesce(F.col("sheet_series"), F.lit(1))
    m = m.withColumns({"slope_per_cell": F.round(per_cell, 4), "chemistry": F.when(per_cell < PLATFORM_SLOPE, "LFP").otherwise("NMC")})
    of = {name: infer_series(F.col("vmax"), F.col("vmin"), cfg, {name: SERIES})["series"] for name in FLEET_SERIES}
    m = m.withColumn("series", F.when(F.col("chemistry") == "LFP", of["LFP"]).otherwise(of["NMC"]))
    ok = F.coalesce((F.col("chemistry") == F.col("sheet_chemistry")) & (F.col("series") == F.col("sheet_series")), F.lit(False))
    return m.select("model", "chemistry", "series", "slope_per_cell", "sheet_chemistry", "sheet_series", ok.alias("ok"))


def reversed_devices(df: DataFrame) -> DataFrame:
    """(device_id): devices whose current has the wrong sign."""
    return current_sign(df).where("reversed").select("device_id")


def use_time_window(df: DataFrame, cfg: Config) -> bool:
    """Whether loop counts fall back so often that months must be grouped by time alone."""
    return negative_loops(df).first()["frac_negative"] > cfg.get("selfcheck.neg_loopnum_frac")


#: Under so many devices with enough rows a conclusion of the profile is unsure.
LEAST_DEVICES = 3


def decide(df: DataFrame, cfg: Config, least: int = LEAST_DEVICES) -> Found:
    """The one-row conclusions that later steps need; ``reversed_devices`` is a table of its own.

    A conclusion that fewer than ``least`` devices with enough rows speak for is named in ``unsure``: the mode of R, chemistry
    and series, the route, and whether the current is missing. ``df`` is read several times, so it should be a table.
    """
    r = r_summary(r_stats(df)).first()
    dynamic = r["cv_median"] >= cfg.get("selfcheck.r_cv_dynamic") or abs(r["slope_median"]) > cfg.get("selfcheck.r_slope_eps")
    ranges = voltage_range(df, "device_id").agg(F.median("vmax").alias("vmax"), nearest_quantile(F.col("vmin"), 0.05).alias("vmin"), F.count("vmax").alias("n")).first()
    slope = platform_slope(df, 1.0).agg(F.median("slope").alias("s"), F.count("*").alias("n")).first()
    chemistry, series = cfg.found.chemistry, cfg.found.series
    told = chemistry is not None
    if ranges["vmax"] is not None and chemistry is None:
        at = (ranges["vmax"], ranges["vmin"])
        chemistry = "LFP" if (slope["s"] or 0.0) / nearest_series(*at, cfg, FLEET_SERIES) < PLATFORM_SLOPE else "NMC"
        series = nearest_series(*at, cfg, {chemistry: FLEET_SERIES[chemistry]})
    density = anchor_density(df, cfg).first()["density"]
    route = "ABSOLUTE" if dynamic or density >= cfg.get("selfcheck.min_anchor_per_month") else "L2_TREND"
    zero = near_zero_current(df, cfg.get("anchor.current_near_zero_a")).first()["frac_near_zero"]
    missing = (zero or 0.0) > cfg.get("anchor.current_zero_frac_limit")
    p = cfg.chem_params(chemistry)
    unsure = [name for name, bad in (("r_mode", r["devices"] < least), ("chemistry", not told and min(slope["n"], ranges["n"]) < least), ("route", r["devices"] < least and density == 0.0), ("current_effectively_missing", zero is None)) if bad]
    return Found(chemistry, series, "DYNAMIC" if dynamic else "CONSTANT", route, p["v_full"], p["v_cutoff"], cfg.found.reversed_devices, missing, use_time_window(df, cfg), tuple(unsure))


def nearest_series(vmax: float, vmin: float, cfg: Config, candidates: dict[str, tuple[int, ...]]) -> int:
    """``infer_series`` of one pair of numbers."""
    options = [(abs(vmax / s - p["cell_v_full"]) + abs(vmin / s - p["cell_v_cutoff"]), k, s) for k, (name, of) in enumerate((n, o) for n, o in candidates.items()) for p in [cfg.chem_params(name)] for s in of]
    return min(options, key=lambda x: x[:2])[2]
