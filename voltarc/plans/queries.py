"""The engine's operators over the driver's tables, each with the SQL that says what it must give.

``events`` stand in for telemetry (users are devices; charge, voltage and current come from the event number) and orders by
customer and month for the monthly layer, so that the same stage functions run here as on telemetry.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config, Found, ModelParams, load_config, ocv_curve
from ..functions import series, stats
from ..operators import anchor, capacity, charts, clean, cohort, monthly, profile, quality, retirement, soh, state, trend, validation
from ..session import settle, settled_path
from ..sources import layout, telemetry
from ..streaming import late

Query = Callable[[SparkSession, str], DataFrame]

TELEMETRY_COLUMNS = {
    "event_id": "event_id", "device_id": "user_id", "channel": "concat('c', cast(user_id % 5 as {text}))", "ts": "ts", "loop_count": "cast(event_id // 100 as double)",
    "soc": "((event_id * 37) % 101) / {hundred}", "voltage": "60 + ((event_id * 53) % 330) / {ten}",
    "current": "CASE WHEN event_id % 3 = 0 THEN cast((event_id * 29) % 61 - 30 as double) ELSE ((event_id * 29) % 7 - 3) / {ten} END",
    "temperature": "cast((event_id * 17) % 60 - 5 as double)", "remaining_ah": "((event_id * 37) % 101) / {hundred} * (36 + user_id % 5) + ((event_id * 11) % 20) / {ten}",
}
CONFIG: Config = load_config(found=Found("NMC", 21, "DYNAMIC", "ABSOLUTE", 88.2, 63.0, (7, 9)))
#: The same with sheets of two models and of a market segment.
SHEETS: Config = load_config(found=CONFIG.found, models={
    "m0": ModelParams("m0", "LFP", 24, 40.0, 87.6, 62.4, 3.65), "m2": ModelParams("m2", "NMC", 21, 36.5, 88.2, 63.0, 4.2), "BUILDING": ModelParams("BUILDING", "LFP", 24, 40.0, 87.6, 62.4, 3.65),
})
TODAY = 2001 * 12 + 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _columns(spark: bool) -> list[str]:
    out = []
    for name, text in TELEMETRY_COLUMNS.items():
        text = text.format(text="string" if spark else "varchar", hundred="100D" if spark else "100.0::DOUBLE", ten="10D" if spark else "10.0::DOUBLE")
        out.append((text.replace("event_id // 100", "event_id div 100") if spark else text) + f" AS {name}")
    return out


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*_columns(True))


def months(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    o = o.groupBy("c_nationkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("ym")).agg(
        (F.sum(F.round(F.col("o_totalprice") * 100).cast("long")) / 900000.0).alias("capacity_median"), F.count("*").alias("capacity_count")
    )
    mi = series.month_index("ym")
    return o.select(
        F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("channel"), F.col("o_custkey").alias("device_id"), "ym", "capacity_median", "capacity_count",
        (((mi - 23940) * 10 + F.col("o_custkey") % 10).cast("double")).alias("loop_median"), (((mi - 23940) * 10 + 5 + F.col("o_custkey") % 10).cast("double")).alias("loop_max"),
        F.concat(F.lit("m"), (F.col("o_custkey") % 4).cast("string")).alias("model"),
    )


def nine_digits(c: Column) -> Column:
    """Rounded as the SQL's round() does: of the product with 1e9, ties away from zero; too large, infinite or NaN as it is."""
    m = c * 1e9
    return F.when(F.abs(m) < float(1 << 52), F.signum(m) * F.floor(F.abs(m) + 0.5) / 1e9).otherwise(c)


def rounded(df: DataFrame, *keep: str) -> DataFrame:
    """The named columns (all if none), doubles rounded to nine digits, no negative zeros: what two engines agree on."""
    names = keep or tuple(df.columns)
    kinds = dict(df.dtypes)
    return df.select(*[(nine_digits(F.col(c)) + 0.0).alias(c) if kinds[c] == "double" else F.col(c) for c in names])


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = clean.run(rows(spark, sf_dir), CONFIG)
    nominal = profile.c_nom(df).select("channel", "device_id", "c_nom_bms")
    return quality.run(capacity.run(anchor.run(df, CONFIG), nominal, CONFIG), CONFIG)


def smoothed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return soh.run(months(spark, sf_dir), CONFIG)


def analysed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trend.analysis(smoothed(spark, sf_dir), CONFIG)


def settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The analysed months as a table, for queries that read them more than once."""
    return settle(analysed(spark, sf_dir), "analysed")


def forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retirement.forecast(analysed(spark, sf_dir), CONFIG)


def plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    table_ = settled(spark, sf_dir)
    months_ = settle(cohort.retire_months(retirement.forecast(table_, CONFIG), table_), "retire-months")
    return cohort.schedule(months_, TODAY)


def monthly_weighted_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A15 to A18 on events: each user's month without its outliers, and its weighted median."""
    weight = F.when(F.col("event_type") == "purchase", 1.0).when(F.col("event_type").isin("signup", "error"), 0.75).otherwise(0.5)
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("device_id"), F.date_format("ts", "yyyy-MM").alias("ym"), "value", "event_id", weight.alias("w"))
    keys = ["device_id", "ym"]
    kept = monthly.median_by_weight(monthly.masked(e, keys, "value", 3.0, 3), keys, "value", "w", ["event_id"])
    return rounded(kept.groupBy(*keys).agg(monthly.weighted_median_of("value").alias("capacity_median"), F.count("*").alias("capacity_count"), F.avg("value").alias("value_mean")))


def monthly_from_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A15 to A18, D1 from weights by value of each day, as a stream leaves them: the same months as from the rows."""
    weight = F.when(F.col("event_type") == "purchase", 1.0).when(F.col("event_type").isin("signup", "error"), 0.75).otherwise(0.5)
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("device_id"), "ts", "value", "event_id", weight.alias("w"))
    twice = e.unionByName(e.where("event_id % 10 = 0"))  # some rows are delivered again
    return rounded(monthly.from_weights(late.daily_weights(twice, "value", "w", key=("device_id", "event_id"))))


def weighted_median_by_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    df = li.join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return rounded(stats.weighted_median(df, ["p_brand"], "l_extendedprice", "l_quantity", "price"))


def gap_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.gap_flag(rows(spark, sf_dir), "device_id", "ts", 6.0).select("event_id", "time_gap")


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(clean.run(rows(spark, sf_dir), CONFIG), *CLEANED)


CLEANED = ("event_id", "loop_count", "voltage", "temperature", "current", "invalid_loopnum", "invalid_sensor", "current_reversed", "current_sensor_drift", "time_gap")


def cleaned_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5 and P6 on rows with missing times and sensors and with text for numbers; turned devices come as a table."""
    e, k = rows(spark, sf_dir), F.col("event_id")
    e = e.withColumns({
        "ts": F.when(k % 13 > 0, F.col("ts")), "voltage": F.when(k % 11 > 0, F.col("voltage")), "temperature": F.when(k % 17 > 0, F.col("temperature").cast("string")).otherwise("n/a"),
        "current": F.when(k % 7 > 0, F.col("current")).when(k % 2 == 0, F.lit(float("nan"))), "loop_count": F.when(k % 19 > 0, F.col("loop_count").cast("string")).otherwise("?"),
    })
    turned = spark.createDataFrame([(3,), (5,), (5,)], "device_id bigint")
    return rounded(clean.run(e, CONFIG, turned), *CLEANED)


def rest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = clean.run(rows(spark, sf_dir), CONFIG)
    return series.rest_runs(df, "device_id", "ts", F.abs("current") < CONFIG.rest_current(), 21600, 7200).select("event_id", "is_rest", "rest_s", "run_end")


def anchor_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = anchor.run(clean.run(rows(spark, sf_dir), CONFIG), CONFIG)
    return rounded(df.withColumn("flags", F.array_join("flags", ",")), "event_id", "anchor_type", "soc_anchor", "flags")


def capacity_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scored(spark, sf_dir), "event_id", "c_nom_bms", "capacity_raw", "capacity_corrected", "out_of_range", "temp_out", "v_inconsistent")


def score_tier_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scored(spark, sf_dir), "event_id", "f_out_of_range", "f_voltage_inconsistent", "f_temp_out", "f_anchor_conflict", "f_sensor_drift", "f_contradiction", "severe", "quality_score", "cap_tier", "stat_weight")


def plot_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(capacity.plot_points(scored(spark, sf_dir)), "channel", "device_id", "anchor_type", "cap_tier", "soh_point")


def monthly_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(monthly.aggregate(scored(spark, sf_dir)))


def mode_bin(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "value")
    return stats.binned_mode(e, ["user_id"], F.col("value"), 0.5)


def r_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.r_stats(rows(spark, sf_dir)))


def gap_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.gap_minutes(rows(spark, sf_dir)))


def sign_and_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.current_sign(rows(spark, sf_dir), 5))


def profile_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = rows(spark, sf_dir)
    parts = [profile.negative_loops(df), profile.near_zero_current(df), profile.anchor_density(df, CONFIG), profile.r_summary(profile.r_stats(df))]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(p)  # one row each
    return rounded(out)


def nominal_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.c_nom(rows(spark, sf_dir)), "channel", "device_id", "c_nom_bms", "n_rows")


def platform_slopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.platform_slope(rows(spark, sf_dir), 21.0, 10))


def series_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("device_id"), F.col("c_mktsegment").alias("model"))
    return rounded(profile.verify_models(rows(spark, sf_dir), models, CONFIG))


def model_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C20: measured chemistry and series of each model against its sheet."""
    models = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("device_id"), F.col("c_mktsegment").alias("model"))
    return rounded(profile.against_sheet(rows(spark, sf_dir), models, SHEETS, 3))


def rolling_mad(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = series.rolling_mad(months(spark, sf_dir), soh.KEYS, "ym", "capacity_median", 7, 3.0)
    return rounded(df, "device_id", "ym", "is_spike", "cleaned")


def pava_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(series.pava_series(months(spark, sf_dir), soh.KEYS, "ym", "capacity_median", "capacity_count", "fitted"), "device_id", "ym", "fitted")


def leading_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(series.leading_trim(months(spark, sf_dir), soh.KEYS, "ym", F.col("capacity_median") / 37.0, 0.90), "device_id", "ym", "capacity_median")


def soh_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(smoothed(spark, sf_dir), "channel", "device_id", "ym", "capacity_smoothed", "soh", "soh_raw", "is_spike", "c_nom_soh")


def excluded_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(trend.exclusions(smoothed(spark, sf_dir), 0.90))


def ols_decay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(analysed(spark, sf_dir).select("channel", "device_id", "decay_rate_pct_month", "r_squared", "decay_rate_pct_year").distinct())


def soh_drop_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trend.drop_alerts(analysed(spark, sf_dir), 0.05)


def anchor_rate_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trend.rate_alerts(scored(spark, sf_dir), 0.20)


def channel_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = analysed(spark, sf_dir).withColumn("channel", F.concat(F.lit("c"), (F.col("device_id") % 5).cast("string")))
    return rounded(trend.dashboard(scored(spark, sf_dir), t))


def group_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trend.consistency(smoothed(spark, sf_dir))


def full_vs_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(trend.full_vs_empty(scored(spark, sf_dir)))


def r_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(trend.r_drift(scored(spark, sf_dir)))


def retire_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(forecast(spark, sf_dir))


def cohort_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cohort.by_month(analysed(spark, sf_dir)))


def cohort_decay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cohort.decay_stats(settled(spark, sf_dir)))


def cohort_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cohort.by_age(analysed(spark, sf_dir)))


def cohort_loops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cohort.by_loops(analysed(spark, sf_dir)))


def cohort_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = settled(spark, sf_dir)
    return rounded(cohort.by_stage(t, retirement.forecast(t, CONFIG)).withColumn("stage_order", cohort.stage_order(F.col("health_level"))))


def fleet_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cohort.fleet(analysed(spark, sf_dir)))


def retire_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan(spark, sf_dir)


def schedule_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.by_quarter(plan(spark, sf_dir))


def schedule_milestones(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = settle(plan(spark, sf_dir), "plan")
    return cohort.peak_month(p).join(cohort.half_way(p), "model")


def retire_outside(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = settled(spark, sf_dir)
    return cohort.outside(cohort.retire_months(retirement.forecast(t, CONFIG), t), TODAY)


def level_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Devices of each channel at each health level."""
    return cohort.level_counts(forecast(spark, sf_dir))


def kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The figures at a report's head."""
    t = settled(spark, sf_dir)
    months_ = cohort.retire_months(retirement.forecast(t, CONFIG), t)
    return rounded(cohort.kpis(cohort.schedule(settle(months_, "retire-months"), TODAY), cohort.fleet(t), TODAY))


def drift_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether absolute capacities can be trusted."""
    return rounded(trend.r_drift_verdict(trend.r_drift(scored(spark, sf_dir))))


def loop_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each model's loop curve meets the hundreds."""
    return rounded(cohort.loop_axis(cohort.by_month(analysed(spark, sf_dir)), "ym"))


def model_crossing_80(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Age and loops at which a model's median state of health meets the line, here 0.97 of it."""
    return rounded(cohort.crossing_80(settle(cohort.by_age(analysed(spark, sf_dir)), "ages"), "age_month", 0.97))


def age_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values beside every second month of age."""
    return rounded(cohort.ticks(settle(cohort.by_age(analysed(spark, sf_dir)), "ages"), "age_month", 0, 2, ("loop_p25", "loop_p75", "birth_p25", "birth_p75")))


def loop_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values beside every fifty loops."""
    return rounded(cohort.ticks(settle(cohort.by_loops(analysed(spark, sf_dir)), "bins"), "loop_from", 50, 50, ("age_p25", "age_p75", "birth_p25", "birth_p75")))


def model_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model in words."""
    return cohort.described(months(spark, sf_dir).select("model").distinct(), SHEETS)


def loop_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.loop_cap(cohort.by_loops(analysed(spark, sf_dir)), least=100)


def crossing_80(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = months(spark, sf_dir).withColumns({"x": (series.month_index("ym") - 23940).cast("double"), "y": F.col("capacity_median") / 37.0})
    return rounded(series.crossing(m, ["device_id"], "x", "y", 0.80))


def worst_mom_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").groupBy("o_orderpriority", F.date_format("o_orderdate", "yyyy-MM").alias("ym")).agg(F.avg((F.col("o_orderstatus") == "F").cast("double")).alias("rate"))
    return rounded(trend.worst_drop(o, "o_orderpriority", "ym", "rate"))


def null_safe_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' months without those of two groups of devices, one of which has no channel."""
    m = months(spark, sf_dir).withColumn("channel", F.when(F.col("device_id") % 3 > 0, F.col("channel")))
    gone = m.where("device_id % 7 = 0").select("channel", "device_id").distinct()
    return rounded(trend.without(m, gone).groupBy("channel").agg(F.count("*").alias("n"), F.sum("capacity_count").alias("orders")))


def row_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return rounded(validation.row_checks(li, ["l_quantity", "l_discount"], {"discount_out": ~F.col("l_discount").between(0.01, 0.09), "price_low": F.col("l_extendedprice") <= 1000, "quantity_out": ~F.col("l_quantity").between(2, 49)}))


def ocv_interp(spark: SparkSession, sf_dir: str) -> DataFrame:
    axis, volts = ocv_curve("NMC")
    e = table(spark, sf_dir, "events")
    return rounded(e.select("event_id", stats.interpolated(3.0 + F.col("value") / 250.0, volts, axis).alias("soc")))


def sample_mod(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.sampled(table(spark, sf_dir, "customer"), 25, "c_custkey").select("c_custkey", "c_name")


def bucket_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each bucket that raw rows are written to."""
    devices = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("device_id"))
    return telemetry.with_bucket(devices).groupBy("bucket").agg(F.count("*").alias("n"))


def dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 on a key with many rows: the first row of each user and event type."""
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value")
    return telemetry.dedup(e, ["user_id", "event_type"])


def bucketed(df: DataFrame, key: str, order: tuple[str, ...], by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` as a bucketed table in the shared folder, for queries that read it more than once or want nothing shuffled."""
    return layout.write_bucketed(df, settled_path(df.sparkSession, "bucketed"), key, order, 8, by)


def bucketed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in buckets of their users, deduplicated as they lie; a window without an exchange."""
    e = bucketed(table(spark, sf_dir, "events"), "user_id", ("event_type", "event_id"))
    return telemetry.dedup(e.select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"])


def bucketed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned rest rows of the users that are customers, from two bucketed tables; neither side is shuffled."""
    e = bucketed(rows(spark, sf_dir), "device_id", ("ts",))
    known = bucketed(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("device_id"), F.col("c_nationkey").alias("nation")), "device_id", ())
    runs = series.rest_runs(clean.run(e, CONFIG), "device_id", "ts", F.abs("current") < CONFIG.rest_current(), 21600, 7200)
    return runs.join(known.hint("merge"), "device_id").groupBy("device_id", "nation").agg(F.count("*").alias("n"), F.count_if("is_rest").alias("resting"), F.sum("rest_s").alias("rest_s"), F.count_if("run_end").alias("ends"))


def device_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of one user in a hundred, told to the scan of a bucketed table with Bloom filters and page bounds."""
    e = bucketed(table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd")), "user_id", ("ts",), ("day",))
    users = table(spark, sf_dir, "customer").where("c_custkey % 100 = 7").select(F.col("c_custkey").alias("user_id"))
    return layout.of_keys(e, users, "user_id").select("user_id", "event_id", "event_type", "value", "day")


def mixed_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry written in two schemas, one of them with text for numbers and times, read as one table."""
    e, path = rows(spark, sf_dir), settled_path(spark, "mixed")
    told = e.withColumns({c: F.col(c).cast("string") for c in ("voltage", "current", "ts", "loop_count")}).drop("temperature")
    e.where("event_id % 3 > 0").write.parquet(f"{path}/first")
    told.where("event_id % 3 = 0").write.parquet(f"{path}/second")
    df = telemetry.read_mixed(spark, path)
    return rounded(df.groupBy("device_id").agg(F.count("*").alias("n"), F.sum("voltage").alias("voltage"), F.sum("current").alias("current"), F.count("temperature").alias("temperatures"), F.max(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("last"), F.max("loop_count").alias("loops")))


def chart_scales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The axes of each model's page, over its devices' months."""
    m = months(spark, sf_dir).withColumn("mi", series.month_index("ym"))
    return rounded(charts.scales(m, ["model"], ["mi", "capacity_median", "loop_max"]))


def chart_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each device's curve with at most 14 points, which hold its ends and its extremes."""
    m = months(spark, sf_dir)
    c = charts.curves(m, ["channel", "device_id"], series.month_index("ym"), F.col("capacity_median"), 14)
    ys, first, last = F.transform("points", lambda p: p["y"]), F.element_at("points", 1), F.element_at("points", -1)
    return rounded(c.select("channel", "device_id", "n", (F.col("shown") <= F.least("n", F.lit(14))).alias("bounded"), F.array_max(ys).alias("highest"), F.array_min(ys).alias("lowest"), first["x"].alias("x0"), first["y"].alias("y0"), last["x"].alias("x1"), last["y"].alias("y1")))


#: Where the events are cut in two, and in three.
CUT, SECOND_CUT = "2024-01-12 09:30:00", "2024-01-20 00:00:00"


def incremental_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors of the last events from the state of the devices after two earlier spans, equal to those of a run over all."""
    e = bucketed(rows(spark, sf_dir), "device_id", ("ts",))
    old, middle, new = e.where(F.col("ts") < CUT), e.where((F.col("ts") >= CUT) & (F.col("ts") < SECOND_CUT)), e.where(F.col("ts") >= SECOND_CUT)
    first = settle(state.after(old, CONFIG), "devices")
    known = settle(state.after(middle, CONFIG, state=first), "devices")
    bins = settle(profile.merged_bins(profile.r_bins(old).unionByName(profile.r_bins(middle))), "bins")
    nominal = profile.nominal(profile.merged_bins(bins.unionByName(profile.r_bins(new)))).select("channel", "device_id", "c_nom_bms")
    found = capacity.run(anchor.run(clean.run(new, CONFIG, state=known), CONFIG), nominal, CONFIG)
    return rounded(found.withColumn("flags", F.array_join("flags", ",")), "event_id", "anchor_type", "soc_anchor", "flags", "c_nom_bms", "capacity_corrected")


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry of five devices, a row every ten minutes: enough for the engine's own thresholds."""
    return rows(spark, sf_dir).withColumns({"device_id": F.col("device_id") % 5, "ts": F.timestamp_seconds(F.col("event_id") * 600)})


def sign_of_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 with the engine's own least number of rises."""
    return rounded(profile.current_sign(dense(spark, sf_dir)))


def slopes_of_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 with the engine's own least number of rows."""
    return rounded(profile.platform_slope(dense(spark, sf_dir), 21.0))


def default_loop_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A40 with the engine's own shortest axis."""
    return cohort.loop_cap(cohort.by_loops(analysed(spark, sf_dir)))


def default_crossing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4 with the engine's own line, for curves worn by a further 18 %."""
    worn = cohort.by_age(analysed(spark, sf_dir)).withColumn("soh_median", F.col("soh_median") * 0.82)
    return rounded(cohort.crossing_80(settle(worn, "ages"), "age_month"))


def nominal_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nominal capacity and the span of a device's rows, from one scan."""
    return profile.c_nom(rows(spark, sf_dir)).select("channel", "device_id", "c_nom_bms", "t0", "t1")


def anchors_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors and capacities with the sheets of two models; a third of the devices take their model's median capacity."""
    df = clean.run(rows(spark, sf_dir).withColumn("model", F.concat(F.lit("m"), (F.col("device_id") % 4).cast("string"))), SHEETS)
    nominal = profile.c_nom(df).where("device_id % 3 > 0").select("channel", "device_id", "c_nom_bms")
    found = capacity.run(anchor.run(df, SHEETS), nominal, SHEETS)
    return rounded(found, "event_id", "model", "anchor_type", "soc_anchor", "c_nom_bms", "capacity_raw", "capacity_corrected", "out_of_range", "v_inconsistent")


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    monthly_weighted_median, weighted_median_by_brand, gap_flags, cleaned, rest_runs, anchor_classify, capacity_points, score_tier_weight, plot_points, monthly_capacity,
    mode_bin, r_statistics, gap_quantiles, sign_and_zero, profile_figures, nominal_capacity, platform_slopes, series_inference, rolling_mad, pava_monthly, leading_trim, soh_series,
    excluded_devices, ols_decay, soh_drop_alerts, anchor_rate_alerts, channel_dashboard, group_consistency, full_vs_empty, r_drift, retire_forecast, cohort_months, cohort_decay,
    cohort_age, cohort_loops, cohort_stages, fleet_figures, retire_schedule, schedule_quarters, schedule_milestones, retire_outside, loop_caps, crossing_80, worst_mom_drop,
    null_safe_exclusion, row_checks, ocv_interp, sample_mod, bucket_counts, dedup_events, cleaned_nulls, model_check, level_counts, kpis, drift_verdict, loop_axis, model_crossing_80,
    age_ticks, loop_ticks, model_descriptions, bucketed_dedup, bucketed_runs, device_rows, incremental_anchors, monthly_from_weights, mixed_schemas, chart_scales, chart_curves,
    sign_of_dense, slopes_of_dense, default_loop_caps, default_crossing, nominal_span, anchors_by_model,
)}
