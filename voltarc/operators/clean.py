"""Cleaning: types, current sign and zero, gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions.series import gap_flag


def signed(df: DataFrame, cfg: Config, turned: DataFrame | None = None) -> DataFrame:
    """Rows with a time, typed, with invalid_loopnum, invalid_sensor, current_reversed and _i, the current with its right sign.

    Devices with the wrong sign are those of ``turned`` (device_id), which Spark may broadcast if it is small, and the few of
    the settings.
    """
    reversed_ = F.col("device_id").isin([int(d) for d in cfg.found.reversed_devices]) if cfg.found.reversed_devices else F.lit(False)
    if turned is not None:
        df = df.join(turned.select("device_id").distinct().withColumn("_turned", F.lit(True)), "device_id", "left")
        reversed_ = reversed_ | F.coalesce("_turned", F.lit(False))
    df = df.where("ts IS NOT NULL").withColumns(
        {c: F.when(~F.isnan(F.col(c).try_cast("double")), F.col(c).try_cast("double")) for c in ("loop_count", "voltage", "temperature", "current")}
    )
    return df.withColumns({
        "invalid_loopnum": F.col("loop_count").isNull(),
        "invalid_sensor": F.col("voltage").isNull() | F.col("temperature").isNull() | F.col("current").isNull(),
        "current_reversed": F.coalesce(reversed_, F.lit(False)),
        "_i": F.when(reversed_, -F.col("current")).otherwise(F.col("current")),
    }).drop("_turned")


def small(cfg: Config) -> Column:
    """The current where it is near zero, so that it tells the sensor's offset."""
    return F.when(F.abs("_i") <= max(cfg.get("anchor.deadband_a") * 5, 1.0), F.col("_i"))


def carried(value: Column, total: Column) -> Column:
    """``value`` in the order of a device's times, its first one on top of the ``total`` of earlier rows, as one sum has it."""
    first = F.lag(F.lit(1)).over(Window.partitionBy("device_id").orderBy("ts")).isNull()
    return F.when(first, F.coalesce(total, F.lit(0.0)) + F.coalesce(value, F.lit(0.0))).otherwise(value)


def run(df: DataFrame, cfg: Config, turned: DataFrame | None = None, state: DataFrame | None = None) -> DataFrame:
    """Raw rows to cleaned rows with invalid_loopnum, invalid_sensor, current_reversed, current_sensor_drift and time_gap.

    The zero offset of a device is the mean of its small currents, taken in a window: no join, one exchange on the device
    that the gap window shares. They are added in the order of their times: whether a current is above, below or at zero may
    hang on the last bit of the sum, and the order in which rows come out of a shuffle differs from run to run. With ``state``
    (see ``state``), what is known of a device's rows before these counts as if they were there; columns that begin with
    _before carry it on to the anchors.
    """
    df = signed(df, cfg, turned)
    w, before = Window.partitionBy("device_id"), None
    summed = w.orderBy("ts").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    if state is None:
        offset = F.avg(small(cfg)).over(summed)
    else:
        df = df.join(state.select("device_id", F.struct("n", "total", "last_sec", "last_current", "reversed", "resting").alias("_s")), "device_id", "left")
        df = df.withColumn("_s", as_signed(F.col("_s"), F.col("current_reversed")))
        n = F.count(small(cfg)).over(w) + F.coalesce("_s.n", F.lit(0))
        df = df.withColumn("_add", carried(small(cfg), F.col("_s.total")))
        offset = F.sum("_add").over(summed) / F.nullif(n, F.lit(0))
        before = F.col("_s.last_sec")
    df = df.withColumn("_offset", offset).withColumns({
        "current": F.col("_i") - F.coalesce("_offset", F.lit(0.0)),
        "current_sensor_drift": F.coalesce(F.abs("_offset") > cfg.get("anchor.sensor_drift_a"), F.lit(False)),
        "loop_count": F.coalesce("loop_count", F.lit(0.0)),
    })
    df = gap_flag(df, "device_id", "ts", cfg.get("anchor.gap_hours"), before=before)
    if state is not None:
        o = F.coalesce("_offset", F.lit(0.0))
        moved = F.transform("_s.resting", lambda x: F.struct(x["since"].alias("since"), (x["high"] - o).alias("high"), (x["low"] - o).alias("low")))
        df = df.withColumns({"_before_sec": before, "_before_current": F.col("_s.last_current") - o, "_before_resting": moved}).drop("_s")
    return df.drop("_i", "_offset", "_add")


def as_signed(s: Column, reversed_: Column) -> Column:
    """A device's state as it would be if its current had the sign that ``reversed_`` says."""
    flip = s["reversed"] != reversed_
    resting = F.when(flip, F.transform(s["resting"], lambda x: F.struct(x["since"].alias("since"), (-x["low"]).alias("high"), (-x["high"]).alias("low")))).otherwise(s["resting"])
    other = [F.when(flip, -s[c]).otherwise(s[c]).alias(c) for c in ("total", "last_current")]
    return F.when(s.isNotNull(), F.struct(s["n"].alias("n"), other[0], s["last_sec"].alias("last_sec"), other[1], reversed_.alias("reversed"), resting.alias("resting")))
