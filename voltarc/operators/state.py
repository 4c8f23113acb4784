"""What is kept of a device's rows, so that a run over new rows alone gives the anchors of a run over all.

A device's state holds the sum and number of its small currents, its last row, and its open rest run. Whether rows rest
depends on the offset, and that on rows yet to come; so the open run is kept as steps (since, high, low): the rows since then
lie between low and high. For any offset the run began at the earliest step whose bounds are both at rest. A step stays only
while some offset could hold it, so a device has as many as its resting current has new extremes.

States are merged, never recomputed: those of two spans of time, the later one after the earlier. Currents are added one by one
in the order of their times, the later span's on top of the earlier one's sum, so that the offset is that of a whole run to the bit. Bins of R and each
device's last anchors of each type complete what a run needs.

Defined cases: a device without rows in a span keeps its state; one without a state begins as its first row does in a whole
run; a device whose sign was found to be wrong since then has its state turned; an empty span changes nothing; rows without
a time don't count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions.params import by_model
from ..functions.series import seconds
from ..functions.stats import finite
from . import clean

COLUMNS = ("device_id", "n", "total", "last_sec", "last_current", "reversed", "resting")


def _lowest(steps: Column) -> Column:
    """Steps in order, the earliest of each pair of bounds."""
    ordered = F.array_sort(steps)
    same = lambda x, k: (k > 0) & (F.get(ordered, k - 1)["high"] == x["high"]) & (F.get(ordered, k - 1)["low"] == x["low"])
    return F.filter(ordered, lambda x, k: ~F.coalesce(same(x, k), F.lit(False)))


def after(rows: DataFrame, cfg: Config, turned: DataFrame | None = None, state: DataFrame | None = None) -> DataFrame:
    """The state of devices after ``rows`` (raw, deduplicated), which follow those of ``state``; one exchange on the device."""
    df = clean.signed(rows, cfg, turned)
    rest_a = by_model(df, cfg, lambda p: cfg.rest_current(p.c_nom_spec), cfg.rest_current())
    df = df.withColumns({"_t": seconds("ts"), "_rest_a": rest_a.cast("double")})
    if state is not None:
        df = df.join(state.select("device_id", F.col("last_sec").alias("_last"), F.col("total").alias("_before"), F.col("reversed").alias("_turned")), "device_id", "left")
    w = Window.partitionBy("device_id").orderBy("ts")
    last = F.lag("_t").over(w) if state is None else F.coalesce(F.lag("_t").over(w), "_last")
    valid = F.coalesce(finite(F.col("soc")).isNotNull() & finite(F.col("voltage")).isNotNull() & finite(F.col("_i")).isNotNull(), F.lit(False))
    df = df.withColumn("_ok", valid & F.coalesce(F.col("_t") - last <= cfg.get("anchor.gap_hours") * 3600, F.lit(True)))
    ahead = Window.partitionBy("device_id").orderBy(F.col("ts").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.lit(0.0) if state is None else F.when(F.col("_turned") != F.col("current_reversed"), -F.col("_before")).otherwise(F.col("_before"))
    summed = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    df = df.withColumn("_add", clean.carried(clean.small(cfg), total)).withColumn("_total", F.sum("_add").over(summed))
    df = df.withColumns({"_open": F.min("_ok").over(ahead), "_high": F.max("_i").over(ahead), "_low": F.min("_i").over(ahead)})
    df = df.withColumn("_step", F.col("_open") & (F.col("_high") - F.col("_low") < 2 * F.col("_rest_a")))
    again = F.coalesce(F.lag("_step").over(w) & (F.lag("_high").over(w) == F.col("_high")) & (F.lag("_low").over(w) == F.col("_low")), F.lit(False))
    step = F.struct(F.col("_t").alias("since"), F.col("_high").alias("high"), F.col("_low").alias("low"))
    found = df.withColumn("_again", again).groupBy("device_id").agg(
        F.count(clean.small(cfg)).alias("n"), F.max("_total").alias("total"), F.max("_t").alias("last_sec"), F.max_by("_i", "ts").alias("last_current"),
        F.max("current_reversed").alias("reversed"), F.array_sort(F.collect_list(F.when(F.col("_step") & ~F.col("_again"), step))).alias("resting"),
        F.min("_ok").alias("_whole"), F.max("_i").alias("_high"), F.min("_i").alias("_low"), F.max("_rest_a").alias("_rest_a"),
    )
    return found.select(*COLUMNS) if state is None else _joined(state, found)


def _joined(state: DataFrame, found: DataFrame) -> DataFrame:
    """``state`` followed by what was ``found`` after it."""
    old = state.select("device_id", F.struct(*COLUMNS[1:]).alias("_old"))
    new = found.select("device_id", F.struct(*[c for c in found.columns if c != "device_id"]).alias("_new"))
    df = old.join(new, "device_id", "full").withColumn("_old", F.when(F.col("_new").isNull(), F.col("_old")).otherwise(clean.as_signed(F.col("_old"), F.col("_new.reversed"))))
    a, b = F.col("_old"), F.col("_new")
    wider = F.transform(a["resting"], lambda x: F.struct(x["since"].alias("since"), F.greatest(x["high"], b["_high"]).alias("high"), F.least(x["low"], b["_low"]).alias("low")))
    held = F.filter(wider, lambda x: x["high"] - x["low"] < 2 * b["_rest_a"])
    through = F.when(b["_whole"] & a.isNotNull(), _lowest(F.concat(held, b["resting"]))).otherwise(b["resting"])
    return df.select(
        "device_id", (F.coalesce(a["n"], F.lit(0)) + F.coalesce(b["n"], F.lit(0))).alias("n"), F.when(b.isNull(), a["total"]).otherwise(b["total"]).alias("total"),
        F.coalesce(b["last_sec"], a["last_sec"]).alias("last_sec"), F.when(b.isNull(), a["last_current"]).otherwise(b["last_current"]).alias("last_current"),
        F.coalesce(b["reversed"], a["reversed"]).alias("reversed"), F.when(b.isNull(), a["resting"]).otherwise(through).alias("resting"),
    )


def last_anchors(points: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """(device_id, anchor_type, ts, capacity_corrected): each device's last anchor of each type, of ``earlier`` where it has none."""
    own = points.select("device_id", "anchor_type", "ts", "capacity_corrected")
    both = own if earlier is None else own.unionByName(earlier)
    return both.groupBy("device_id", "anchor_type").agg(F.max_by("capacity_corrected", "ts").alias("capacity_corrected"), F.max("ts").alias("ts")).select("device_id", "anchor_type", "ts", "capacity_corrected")
