"""Quality of anchors: flags, score, tier and statistical weight."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from .capacity import with_neighbours

KINDS = ("SWAP_FULL", "EMPTY_END", "FULL_END", "OCV")


def by_kind(values: Mapping[str, float]) -> Column:
    out = F.when(F.col("anchor_type") == KINDS[0], F.lit(float(values[KINDS[0]])))
    for k in KINDS[1:]:
        out = out.when(F.col("anchor_type") == k, F.lit(float(values[k])))
    return out.otherwise(0.0)


def contradiction(c: Column, before: Column, after: Column, ratio: float) -> Column:
    """Whether a value is further from a neighbour than ``ratio`` of it; a missing side says nothing."""
    return F.coalesce(F.coalesce(F.abs(c - before) > F.abs(before) * ratio, F.lit(False)) | F.coalesce(F.abs(c - after) > F.abs(after) * ratio, F.lit(False)), F.lit(False))


def run(points: DataFrame, cfg: Config, earlier: DataFrame | None = None) -> DataFrame:
    """Adds f_* flags, severe, quality_score, cap_tier and stat_weight.

    ``earlier`` holds a device's last anchors before these (see ``state``): neighbours that are judged no more.

    A severe point can still be tier 2; tier 1 needs another anchor of the device, of any type, within the closure days.
    """
    q, s = cfg.get("quality"), cfg.get("quality.score")
    (lo, hi), (nlo, nhi) = cfg.get("filter.cap_anomaly_ratio"), cfg.get("filter.cap_normal_ratio")
    (cold, hot), (ncold, nhot) = cfg.get("filter.temp_range"), cfg.get("filter.temp_normal_range")
    c, nom, t = F.col("capacity_corrected"), F.col("c_nom_bms"), F.col("temperature")
    if earlier is not None:
        points = points.withColumn("_judged", F.lit(True)).unionByName(earlier.withColumn("_judged", F.lit(False)), allowMissingColumns=True)
    df = with_neighbours(points).withColumns({
        "f_out_of_range": F.coalesce((c < nom * lo) | (c > nom * hi), F.lit(False)),
        "f_voltage_inconsistent": F.coalesce("v_inconsistent", F.lit(False)),
        "f_temp_out": F.coalesce("temp_out", F.lit(False)),
        "f_anchor_conflict": F.coalesce(F.array_contains("flags", "anchor_conflict"), F.lit(False)),
        "f_sensor_drift": F.coalesce(F.array_contains("flags", "sensor_drift"), F.lit(False)),
        "f_contradiction": contradiction(c, F.col("_p"), F.col("_n"), q["contradiction_ratio"]),
    }).drop("_p", "_n")
    df = df.withColumn("severe", reduce(lambda a, b: a | b, [F.col(f"f_{k}") for k in q["severe_flags"]], F.lit(False)))
    score = (
        by_kind(s)
        + F.when((t >= ncold) & (t <= nhot), s["temp_normal"]).when((t < cold) | (t > hot), s["temp_out"]).otherwise(0.0)
        + F.when((c >= nom * nlo) & (c <= nom * nhi), s["cap_normal"]).when(F.col("f_out_of_range"), s["cap_anomaly"]).otherwise(0.0)
        + F.when(F.col("f_voltage_inconsistent"), s["v_anomaly"]).otherwise(s["v_normal"])
        + F.when(F.col("f_contradiction"), s["contradiction"]).otherwise(0.0)
        + F.when(F.col("f_sensor_drift"), s["sensor_drift"]).otherwise(0.0)
    )
    w = Window.partitionBy("device_id").orderBy("ts")
    day = F.unix_date(F.to_date("ts"))
    near = [F.coalesce(F.abs(day - x(day).over(w)) <= q["closure_days"], F.lit(False)) for x in (F.lag, F.lead)]
    df = df.withColumns({"quality_score": score.cast("double"), "_closed": near[0] | near[1]})
    df = df if earlier is None else df.where("_judged").drop("_judged")
    first = (F.col("quality_score") >= q["tier1_min"]) & ~F.col("severe")
    df = df.withColumn("cap_tier", F.when(first & F.col("_closed"), 1).when(F.col("quality_score") >= q["tier2_min"], 2).otherwise(3)).drop("_closed")
    return df.withColumn("stat_weight", by_kind(q["weight"]) * F.when(F.col("cap_tier") == 1, 1.0).when(F.col("cap_tier") == 2, q["tier2_weight"]).otherwise(0.0))
