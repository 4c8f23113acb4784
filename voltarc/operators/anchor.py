"""Anchors: rows at which the state of charge is physically known."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions.params import by_model
from ..functions.series import rest_runs
from ..functions.stats import finite, interpolated

#: Columns of the cleaning step that end here.
_DONE = ("invalid_loopnum", "invalid_sensor", "current_reversed", "current_sensor_drift", "time_gap")


def run(df: DataFrame, cfg: Config) -> DataFrame:
    """Adds anchor_type (SWAP_FULL, EMPTY_END, FULL_END, OCV or NONE), soc_anchor (null without) and flags.

    The type goes by B, C, A, D; the state of charge by D, A, C, B: a full or empty end that is also the end of a long rest
    keeps its type and takes the voltage's state of charge. Rows cleaned with a state count what that knows of earlier ones.
    """
    a = cfg.get("anchor")
    v_full = by_model(df, cfg, lambda p: p.v_full, cfg.v_full())
    v_cutoff = by_model(df, cfg, lambda p: p.v_cutoff, cfg.v_cutoff())
    series = by_model(df, cfg, lambda p: float(p.series), float(cfg.series))
    rest_a = by_model(df, cfg, lambda p: cfg.rest_current(p.c_nom_spec), cfg.rest_current())
    curves = list(dict.fromkeys([cfg.ocv_curve(), *(cfg.ocv_curve(p.chemistry, p.series) for p in cfg.models.values())]))
    curve = by_model(df, cfg, lambda p: curves.index(cfg.ocv_curve(p.chemistry, p.series)), 0)
    soc, v, i = (finite(F.col(c)) for c in ("soc", "voltage", "current"))
    valid = F.coalesce(soc.isNotNull() & v.isNotNull() & i.isNotNull(), F.lit(False))
    w, ahead = Window.partitionBy("device_id").orderBy("ts"), {}
    before = F.lag("current").over(w)
    if "_before_sec" in df.columns:
        long = F.filter("_before_resting", lambda x: (F.abs(x["high"]) < rest_a) & (F.abs(x["low"]) < rest_a))
        ahead = {"before": F.col("_before_sec"), "since": F.array_min(F.transform(long, lambda x: x["since"]))}
        before = F.when(F.lag(F.lit(1)).over(w).isNull(), F.col("_before_current")).otherwise(before)
    timed = rest_runs(df, "device_id", "ts", valid & (F.abs(i) < rest_a), a["gap_hours"] * 3600, a["duration_hours"] * 3600, **ahead)
    test = {
        "_a": (soc > a["soc_full"]) & (v > v_full * a["v_full_ratio"]) & (i > 0) & (i < a["full_current_max_a"]),
        "_b": (before > a["full_current_max_a"]) & ~F.isnan(before) & (F.abs(i) < rest_a) & (soc >= a["soc_swap_full"]) & (v < v_full * a["v_full_ratio"]),
        "_c": (soc < a["soc_empty"]) & (v < v_cutoff * a["v_cutoff_ratio"]) & (i < 0),
        "_d": F.col("run_end"),
    }
    marked = timed.withColumns({k: F.coalesce(c & valid, F.lit(False)) for k, c in test.items()})
    charge = interpolated(v / series, curves[0][1], curves[0][0])
    for k, (axis, volts) in enumerate(curves[1:], 1):
        charge = F.when(curve == k, interpolated(v / series, volts, axis)).otherwise(charge)
    looked_up = F.least(F.greatest(charge, F.lit(0.02)), F.lit(0.98))
    marked = marked.withColumns({
        "anchor_type": F.when(F.col("_b"), "SWAP_FULL").when(F.col("_c"), "EMPTY_END").when(F.col("_a"), "FULL_END").when(F.col("_d"), "OCV").otherwise("NONE"),
        "soc_anchor": F.when(F.col("_d"), looked_up).when(F.col("_a"), F.greatest(soc, F.lit(0.95))).when(F.col("_c"), F.greatest(soc, F.lit(0.02))).when(F.col("_b"), F.lit(1.0)),
        "flags": F.array_compact(F.array(
            F.when(sum((F.col(k).cast("int") for k in test), F.lit(0)) > 1, "anchor_conflict"), F.when(F.col("current_sensor_drift"), "sensor_drift"),
            F.when(F.col("invalid_loopnum"), "invalid_loopnum"), F.when(F.col("invalid_sensor"), "invalid_sensor"),
        )),
    })
    return marked.drop(*test, "is_rest", "rest_s", "run_end", "_before_sec", "_before_current", "_before_resting", *_DONE)
