"""Capacity at anchors: remaining charge over the anchored state of charge, compensated for temperature."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions import ranks
from ..functions.params import by_model
from ..session import settle

DEFAULT_C_NOM = 40.0


def with_c_nom(df: DataFrame, c_nom: DataFrame, model: str | None = None) -> DataFrame:
    """Join (channel, device_id, c_nom_bms); without one, the median of the known ones (of the model), else 40 Ah."""
    joined = df.join(c_nom.groupBy("channel", "device_id").agg(F.min("c_nom_bms").alias("c_nom_bms")), ["channel", "device_id"], "left")
    known = joined.where((F.col("soc_anchor") > 0) & F.col("c_nom_bms").isNotNull())
    keys = [model] if model else []
    medians = ranks.aggregate(known, keys, {"_c": ("c_nom_bms", None)})
    joined = joined.join(medians, keys, "left") if keys else joined.crossJoin(F.broadcast(medians))  # one row
    return joined.withColumn("c_nom_bms", F.coalesce("c_nom_bms", F.nullif("_c", F.lit(0.0)), F.lit(DEFAULT_C_NOM))).drop("_c")


def run(anchors: DataFrame, c_nom: DataFrame, cfg: Config) -> DataFrame:
    """Anchor rows only, with c_nom_bms, capacity_raw, capacity_corrected, out_of_range, temp_out and v_inconsistent."""
    chem = cfg.chem_params()
    alpha, t_ref, cutoff = (by_model(anchors, cfg, lambda p, k=k: cfg.chem_params(p.chemistry)[k], chem[k]) for k in ("alpha", "t_ref", "cell_v_cutoff"))
    series = by_model(anchors, cfg, lambda p: float(p.series), float(cfg.series))
    cell_full = by_model(anchors, cfg, lambda p: p.cell_v_full, chem["cell_v_full"])
    lo, hi = cfg.get("filter.cap_range_ratio")
    cold, hot = cfg.get("filter.temp_range")
    # written first: the fallback's median and the join read the anchors, not the telemetry behind them twice
    only = settle(anchors.where(F.col("anchor_type") != "NONE"), "anchors")
    df = with_c_nom(only, c_nom, "model" if "model" in anchors.columns and cfg.models else None)
    df = df.withColumn("capacity_raw", F.try_divide("remaining_ah", "soc_anchor"))
    df = df.withColumn("capacity_corrected", F.col("capacity_raw") * (1 + alpha * (t_ref - F.col("temperature"))))
    c, nom, t, cell = F.col("capacity_corrected"), F.col("c_nom_bms"), F.col("temperature"), F.col("voltage") / series
    odd = ((F.col("anchor_type") == "EMPTY_END") & (cell > cutoff * 1.25)) | ((F.col("anchor_type") == "FULL_END") & (cell < cell_full * 0.9))
    return df.withColumns({k: F.coalesce(x, F.lit(False)) for k, x in {"out_of_range": (c < nom * lo) | (c > nom * hi), "temp_out": (t < cold) | (t > hot), "v_inconsistent": odd}.items()})


def plot_points(scored: DataFrame) -> DataFrame:
    """Anchors of tier 1 and 2 with their share of the nominal capacity."""
    names = ["channel", "device_id", "ts", "anchor_type", "capacity_corrected", "c_nom_bms", "cap_tier", "quality_score"]
    return scored.where("cap_tier <= 2").select(*names, F.try_divide("capacity_corrected", "c_nom_bms").alias("soh_point"))


def with_neighbours(df: DataFrame) -> DataFrame:
    """Adds f_contradiction's inputs _p and _n: the capacities of the anchors of the same type before and after."""
    w = Window.partitionBy("device_id", "anchor_type").orderBy("ts")
    return df.withColumns({"_p": F.lag("capacity_corrected").over(w), "_n": F.lead("capacity_corrected").over(w)})
