"""State of health: each device's months trimmed, cleaned and smoothed under a non-increasing constraint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.series import leading_trim, pava_series, rolling_mad

KEYS = ["channel", "device_id"]


def run(monthly: DataFrame, cfg: Config) -> DataFrame:
    """Adds capacity_smoothed, soh, soh_raw, is_spike and c_nom_soh to the months that stay."""
    fallback = float(cfg.get("c_nom_spec") or 37.0)
    spec = F.lit(fallback)
    for name, p in sorted(cfg.models.items()):
        spec = F.when(F.col("model") == name, F.lit(p.c_nom_spec)).otherwise(spec)
    df = monthly.withColumn("c_nom_soh", spec)
    df = leading_trim(df, KEYS, "ym", F.col("capacity_median") / F.col("c_nom_soh"), cfg.get("exclude.soh_low_ratio"))
    df = rolling_mad(df, KEYS, "ym", "capacity_median", cfg.get("soh.mad_window"), cfg.get("soh.mad_threshold"), F.col("capacity_count") >= 2)
    df = pava_series(df, KEYS, "ym", "cleaned", "capacity_count", "capacity_smoothed").drop("cleaned")
    return df.withColumns({"soh": F.try_divide("capacity_smoothed", "c_nom_soh"), "soh_raw": F.try_divide("capacity_median", "c_nom_soh")})
