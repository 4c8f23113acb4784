"""Retirement: each device's line through its months, the month at which it meets the retirement line, and its health level."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions.series import month_index, month_text
from ..functions.stats import half_up, ols_r2

KEYS = ["channel", "device_id"]


def health_level(soh: Column, levels: Sequence[float]) -> Column:
    a, b, c = levels
    return F.when(soh.isNull(), "unknown").when(soh >= a, "健康").when(soh >= b, "关注").when(soh >= c, "预警").otherwise("退役")


def forecast(table: DataFrame, cfg: Config) -> DataFrame:
    """One row a device. The line is used through its centre of mass, which keeps digits at month indexes of 24,000.

    Months are rounded half to even; the interval comes from the line shifted by z residual deviations.
    """
    r = cfg.get("retirement")
    line, least, r2_min, z = r["soh_retire"], r["min_months"], r["r2_min"], r["ci_z"]
    y, x = F.col("soh"), month_index("ym").cast("double")
    latest = F.max_by("soh", F.when(F.col("soh").isNotNull(), F.col("ym")))
    timed = Window.partitionBy(*KEYS).orderBy("ym").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = table.withColumn("_r2", ols_r2(y, x, F.lit(0.0), timed)).groupBy(*KEYS).agg(
        latest.alias("soh_latest"), F.regr_count(y, x).alias("_n"), F.regr_slope(y, x).alias("_m"), F.regr_avgx(y, x).alias("_x"), F.regr_avgy(y, x).alias("_y"),
        F.max("_r2").alias("_r2"), F.greatest(F.regr_syy(y, x) - F.coalesce(F.regr_slope(y, x), F.lit(0.0)) * F.regr_sxy(y, x), F.lit(0.0)).alias("_ss"),
    )
    enough, falls = F.col("_n") >= least, F.col("_m") < -1e-12
    spread = z * F.sqrt(F.col("_ss") / F.greatest(F.col("_n") - 2, F.lit(1)))

    def month(at: Column) -> Column:
        return F.when(enough & falls, month_text(F.rint(F.col("_x") + F.try_divide(at - F.col("_y"), F.col("_m")))))

    r2 = F.col("_r2")
    low_r2 = F.concat(F.lit("R²="), F.format_string("%s", half_up(r2, 3)), F.lit(f"<{r2_min}，仅供参考"))
    note = F.when(~enough, "数据不足").when(~F.coalesce(falls, F.lit(False)), F.when(r2 >= r2_min, "无衰退趋势").otherwise("无衰退趋势（R²低）")).when(r2 < r2_min, low_r2).otherwise("")
    return d.select(
        *KEYS, "soh_latest", health_level(F.col("soh_latest"), r["health_levels"]).alias("health_level"), month(F.lit(line)).alias("predicted_retire_month"),
        F.when(enough, half_up(r2, 4)).alias("r_squared"), month(F.lit(line) + spread).alias("retire_ci_low"), month(F.lit(line) - spread).alias("retire_ci_high"), note.alias("note"),
    )
