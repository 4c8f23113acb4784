"""Cohorts of models by month, age, loops and stage; fleet figures and the retirement schedule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions import ranks
from ..functions.params import by_model
from ..functions.series import month_index, month_spine, month_text

WINDOW_MONTHS = 72
#: Order of the health levels in reports.
LEVELS = {"健康": 0, "关注": 1, "预警": 2, "退役": 3, "unknown": 4}


#: Quantiles of the state of health that most cohorts have, and how many devices they hold.
SOH = {"soh_median": ("soh", None), "soh_p10": ("soh", 0.10), "soh_p90": ("soh", 0.90)}


def _devices() -> Column:
    return F.countDistinct("device_id").alias("device_count")


def _capacity(df: DataFrame) -> DataFrame:
    """capacity_ah instead of the median nominal capacity."""
    return df.withColumn("capacity_ah", F.col("soh_median") * F.col("_c_nom")).drop("_c_nom")


def by_month(table: DataFrame) -> DataFrame:
    wants = SOH | {"_c_nom": ("c_nom_soh", None), "loop_median": ("loop_median", None)}
    return _capacity(ranks.aggregate(table, ["model", "ym"], wants, _devices(), F.max("loop_max").alias("loop_max"), needs=["device_id", "loop_max"]))


def decay_stats(table: DataFrame) -> DataFrame:
    """Quartiles of the decay over device months (so that longer series weigh more), and medians of first and last months."""
    ends = table.groupBy("model", "channel", "device_id").agg(F.min_by("soh", "ym").alias("_a"), F.max_by("soh", "ym").alias("_b"))
    ends = ranks.aggregate(ends, ["model"], {"soh_start": ("_a", None), "soh_latest": ("_b", None)}, _devices(), needs=["device_id"])
    c = "decay_rate_pct_year"
    return ranks.aggregate(table, ["model"], {"decay_pct_year_median": (c, None), "decay_pct_year_p25": (c, 0.25), "decay_pct_year_p75": (c, 0.75)}).join(ends, "model")


def with_age(table: DataFrame) -> DataFrame:
    mi = month_index("ym")
    return table.withColumn("_mi", mi).withColumn("birth", F.min("_mi").over(Window.partitionBy("device_id"))).withColumn("age_month", F.col("_mi") - F.col("birth")).drop("_mi")


def by_age(table: DataFrame) -> DataFrame:
    loops = "loop_median"
    wants = SOH | {"_c_nom": ("c_nom_soh", None), "birth_p25": ("birth", 0.25), "birth_p75": ("birth", 0.75), "loop_median": (loops, None), "loop_p25": (loops, 0.25), "loop_p75": (loops, 0.75)}
    return _capacity(ranks.aggregate(with_age(table), ["model", "age_month"], wants, _devices(), needs=["device_id"]))


def by_loops(table: DataFrame, width: int = 25) -> DataFrame:
    wants = SOH | {"_c_nom": ("c_nom_soh", None), "age_p25": ("age_month", 0.25), "age_p75": ("age_month", 0.75), "birth_p25": ("birth", 0.25), "birth_p75": ("birth", 0.75)}
    binned = with_age(table).where("loop_median IS NOT NULL").withColumn("loop_bin", F.floor(F.col("loop_median") / width).cast("long"))
    grouped = _capacity(ranks.aggregate(binned, ["model", "loop_bin"], wants, _devices(), needs=["device_id"]))
    return grouped.withColumns({"loop_from": F.col("loop_bin") * width, "loop_to": (F.col("loop_bin") + 1) * width})


def by_stage(table: DataFrame, forecast: DataFrame) -> DataFrame:
    last = table.groupBy("model", "channel", "device_id").agg(F.max_by("loop_max", "ym").alias("loops"), F.max_by("soh", "ym").alias("soh"))
    staged = last.join(forecast.select("channel", "device_id", "health_level"), ["channel", "device_id"])
    wants = {"loops_median": ("loops", None), "loops_p10": ("loops", 0.10), "loops_p90": ("loops", 0.90), "soh_median": ("soh", None)}
    return ranks.aggregate(staged, ["model", "health_level"], wants, _devices(), needs=["device_id"])


def stage_order(level: Column) -> Column:
    out = F.when(level == "健康", F.lit(0))
    for name, k in list(LEVELS.items())[1:]:
        out = out.when(level == name, F.lit(k))
    return out.otherwise(9)


def fleet(table: DataFrame, line: float = 0.80) -> DataFrame:
    """One row a model; first_month is the earliest of its devices' last months, data_from its earliest month at all."""
    last = table.groupBy("model", "channel", "device_id").agg(F.max("ym").alias("_e"), F.min("ym").alias("_s"), F.max_by("soh", "ym").alias("soh"), F.max_by("loop_median", "ym").alias("_l"))
    figures = [F.count("*").alias("devices"), F.min("_e").alias("first_month"), F.min("_s").alias("data_from"), F.count_if(F.col("soh") < line).alias("below_line")]
    return ranks.aggregate(last, ["model"], SOH | {"loop_median": ("_l", None)}, *figures, needs=["_e", "_s", "soh"])


def level_counts(forecast: DataFrame) -> DataFrame:
    return forecast.groupBy("channel").pivot("health_level", list(LEVELS)).agg(F.count(F.lit(1))).na.fill(0)


def retire_months(forecast: DataFrame, table: DataFrame, line: float = 0.80, r2_min: float = 0.6) -> DataFrame:
    """(model, channel, device_id, retire_mi): the trusted forecast, or the model's decay carried on from the last month."""
    keys = ["channel", "device_id"]
    last = table.groupBy(*keys).agg(F.max_by("model", "ym").alias("model"), F.max("ym").alias("_e"), F.max_by("soh", "ym").alias("_soh"))
    rates = ranks.aggregate(table, ["model"], {"_rate": ("decay_rate_pct_year", None)})
    everyone = ranks.aggregate(table, [], {"_all": ("decay_rate_pct_year", None)})
    d = forecast.join(last, keys).join(rates, "model", "left").crossJoin(F.broadcast(everyone))  # one row is broadcast
    monthly = F.greatest(F.abs(F.coalesce(F.nullif("_rate", F.lit(0.0)), F.col("_all"))) / 1200, F.lit(1e-6))
    guess = F.when(F.col("_soh") <= line, month_index("_e")).otherwise(month_index("_e") + F.rint((F.col("_soh") - line) / monthly))
    trusted = (F.col("r_squared") >= r2_min) & F.col("predicted_retire_month").isNotNull()
    return d.select("model", *keys, F.when(trusted, month_index("predicted_retire_month", "long")).otherwise(guess).cast("long").alias("retire_mi"))


def schedule(months: DataFrame, today: int, window: int = WINDOW_MONTHS) -> DataFrame:
    """(model, mi, ym, new_retire, cum_retire) for every month from ``today`` to a model's last retirement in the window."""
    inside = months.where(F.col("retire_mi").between(today, today + window - 1)).withColumn("retire_mi", F.col("retire_mi").try_cast("int"))  # tried: the optimizer may move it ahead of the bounds
    spine = month_spine(inside, "model", F.lit(today), F.max("retire_mi"))
    counts = inside.groupBy("model", F.col("retire_mi").alias("mi")).agg(F.count("*").alias("new_retire"))
    full = spine.join(counts, ["model", "mi"], "left").withColumn("new_retire", F.coalesce("new_retire", F.lit(0)))
    run = Window.partitionBy("model").orderBy("mi").rowsBetween(Window.unboundedPreceding, 0)
    return full.withColumns({"ym": month_text(F.col("mi")), "cum_retire": F.sum("new_retire").over(run)})


def outside(months: DataFrame, today: int, window: int = WINDOW_MONTHS) -> DataFrame:
    """Devices of each model beyond the window, and before it."""
    return months.groupBy("model").agg(F.count_if(F.col("retire_mi") > today + window - 1).alias("beyond"), F.count_if(F.col("retire_mi") < today).alias("earlier"))


def by_quarter(plan: DataFrame) -> DataFrame:
    year, month = F.floor((F.col("mi") - 1) / 12), F.pmod(F.col("mi") - 1, F.lit(12)) + 1
    q = plan.withColumn("quarter", F.format_string("%d Q%d", year.cast("int"), F.ceil(month / 3).cast("int"))).groupBy("model", "quarter").agg(F.sum("new_retire").alias("new_retire"))
    return q.withColumn("cum_retire", F.sum("new_retire").over(Window.partitionBy("model").orderBy("quarter").rowsBetween(Window.unboundedPreceding, 0)))


def kpis(plan: DataFrame, models: DataFrame, today: int) -> DataFrame:
    """One row: retirements in twelve months and in the window, and the device-weighted mean of the models' medians."""
    a = plan.agg(F.coalesce(F.sum(F.when(F.col("mi") < today + 12, F.col("new_retire"))), F.lit(0)).alias("next_12"), F.coalesce(F.sum("new_retire"), F.lit(0)).alias("window_total"))
    b = models.agg(F.try_divide(F.sum(F.col("soh_median") * F.col("devices")), F.sum("devices").cast("double")).alias("soh_mean"))
    return a.crossJoin(b)  # one row each


def peak_month(plan: DataFrame) -> DataFrame:
    """Per model the month with the most retirements, the first of equals."""
    return plan.groupBy("model").agg(F.max_by("ym", F.struct(F.col("new_retire"), -F.col("mi"))).alias("peak_ym"), F.max("new_retire").alias("peak_new"))


def half_way(plan: DataFrame) -> DataFrame:
    """Per model the month whose running total lies nearest to half of all."""
    total = F.max("cum_retire").over(Window.partitionBy("model"))
    return plan.withColumn("_d", F.abs(F.col("cum_retire") - 0.5 * total)).groupBy("model").agg(F.min_by("ym", F.struct("_d", "mi")).alias("half_ym"))


def _met(df: DataFrame, x: Column, y: str, targets: Column) -> DataFrame:
    """(model, target, at): where a model's curve first meets each target, between the points beside it."""
    w = Window.partitionBy("model").orderBy("_x")
    steps = df.withColumn("_x", x.cast("double")).where(F.col(y).isNotNull()).withColumns({"_px": F.lag("_x").over(w), "_py": F.lag(y).over(w)}).where(F.col("_py") != F.col(y))
    hit = steps.withColumn("target", F.explode(targets))
    hit = hit.where((F.col("_py") - F.col("target")) * (F.col(y) - F.col("target")) <= 0)
    at = F.col("_px") + (F.col("target") - F.col("_py")) / (F.col(y) - F.col("_py")) * (F.col("_x") - F.col("_px"))
    return hit.withColumn("_at", at).groupBy("model", "target").agg(F.min_by("_at", "_x").alias("at"))


def loop_axis(trend: DataFrame, x: str, loops: str = "loop_median", step: int = 100) -> DataFrame:
    """(model, loops, x_cross): where a model's loop curve first meets every ``step`` loops; months count as month indexes."""
    at = month_index(x) if dict(trend.dtypes)[x] == "string" else F.col(x)
    low, high = F.least("_py", F.col(loops)), F.greatest("_py", F.col(loops))
    first = F.greatest(F.ceil(low / step), F.lit(1))
    inside = F.when(F.floor(high / step) >= first, F.sequence(first, F.floor(high / step))).otherwise(F.array().cast("array<bigint>"))  # the steps between two points
    met = _met(trend, at, loops, F.transform(inside, lambda k: (k * step).cast("double")))
    return met.select("model", F.col("target").cast("long").alias("loops"), F.col("at").alias("x_cross"))


def crossing_80(trend: DataFrame, x: str, line: float = 0.80, loops: str = "loop_median") -> DataFrame:
    """(model, x_cross, loops_at): where a model's median state of health first meets ``line``, and the loops there."""
    at = month_index(x) if dict(trend.dtypes)[x] == "string" else F.col(x)
    met = _met(trend, at, "soh_median", F.array(F.lit(line))).select("model", F.col("at").alias("x_cross"))
    w = Window.partitionBy("model").orderBy("_x")
    points = trend.where(F.col(loops).isNotNull()).select("model", at.cast("double").alias("_x"), F.col(loops).cast("double").alias("_l")).withColumns({"_nx": F.lead("_x").over(w), "_nl": F.lead("_l").over(w), "_f": F.row_number().over(w)})
    c, x0, x1 = F.col("x_cross"), F.col("_x"), F.col("_nx")
    share = F.coalesce(F.least(F.greatest(F.try_divide(c - x0, x1 - x0), F.lit(0.0)), F.lit(1.0)), F.lit(0.0))
    inner = met.join(points, "model", "left").where(x0.isNull() | ((x0 <= c) | (F.col("_f") == 1)) & (x1.isNull() | (c < x1)))  # the curve's ends go on level
    return inner.select("model", "x_cross", (F.col("_l") + share * (F.coalesce("_nl", F.col("_l")) - F.col("_l"))).alias("loops_at"))


def ticks(trend: DataFrame, x: str, first: int, step: int, shown: tuple[str, ...]) -> DataFrame:
    """(model, tick, ...): for every tick within half a step of 1 of a model's points, the values ``shown`` of the nearest point.

    Of two points equally near the lower one counts. Ticks begin at ``first`` or at the model's first point.
    """
    at = F.col(x).cast("double")
    ends = trend.agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))  # one row: all models share an axis
    axis = ends.where("_hi IS NOT NULL").select(F.explode(F.sequence(F.lit(first), F.greatest(F.lit(first), F.col("_hi").cast("int")), F.lit(step))).alias("tick"), "_lo").where(F.col("tick") >= F.col("_lo") - 0.5)
    own = trend.groupBy("model").agg(F.min(x).alias("_a"), F.max(x).alias("_b"))
    wanted = axis.join(own, (F.col("tick") >= F.col("_a") - 0.5) & (F.col("tick") <= F.col("_b") + 0.5)).select("model", "tick")
    near = wanted.join(trend.select("model", at.alias("_x"), *shown), "model").groupBy("model", "tick")
    found = near.agg(F.min_by(F.struct(*shown), F.struct(F.abs(F.col("_x") - F.col("tick")), F.col("_x"))).alias("_s"))
    return found.select("model", F.col("tick").cast("long").alias("tick"), *[F.col(f"_s.{c}").alias(c) for c in shown])


def described(models: DataFrame, cfg: Config) -> DataFrame:
    """(model, description, c_nom): chemistry and cells of a model in words, and its capacity; the fleet's if it has no sheet."""
    text = by_model(models, cfg, lambda p: f"{'铁锂' if p.chemistry == 'LFP' else '三元'} {p.series}S", "")
    return models.select("model", text.alias("description"), by_model(models, cfg, lambda p: float(p.c_nom_spec), float(cfg.get("c_nom_spec") or 37.0)).alias("c_nom"))


def loop_cap(bins: DataFrame, share: float = 0.98, least: int = 800) -> DataFrame:
    """Per model the end of the loop axis that ``share`` of the devices stay within, in steps of 50."""
    w = Window.partitionBy("model").orderBy("loop_bin").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("device_count").over(Window.partitionBy("model"))
    inside = bins.withColumn("_s", F.sum("device_count").over(w) / total).groupBy("model").agg(F.max(F.when(F.col("_s") <= share, F.col("loop_to"))).alias("_t"))
    return inside.select("model", F.greatest(F.lit(least), (F.floor(F.coalesce("_t", F.lit(0)) / 50) + 1) * 50).cast("long").alias("loop_cap"))
