"""Operators written as expressions against plain per-group Python run by Spark's grouped maps."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voltarc.config import Found, load_config
from voltarc.functions import series
from voltarc.operators import retirement

CFG = load_config({"c_nom_spec": 40.0}, found=Found("NMC", 21, "DYNAMIC", "ABSOLUTE", 88.2, 63.0))


@pytest.fixture(scope="module")
def groups(spark):
    """Groups of 1 to 2,000 rows with ties and nulls."""
    rng, rows = np.random.default_rng(11), []
    for g, n in enumerate([1, 2, 3, 6, 7, 40, 300, 2000]):
        t = np.cumsum(rng.choice([600, 3600, 21600, 21601, 90000], n, p=[0.4, 0.3, 0.15, 0.1, 0.05]))
        v = np.round(40 - np.arange(n) * 0.01 + rng.normal(0, 0.4, n), 1)
        v[rng.random(n) < 0.03] += 15
        for k in range(n):
            rows.append((g, int(t[k]), k, None if rng.random() < 0.05 else float(v[k]), float(rng.integers(1, 5)), bool(rng.random() < 0.7)))
    return spark.createDataFrame(rows, "g long, sec long, k long, v double, w double, rest boolean").repartition(3, "g").cache()


def compare(expression, grouped, names):
    got, want = (sorted(str([round(x, 8) if isinstance(x, float) and x == x else None if x is None or x != x else x for x in r]) for r in df.select(*names).collect()) for df in (expression, grouped))
    assert got == want


def test_rest_runs(groups):
    def plain(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("sec")
        out, before, began = [], None, None
        for sec, rest in zip(p.sec, p.rest, strict=True):
            rests = bool(rest) and (before is None or sec - before <= 21600)
            began = (began if began is not None else sec) if rests else None
            out.append((rests, int(sec - began) if rests else 0))
            before = sec
        ends = [r and s >= 7200 and not (k + 1 < len(out) and out[k + 1][0]) for k, (r, s) in enumerate(out)]
        return pd.DataFrame({"g": p.g, "k": p.k, "is_rest": [r for r, _ in out], "rest_s": [s for _, s in out], "run_end": ends})

    timed = groups.withColumn("ts", F.timestamp_seconds("sec"))
    names = ["g", "k", "is_rest", "rest_s", "run_end"]
    compare(series.rest_runs(timed, "g", "ts", F.col("rest"), 21600, 7200), groups.groupBy("g").applyInPandas(plain, "g long, k long, is_rest boolean, rest_s long, run_end boolean"), names)


def test_rolling_mad(groups):
    def plain(p: pd.DataFrame) -> pd.DataFrame:
        v = p.sort_values("k").v.tolist()
        near = [[x for x in v[max(0, i - 3) : i + 4] if x is not None and x == x] for i in range(len(v))]
        spike, cleaned = [], []
        for x, a in zip(v, near, strict=True):
            known = x is not None and x == x
            m = np.median(a) if a else np.nan
            s = 1.4826 * np.median(np.abs(np.array(a) - m)) if a else np.nan
            spike.append(bool(known and len(a) >= 3 and (abs(x - m) > 1e-9 if s <= 1e-12 else abs(x - m) > 3 * s)))
        for i, x in enumerate(v):
            others = [y for y, bad in zip(v[max(0, i - 3) : i + 4], spike[max(0, i - 3) : i + 4], strict=True) if not bad and y is not None and y == y]
            cleaned.append((float(np.median(others)) if others else x) if spike[i] else x)
        return pd.DataFrame({"g": p.g.iloc[0], "k": sorted(p.k), "is_spike": spike, "cleaned": cleaned})

    compare(series.rolling_mad(groups, ["g"], "k", "v", 7, 3.0), groups.groupBy("g").applyInPandas(plain, "g long, k long, is_spike boolean, cleaned double"), ["g", "k", "is_spike", "cleaned"])


def test_monotone_regression(groups):
    def plain(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("k")
        blocks = []
        for x, w in zip(p.v, p.w, strict=True):
            blocks.append([x * w, w, 1])
            while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] < blocks[-1][0] / blocks[-1][1]:
                s, w2, n = blocks.pop()
                blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + w2, blocks[-1][2] + n]
        return pd.DataFrame({"g": p.g.iloc[0], "k": p.k.tolist(), "fitted": [s / w for s, w, n in blocks for _ in range(n)]})

    known = groups.where("v IS NOT NULL AND k < 400")  # a series is months
    compare(series.pava_series(known, ["g"], "k", "v", "w", "fitted"), known.groupBy("g").applyInPandas(plain, "g long, k long, fitted double"), ["g", "k", "fitted"])


def test_forecast(spark):
    """The retirement month and its bounds, from a fit by numpy."""
    rng, rows = np.random.default_rng(3), []
    for d, n in enumerate([1, 2, 3, 4, 8, 20, 60]):
        y = np.round(1 - np.arange(n) * rng.choice([0.0, 0.002, 0.01]) + rng.normal(0, 0.004, n), 3)
        rows += [("c", d, f"{2020 + m // 12}-{m % 12 + 1:02d}", float(y[m]), 40.0 * float(y[m]), float(m), "m", 3) for m in range(n)]
    table = spark.createDataFrame(rows, "channel string, device_id bigint, ym string, soh double, capacity_median double, loop_median double, model string, capacity_count bigint")
    r = CFG.get("retirement")

    def plain(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("ym")
        x, y, n = np.array([int(m[:4]) * 12 + int(m[5:]) for m in p.ym], float), p.soh.to_numpy(), len(p)
        months = [None] * 3
        if n >= r["min_months"]:
            slope, level = np.polyfit(x - x.mean(), y, 1)
            if slope < -1e-12:
                spread = r["ci_z"] * np.sqrt(((y - level - slope * (x - x.mean())) ** 2).sum() / max(n - 2, 1))
                at = [int(np.rint(x.mean() + (r["soh_retire"] + shift - level) / slope)) - 1 for shift in (0, spread, -spread)]
                months = [f"{k // 12}-{k % 12 + 1:02d}" for k in at]
        return pd.DataFrame([[p.device_id.iloc[0], *months]], columns=["device_id", *names[1:]])

    names = ["device_id", "predicted_retire_month", "retire_ci_low", "retire_ci_high"]
    grouped = table.groupBy("device_id").applyInPandas(plain, "device_id long, predicted_retire_month string, retire_ci_low string, retire_ci_high string")
    compare(retirement.forecast(table, CFG), grouped, names)
    assert grouped.where("retire_ci_low < retire_ci_high").count() >= 3
