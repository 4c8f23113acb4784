"""Thinned curves and axes."""

import numpy as np
from pyspark.sql import functions as F

from voltarc.operators import charts


def plain(points, most):
    n, parts = len(points), max(1, (most - 2) // 3)
    if n <= most:
        return points
    cut = [1 + (n - 2) * k // parts for k in range(parts + 1)]
    out = [points[0]]
    for k in range(parts):
        own = points[cut[k] : cut[k + 1]]
        ahead = (points[cut[k + 1] : cut[k + 2]] if k + 1 < parts else []) or points[-1:]
        x2, y2 = (sum(p[j] for p in ahead) / len(ahead) for j in (0, 1))
        (x0, y0) = out[-1]
        first = lambda key: max(range(len(own)), key=lambda i: (key(own[i]), -i))
        taken = {own[first(f)] for f in (lambda p: abs((x0 - x2) * (p[1] - y0) - (x0 - p[0]) * (y2 - y0)), lambda p: p[1], lambda p: -p[1])} if own else set()
        out += sorted(taken)
    return [*out, points[-1]]


def test_curves(spark):
    rng = np.random.default_rng(8)
    series = {g: sorted((float(x), float(np.round(y, 2))) for x, y in enumerate(np.cumsum(rng.normal(0, 1, n)))) for g, n in enumerate((1, 2, 3, 14, 15, 40, 500))}
    rows = [(g, x, y) for g, points in series.items() for x, y in points] + [(0, 5.0, None), (1, None, 3.0), (9, None, None)]
    df = spark.createDataFrame(rows, "g long, x double, y double").repartition(3)
    got = {r.g: r for r in charts.curves(df, ["g"], F.col("x"), F.col("y"), 14).collect()}
    assert set(got) == set(series)
    for g, points in series.items():
        drawn = [tuple(p) for p in got[g].points]
        assert drawn == plain(points, 14) and got[g].n == len(points) and got[g].shown == len(drawn) <= 14
        assert drawn[0] == points[0] and drawn[-1] == points[-1]
        assert max(y for _, y in drawn) == max(y for _, y in points) and min(y for _, y in drawn) == min(y for _, y in points)


def test_axes(spark):
    df = spark.createDataFrame([(1, 3.0, 97.0), (1, 0.02, 97.0), (2, -7.0, 1e6), (2, 40.0, 3e6), (3, 0.0, -2.0)], "g long, a double, b double")
    got = {r.g: r for r in charts.scales(df, ["g"], ["a", "b"]).collect()}
    assert (got[1].a_low, got[1].a_high, got[1].a_step) == (0.0, 3.0, 0.5) and got[1].b_low <= 97 <= got[1].b_high
    assert (got[2].a_low, got[2].a_high, got[2].a_step) == (-10.0, 40.0, 10.0) and got[2].b_step == 500000.0
    assert got[3].a_step > 0 and got[3].b_low <= -2 <= got[3].b_high
    bands = charts.bands(df.withColumn("c", F.col("b") + 1), "g", F.col("a"), "b", "b", "c")
    assert bands.count() == 9 and {r.line for r in bands.collect()} == {"median", "low", "high"}
