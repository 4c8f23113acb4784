"""Kernels on vectors with known answers, and against plain versions."""

import random
from datetime import datetime, timedelta

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from voltarc.config import load_config
from voltarc.functions import series, stats
from voltarc.operators import cohort, retirement, trend
from voltarc.plans.queries import nine_digits


def test_weighted_median(spark):
    rows = [("a", v, w) for v, w in zip([1.0, 2.0, 3.0, 4.0, 100.0], [1.0, 1.0, 1.0, 1.0, 0.01], strict=True)] + [("b", 5.0, 0.0), ("b", 7.0, 0.0), ("c", 1.0, 1.0), ("c", None, 9.0)]
    got = {r.k: r.weighted_median for r in stats.weighted_median(spark.createDataFrame(rows, "k string, v double, w double"), ["k"], "v", "w").collect()}
    assert got == {"a": 3.0, "b": 6.0, "c": 1.0}


def test_mad_keep(spark):
    rows = [("a", k, 30.0 if k == 10 else 10.0) for k in range(20)] + [("b", 0, 1.0), ("b", 1, 99.0)] + [("c", k, float(k)) for k in range(5)] + [("c", 9, 1000.0)]
    got = stats.mad_keep(spark.createDataFrame(rows, "k string, i int, v double"), ["k"], "v", 3.0).collect()
    assert all(r.keep for r in got if r.k in "ab") and [r.i for r in got if r.k == "c" and not r.keep] == [9]


def test_rolling_mad_flags_a_spike(spark):
    rows = [("a", k, 30.0 if k == 10 else 10.0) for k in range(20)]
    got = series.rolling_mad(spark.createDataFrame(rows, "k string, i int, v double"), ["k"], "i", "v", 7, 3.0).collect()
    assert [r.i for r in got if r.is_spike] == [10] and all(r.cleaned == 10.0 for r in got)
    noise = np.random.default_rng(1).normal(40, 0.1, 50)
    got = series.rolling_mad(spark.createDataFrame([("a", k, float(v)) for k, v in enumerate(noise)], "k string, i int, v double"), ["k"], "i", "v", 7, 3.0)
    assert got.where("is_spike").count() <= 4


def pool(v, w):
    blocks = []
    for x, y in zip(v, w, strict=True):
        blocks.append([x * y, y, 1])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] < blocks[-1][0] / blocks[-1][1]:
            b = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], b, strict=True)]
    return [b[0] / b[1] for b in blocks for _ in range(b[2])]


def test_pava(spark):
    rng = random.Random(3)
    cases = [([1.0, 2.0], [3.0, 1.0]), ([1.0, 3.0, 2.0, 5.0, 4.0], [1.0] * 5), ([2.0], [1.0])]
    cases += [([round(rng.uniform(0, 10), 2) for _ in range(n)], [float(rng.randint(1, 5)) for _ in range(n)]) for n in (2, 5, 12, 40)]
    df = spark.createDataFrame([(k, v, w) for k, (v, w) in enumerate(cases)], "k int, v array<double>, w array<double>")
    got = {r.k: r.y for r in df.select("k", series.pava(F.col("v"), F.col("w")).alias("y")).collect()}
    assert got[0] == [1.25, 1.25]
    for k, (v, w) in enumerate(cases):
        assert got[k] == pytest.approx(pool(v, w)) and all(a >= b - 1e-12 for a, b in zip(got[k], got[k][1:], strict=False))
        assert sum(a * b for a, b in zip(got[k], w, strict=True)) == pytest.approx(sum(a * b for a, b in zip(v, w, strict=True)))


def test_rest_runs_equal_a_plain_version(spark):
    rng = random.Random(4)
    at, rows = datetime(2024, 1, 1), []
    for k in range(300):
        at += timedelta(seconds=rng.choice([60, 1800, 3600, 6 * 3600, 6 * 3600 + 1]))
        rows.append((1 + k % 2, at, rng.choice([0.0, 0.0, 0.0, 5.0, None])))
    df = spark.createDataFrame(rows, "device_id bigint, ts timestamp_ntz, current double")
    got = {(r.device_id, r.ts): (r.is_rest, r.rest_s, r.run_end) for r in series.rest_runs(df, "device_id", "ts", F.abs("current") < 0.8, 21600, 7200).collect()}
    for d in (1, 2):
        own = [r for r in rows if r[0] == d]
        rest = [(i is not None and abs(i) < 0.8) and (k == 0 or (t - own[k - 1][1]).total_seconds() <= 21600) for k, (_, t, i) in enumerate(own)]
        began = None
        for k, (_, t, _) in enumerate(own):
            began = (t if not rest[k - 1] or k == 0 else began) if rest[k] else None
            length = (t - began).total_seconds() if rest[k] else 0
            end = rest[k] and length >= 7200 and not (k + 1 < len(own) and rest[k + 1])
            assert got[d, t] == (rest[k], length, end)


def test_nearest_quantile_interpolation_and_months(spark):
    df = spark.createDataFrame([(float(k),) for k in range(1, 8)] + [(None,)], "v double")
    r = df.agg(*[stats.nearest_quantile(F.col("v"), q).alias(f"q{int(q * 100)}") for q in (0.1, 0.25, 0.5, 0.9)]).first()
    assert tuple(r) == (2.0, 3.0, 4.0, 6.0)
    xs, ys = [0.0, 1.0, 3.0], [10.0, 20.0, 0.0]
    at = [-1.0, 0.0, 0.25, 1.0, 2.0, 3.0, 9.0]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in [*at, None]], "v double").select(stats.interpolated(F.col("v"), xs, ys)).collect()]
    assert got == pytest.approx([*np.interp(at, xs, ys), None])
    got = spark.createDataFrame([("2024-12",), ("2024-01",)], "ym string").select("ym", series.month_text(series.month_index("ym")).alias("b")).collect()
    assert all(r.ym == r.b for r in got)


def test_forecasts_of_any_year_stay_outside_the_window(spark):
    texts = ["2024-12", "2024-1", "10113-10", "24000-01", "178956971-01", "3000000000-07", "999-05", "0-01", "-5-03", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "ym string").select(series.month_index("ym", "long")).collect()]
    assert got == [24300, 24289, 121366, 288001, 2147483653, 36000000007, 11993, 1, -57, None]
    back = spark.createDataFrame([(k,) for k in got[:-1]], "mi bigint").select(series.month_text(F.col("mi"))).collect()
    assert [r[0] for r in back] == ["2024-12", "2024-01", *texts[2:-1]]
    # straight lines that meet 0.8 in years 10083, 20070 (whose first four digits lie in the window) and, too far for an integer, 4166667019
    falls = {1: 0.4 / 100000, 2: 0.4 / 220000, 3: 8e-12, 4: 0.02}
    months = [(d, "m", f"2000-{k:02d}", 1.2 - falls[d] * (k - 1), falls[d] * -100, falls[d] * -1200) for d in falls for k in (1, 2, 3, 4, 5)]
    t = spark.createDataFrame([(d, "c", m, ym, y, a, b) for d, m, ym, y, a, b in months], "device_id bigint, channel string, model string, ym string, soh double, decay_rate_pct_month double, decay_rate_pct_year double")
    found = cohort.retire_months(retirement.forecast(t, load_config()), t)
    want = {1: 124001, 2: 244001, 4: 24021}
    at = {r.device_id: r.retire_mi for r in found.collect()}
    assert {d: at[d] for d in want} == want and at[3] == pytest.approx(24001 + 0.4 / 8e-12, rel=1e-3)
    today = 2001 * 12 + 1
    assert tuple(cohort.outside(found, today).first()) == ("m", 3, 0)
    assert [(r.mi, r.new_retire, r.ym) for r in cohort.schedule(found, today).collect() if r.new_retire] == [(24021, 1, "2001-09")]


def test_trim_crossing_and_mode(spark):
    s = "k string, ym string, v double"
    low = [("a", f"2024-0{m}", v) for m, v in enumerate([0.5, 0.6, 0.95, 0.93], 1)] + [("b", "2024-01", 0.5), ("b", "2024-02", 0.6)] + [("c", "2024-01", 0.95), ("c", "2024-02", 0.5)]
    got = series.leading_trim(spark.createDataFrame(low, s), ["k"], "ym", F.col("v"), 0.9).groupBy("k").count().collect()
    assert {r.k: r["count"] for r in got} == {"a": 2, "b": 2, "c": 2}
    line = spark.createDataFrame([("a", float(k), v) for k, v in enumerate([1.0, 0.9, 0.7, 0.9])] + [("b", 0.0, 0.9)], "k string, x double, y double")
    assert [(r.k, r.x_cross) for r in series.crossing(line, ["k"], "x", "y", 0.8).collect()] == [("a", pytest.approx(1.5))]
    bins = spark.createDataFrame([("a", v) for v in (1.1, 1.2, 3.6, 3.7, 9.0)] + [("b", None)], "k string, v double")
    assert [tuple(r) for r in stats.binned_mode(bins, ["k"], F.col("v"), 0.5).collect()] == [("a", 1.25, 5)]


def test_quantiles_by_counting(spark):
    """Ranks found by counting equal those of sorted values; large and small groups, ties, signs, extremes, nulls."""
    import random
    import statistics

    from voltarc.functions import ranks

    rng = random.Random(4)
    pick = [0.0, -0.0, 1.5, -2.25, float("inf"), -1e300]
    rows = [(rng.choice([None, "a", "b"]), rng.choice([*pick, rng.gauss(0, 1), rng.gauss(0, 1e-300)]), rng.randrange(10)) for _ in range(1500)] + [("c", None, 3), ("d", 1.0, None)]
    df = spark.createDataFrame(rows, "k string, v double, i int")
    wants = {"m": ("v", None), "p10": ("v", 0.1), "p90": ("i", 0.9), "im": ("i", None), "p0": ("v", 0.0), "p100": ("v", 1.0)}
    got = {r.k: r for r in ranks.quantiles(df, ["k"], wants).collect()}
    for k in (None, "a", "b", "c", "d"):
        v, i = (sorted(r[c] for r in rows if r[0] == k and r[c] is not None) for c in (1, 2))
        near = [x and x[int((len(x) - 1) * q + 0.5)] if x else None for x, q in ((v, 0.1), (i, 0.9), (v, 0.0), (v, 1.0))]
        assert (got[k].m, got[k].im, got[k].p10, got[k].p90, got[k].p0, got[k].p100) == (statistics.median(v) if v else None, statistics.median(i) if i else None, *near)
    both = ranks.aggregate(df, ["k"], wants, F.count("*").alias("n"), most=3)  # some groups are counted, some held
    one = ranks.aggregate(df, ["k"], wants, F.count("*").alias("n"))
    assert both.columns == one.columns
    same = [sorted(str([x + 0.0 if isinstance(x, float) else x for x in r]) for r in df_.collect()) for df_ in (both, one)]  # a zero has no sign here
    assert same[0] == same[1]
    assert ranks.aggregate(df, [], {"m": ("i", None)}, most=3).collect() == ranks.aggregate(df, [], {"m": ("i", None)}).collect()
    assert ranks.aggregate(df.limit(0), ["k"], wants).collect() == []
    plan = ranks.quantiles(df, ["k"], wants)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan.lower() for x in ("collect_list", "percentile", "median"))


def test_ratio_over_an_empty_median_of_zero(spark):
    """Full over empty is infinite where the empty anchors hold nothing, not missing, and so full_high."""
    rows = [(d, kind, c) for d, full, empty in ((1, 40.0, 0.0), (2, 0.0, 0.0), (3, 40.0, 41.0), (4, 30.0, 40.0)) for kind, c in (("FULL_END", full), ("EMPTY_END", empty))]
    got = {r.device_id: (r.ratio, r.verdict) for r in trend.full_vs_empty(spark.createDataFrame(rows, "device_id long, anchor_type string, capacity_corrected double")).collect()}
    assert got[1] == (float("inf"), "full_high") and np.isnan(got[2][0]) and got[2][1] == "full_high"
    assert got[3][1] == "ok" and got[4] == (-0.25, "empty_high")


def test_a_share_that_is_a_tie_is_rounded_up(spark):
    """R squared of this two-level series is 0.5915 in exact arithmetic; its note says 0.592."""
    high, low = 36.52290907407408 / 37, 13.008466666666667 / 37
    months = [("1997-09", high), ("1997-10", high), ("1998-10", high), ("1998-12", high), ("2000-05", high), ("2000-07", low), ("2001-06", low)]
    table = spark.createDataFrame([("n6", 9383, ym, y) for ym, y in months], "channel string, device_id long, ym string, soh double").coalesce(1)
    got = retirement.forecast(table, load_config()).first()
    assert got.r_squared == 0.5915 and got.note.startswith("R²=0.592<0.6")


def test_a_share_that_is_a_tie_falls_as_in_the_sql(spark):
    """R squared is 0.21875 and 0.6 in exact arithmetic; the SQL's last bits put both just below."""
    flat, high, low = 1.2920477177177179, 1.258234174174174, 0.9657030180180181
    months = {1: [("1995-01", flat), ("1995-02", flat), ("1997-09", flat), ("1997-11", flat), ("1998-01", 0.7892044444444445)], 2: [("2000-12", high), ("2001-02", low), ("2001-04", low), ("2001-06", low)]}
    table = spark.createDataFrame([("n", d, "m", ym, y) for d, own in months.items() for ym, y in own], "channel string, device_id long, model string, ym string, soh double").coalesce(1)
    want = {}
    for d, own in months.items():
        pairs = ", ".join(f"({k}, {int(ym[:4]) * 12 + int(ym[5:])}::DOUBLE, {y!r}::DOUBLE)" for k, (ym, y) in enumerate(own))
        want[d] = duckdb.execute(f"SELECT round(regr_r2(y, x), 4) FROM (SELECT * FROM (VALUES {pairs}) t(k, x, y) ORDER BY k)").fetchall()[0][0]
    found = {r.device_id: r for r in retirement.forecast(table, load_config()).collect()}
    assert {d: r.r_squared for d, r in found.items()} == want == {1: 0.2187, 2: 0.6}
    assert found[2].note.startswith("R²=0.6<0.6")
    assert {r.device_id: r.r_squared for r in trend.analysis(table, load_config()).collect()} == want


def test_drift_within_a_day_is_not_a_number(spark):
    """As the SQL has it: enough anchors, but no slope to tell; fewer than four give no row."""
    at = datetime(2024, 1, 1)
    rows = [(1, at + timedelta(hours=k), 40.0 + k) for k in range(4)] + [(2, at + timedelta(days=k), 40.0 + k) for k in range(4)] + [(3, at + timedelta(days=k), 40.0) for k in range(3)]
    # a slope whose tenth digit tells how it is divided
    rows += [(4, at + timedelta(days=d), c) for d, c in ((0, 38.87499999999999), (7, 30.21937893141922), (8, 36.830000000000005), (19, 1299.5), (22, 14.989795918367347))]
    drift = trend.r_drift(spark.createDataFrame(rows, "device_id long, ts timestamp, capacity_raw double"))
    got = {r.device_id: r.slope for r in drift.collect()}
    assert set(got) == {1, 2, 4} and np.isnan(got[1]) and got[2] == pytest.approx(30.44) and round(got[4], 9) == 885.024817383
    assert trend.r_drift_verdict(drift).first().nonneg_share == 1.0


def test_nine_digits_are_those_of_the_sql(spark):
    values = [1788.6036631785, 435.69322362049996, -37.19195525649998, 0.0000000005, -2.5e-10, 1e300, 8e6, float("inf"), float("nan"), None]
    got = [r.v for r in spark.createDataFrame([(v,) for v in values], "v double").coalesce(1).select(nine_digits(F.col("v")).alias("v")).collect()]
    want = [duckdb.execute("SELECT round(?::DOUBLE, 9)", [v]).fetchall()[0][0] for v in values]
    assert str(got) == str(want)
