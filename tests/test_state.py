"""Bucketed tables, and runs over new rows alone."""

import re
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.fixtures import COLUMNS, raw_rows
from voltarc.config import Found, load_config
from voltarc.functions import series
from voltarc.operators import anchor, clean, profile, state
from voltarc.plans.pipeline import Pipeline, month_before, scored_anchors
from voltarc.sources import layout, telemetry

CFG = load_config({"c_nom_spec": 40.0, "exclude": {"soh_low_ratio": 0.001}}, found=Found("NMC", 21, "DYNAMIC", "ABSOLUTE", 88.2, 63.0))
BEGIN = datetime(2024, 1, 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def dealt_again(df):
    """Exchanges over a scan that isn't a small side's."""
    return len(re.findall(r"Exchange hashpartitioning\(device_id", plan_of(df)))


def restless(seed, devices=6, n=260):
    """Devices that rest most of the time, at currents near the limit, with gaps, missing sensors and an offset that drifts."""
    rng, out = np.random.default_rng(seed), []
    for d in range(devices):
        t = BEGIN + timedelta(hours=int(rng.integers(0, 600)))
        for _ in range(int(rng.integers(1, n))):
            t += timedelta(seconds=int(rng.choice([600, 1800, 3600, 21600, 21601, 30000], p=[0.4, 0.3, 0.2, 0.04, 0.03, 0.03])))
            i = float(np.round(rng.normal(0.3, 0.25), 2)) if rng.random() < 0.93 else float(rng.choice([6.0, -8.0, 0.79, -0.8]))
            v = None if rng.random() < 0.02 else float(np.round(rng.uniform(62, 89), 1))
            soc = float(rng.choice([0.05, 0.5, 0.97, 1.0]))
            out.append(("s", d, "c", 1.0, 38.0 * soc, soc, v, i, 25.0, t))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_new_rows_alone_give_the_anchors_of_all(spark, seed):
    raw = spark.createDataFrame(restless(seed), COLUMNS).repartition(3).cache()
    turned = [spark.createDataFrame([(k,) for k in ids], "device_id bigint") for ids in ((1,), (1, 2), (2, 3))]
    cuts = [BEGIN + timedelta(hours=h) for h in (250 + 40 * seed, 400, 401 + 100 * seed)]
    spans = [raw.where(lo & hi) for lo, hi in zip([F.lit(True), *(F.col("ts") >= F.lit(c) for c in cuts)], [*(F.col("ts") < F.lit(c) for c in cuts), F.lit(True)], strict=True)]
    known = None
    for span, signs in zip(spans[:-1], turned, strict=True):
        after = state.after(span, CFG, signs, known)
        known = spark.createDataFrame(after.collect(), after.schema)
    columns = ["device_id", "ts", "time_gap", "current", "current_sensor_drift"]

    def runs(rows, **more):
        return clean.run(rows, CFG, turned[-1], **more)

    def plain(rows):
        return sorted((r.device_id, r.ts, r.time_gap, round(r.current, 9), r.current_sensor_drift) for r in rows.select(*columns).collect())

    last = F.col("ts") >= F.lit(cuts[-1])
    whole, part = runs(raw), runs(spans[-1], state=known)
    assert plain(whole.where(last)) == plain(part)
    want, got = anchor.run(whole, CFG).where(last), anchor.run(part, CFG)
    assert want.columns == got.columns
    key = ["device_id", "ts", "anchor_type", "soc_anchor", "flags"]
    assert sorted(map(str, want.select(*key).collect())) == sorted(map(str, got.select(*key).collect()))
    assert want.where("anchor_type = 'OCV'").count() > 0
    assert known.agg(F.max(F.size("resting"))).first()[0] < 60


def test_an_open_run_goes_on(spark):
    """A run that began in the first span ends in the last, whatever the offset is by then."""
    rows = [("s", 1, "c", 1.0, 20.0, 0.5, 75.0, i, 25.0, BEGIN + timedelta(hours=k)) for k, i in enumerate([3.0, 0.7, 0.1, 0.1, 0.1, 0.1, 0.1])]
    raw = spark.createDataFrame(rows, COLUMNS)
    for cut in range(1, 7):
        known = state.after(raw.where(F.col("ts") < F.lit(BEGIN + timedelta(hours=cut))), CFG)
        part = clean.run(raw.where(F.col("ts") >= F.lit(BEGIN + timedelta(hours=cut))), CFG, state=known)
        assert [r.anchor_type for r in anchor.run(part, CFG).orderBy("ts").collect()] == [r.anchor_type for r in anchor.run(clean.run(raw, CFG), CFG).orderBy("ts").collect()][cut:]
    empty = state.after(raw.limit(0), CFG, state=state.after(raw, CFG))
    assert empty.collect() == state.after(raw, CFG).collect()


def test_bins_merge(spark):
    raw = spark.createDataFrame(raw_rows(2, 2), COLUMNS)
    half = F.col("ts") < F.lit(datetime(2024, 3, 9))
    merged = profile.merged_bins(profile.r_bins(raw.where(half)).unionByName(profile.r_bins(raw.where(~half))))
    assert sorted(map(tuple, profile.nominal(merged).collect())) == sorted(map(tuple, profile.c_nom(raw).collect()))


def test_bucketed_table(spark, tmp_path):
    rows = raw_rows(8, 2) + [("s", None, "c", 1.0, 1.0, 0.5, 70.0, 0.0, 25.0, BEGIN), ("s", 5, "c", 1.0, 1.0, 0.5, 70.0, 0.0, 25.0, None)]
    raw = spark.createDataFrame(rows, COLUMNS)
    path = f"{tmp_path}/b"
    written = layout.prepare(raw, path, buckets=4)
    table = layout.open_bucketed(spark, path)
    assert sorted(map(str, table.select(raw.columns).collect())) == sorted(map(str, raw.collect())) == sorted(map(str, written.select(raw.columns).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scan = telemetry.scan(spark, path)
        assert dealt_again(telemetry.dedup(scan)) == 0 and dealt_again(clean.run(telemetry.dedup(scan), CFG)) == 0
        runs = series.rest_runs(clean.run(telemetry.dedup(scan), CFG), "device_id", "ts", F.abs("current") < 1, 21600, 7200)
        assert dealt_again(runs) == 0
        both = layout.write_bucketed(scan.select("device_id").distinct(), f"{tmp_path}/d", order=(), buckets=4)
        assert dealt_again(table.join(both, "device_id")) == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    few = layout.of_keys(table, spark.createDataFrame([(11000003,), (None,), (7,)], "device_id bigint"))
    assert {r.device_id for r in few.collect()} == {11000003} and re.search(r"SelectedBucketsCount: [12] out of 4", plan_of(telemetry.dedup(few)))
    assert layout.of_keys(table, spark.createDataFrame([], "device_id bigint")).count() == 0
    many = spark.range(11000003, 11000003 + layout.MOST_PUSHED + 9).withColumnRenamed("id", "device_id")
    assert layout.of_keys(table, many).count() == raw.where("device_id >= 11000003").count()
    layout.replace_months(raw.where("device_id = 11000001").withColumn("ts", F.lit(datetime(2024, 9, 1))), path, "2024-04")
    assert layout.open_bucketed(spark, path).where("ym > '2024-03' AND ts IS NOT NULL").select("ym").distinct().collect() == [("2024-09",)]
    assert layout.write_bucketed(raw.limit(0), f"{tmp_path}/e").count() == 0 == layout.open_bucketed(spark, f"{tmp_path}/e").count()
    assert layout.bucket_count(spark, path, 1 << 10, 4) > 4 and layout.bucket_count(spark, path) == layout.LEAST_BUCKETS


def rows_read(df):
    """Rows that the scan of a finished query has given, after it has left out row groups and pages."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "AdaptiveSparkPlan" in plan.getClass().getName() else plan
    while plan.children().size():
        plan = plan.children().head()
    return plan.metrics().get("numOutputRows").get().value()


def test_row_groups_and_pages_are_left_out(spark, tmp_path):
    n = 40_000
    raw = spark.range(n).select(((F.col("id") * 7919) % 400 * 5).alias("device_id"), F.timestamp_seconds(F.col("id")).alias("ts"), F.rand(1).alias("x"))
    small = {"parquet.block.size": str(1 << 16), "parquet.page.row.count.limit": "500"}
    table = layout.write_bucketed(raw, f"{tmp_path}/p", buckets=2, files_with=small)
    one = layout.of_keys(table, spark.createDataFrame([(985,), (15,)], "device_id bigint"))
    assert one.count() == 2 * n // 400 and rows_read(one) < n / 10
    absent = layout.of_keys(table, spark.createDataFrame([(986,)], "device_id bigint"))  # within the bounds, in no file
    assert rows_read(absent) == 0


def test_run_from_a_month_reads_only_later_rows(spark, tmp_path):
    raw = spark.createDataFrame(raw_rows(2, 14), COLUMNS)
    raw = raw.withColumn("ts", F.col("ts") - F.when(F.col("device_id") == 11000002, F.expr("interval 2240 hours")).otherwise(F.expr("interval 0 hours")))
    months = sorted(r[0] for r in raw.select(F.date_format("ts", "yyyy-MM")).distinct().collect())
    cut = months[-2]
    early = raw.where(F.date_format("ts", "yyyy-MM") < cut)
    layout.prepare(raw, f"{tmp_path}/whole", buckets=2)
    want = Pipeline(spark, CFG, f"{tmp_path}/whole", f"{tmp_path}/a").run(1, 5)
    layout.prepare(early, f"{tmp_path}/grown", buckets=2)
    Pipeline(spark, CFG, f"{tmp_path}/grown", f"{tmp_path}/b").run(1, 5)
    layout.replace_months(raw, f"{tmp_path}/grown", cut)
    p = Pipeline(spark, CFG, f"{tmp_path}/grown", f"{tmp_path}/b")
    through, _ = p.state_before(cut)
    assert through == month_before(cut) and re.search(r"PartitionFilters: \[.*ym#\d+ > " + through, plan_of(p.raw(through)))
    got = p.run(1, 5, from_month=cut)
    columns = [c for c in want["observation"].columns if c != "source_table"]

    def plain(df):
        return sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in df.where(F.col("ym") >= cut).select(columns).collect())

    assert plain(got["observation"]) == plain(want["observation"]) and got["observation"].where(F.col("ym") < cut).count() == want["observation"].where(F.col("ym") < cut).count()
    again = Pipeline(spark, CFG, f"{tmp_path}/grown", f"{tmp_path}/b")
    assert again.state_before("2099-01")[0] == months[-1]
    other = load_config({"c_nom_spec": 40.0, "anchor": {"gap_hours": 5}}, found=CFG.found)
    assert Pipeline(spark, other, f"{tmp_path}/grown", f"{tmp_path}/b").state_before("2099-01") is None
    assert month_before("2024-01") == "2023-12" and month_before("2024-11") == "2024-10"


def test_bucketed_source_is_dealt_once(spark, tmp_path):
    layout.prepare(spark.createDataFrame(raw_rows(3, 2), COLUMNS), f"{tmp_path}/b", buckets=2)
    raw = telemetry.scan(spark, f"{tmp_path}/b")
    from voltarc.plans import pipeline

    assert dealt_again(anchor.run(clean.run(pipeline.with_models(raw, None, True), CFG), CFG)) == 0
    nominal = profile.c_nom(raw).select("channel", "device_id", "c_nom_bms")
    assert scored_anchors(raw, nominal, CFG, dealt=True).count() == scored_anchors(raw, nominal, CFG).count() > 0


#: Small currents whose sum has another last bit in another order.
CURRENTS = [0.1, 0.2, 0.3, -0.3, 0.1, 0.3, -0.1, 0.2, 0.3, -0.2, 0.1, 0.3]


def steady():
    return [("s", 1, "c", 1.0, 20.0, 0.5, 70.0, i, 25.0, BEGIN + timedelta(minutes=10 * k)) for k, i in enumerate(CURRENTS)]


def offset_in_time():
    total = 0.0
    for i in CURRENTS:
        total += i
    return total / len(CURRENTS)


def test_the_offset_is_summed_in_the_order_of_time(spark):
    """To the last bit, however the rows lie: the sign of a current at its device's offset hangs on it."""
    assert sum(CURRENTS[::-1]) / len(CURRENTS) != offset_in_time()
    for rows in (steady(), steady()[::-1]):
        got = clean.run(spark.createDataFrame(rows, COLUMNS).coalesce(1), CFG).orderBy("ts").collect()
        assert [r.current for r in got] == [i - offset_in_time() for i in CURRENTS]


@pytest.mark.parametrize("cut", [3, 7, 10])
def test_the_offset_after_a_state_is_that_of_a_whole_run_to_the_bit(spark, cut):
    parts = [spark.createDataFrame(rows[::-1], COLUMNS).coalesce(1) for rows in (steady()[:2], steady()[2:cut], steady()[cut:])]
    known = state.after(parts[1], CFG, state=state.after(parts[0], CFG))
    got = clean.run(parts[2], CFG, state=known).orderBy("ts").collect()
    assert [r.current for r in got] == [i - offset_in_time() for i in CURRENTS[cut:]]
