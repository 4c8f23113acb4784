"""Stages on seeded telemetry, end to end runs, configuration and sources."""

import json
from dataclasses import asdict
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests.fixtures import COLUMNS, c_nom_rows, raw_rows
from voltarc import cli
from voltarc.config import Found, ampere_hours, found_of, load_config, ocv_curve, validate_curve
from voltarc.operators import anchor, capacity, clean, monthly, profile, quality, retirement, soh, trend, validation
from voltarc.plans.pipeline import Pipeline, html_table, scored_anchors
from voltarc.sources import telemetry
from voltarc.streaming.monthly import maintain_months, rest_sessions

CFG = load_config({"c_nom_spec": 40.0, "exclude": {"soh_low_ratio": 0.001}}, found=Found("NMC", 21, "DYNAMIC", "ABSOLUTE", 88.2, 63.0))


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(raw_rows(), COLUMNS).cache()


@pytest.fixture(scope="module")
def labelled(raw):
    return anchor.run(clean.run(raw, CFG), CFG).cache()


@pytest.fixture(scope="module")
def points(spark, labelled):
    return capacity.run(labelled, spark.createDataFrame(c_nom_rows(), "channel string, device_id bigint, c_nom_bms double"), CFG).cache()


@pytest.fixture(scope="module")
def scored(points):
    return quality.run(points, CFG).cache()


def test_anchors(labelled):
    got = {r.anchor_type: r for r in labelled.groupBy("anchor_type").agg(F.count("*").alias("n"), F.min("soc_anchor").alias("low"), F.max("soc_anchor").alias("high")).collect()}
    assert {"FULL_END", "SWAP_FULL", "EMPTY_END", "OCV", "NONE"} == set(got)
    assert got["SWAP_FULL"].low == got["SWAP_FULL"].high == 1.0 and got["NONE"].high is None and got["EMPTY_END"].low >= 0.02 and got["OCV"].high <= 0.98


def test_type_and_charge_have_their_own_precedence(spark):
    from datetime import datetime, timedelta

    t = datetime(2024, 1, 1)
    rows = [("s", 1, "c", 0.0, 38.0, 0.96, 88.0, 0.1, 25.0, t + timedelta(hours=k)) for k in range(4)]
    got = anchor.run(clean.run(spark.createDataFrame(rows, COLUMNS), load_config({"anchor": {"deadband_a": 0.0}}, found=CFG.found)), CFG).orderBy("ts").collect()
    last = got[-1]
    assert last.anchor_type in ("FULL_END", "OCV") and last.soc_anchor <= 0.98


def test_capacity(points):
    assert points.where("anchor_type = 'NONE'").count() == 0
    assert points.where("abs(capacity_raw - remaining_ah / soc_anchor) > 1e-9 OR abs(capacity_corrected - capacity_raw) > 1e-9").count() == 0
    low, high = points.where("anchor_type = 'SWAP_FULL'").agg(F.min("capacity_corrected"), F.max("capacity_corrected")).first()
    assert 35 < low <= high < 41


def test_quality(spark, points, scored):
    assert scored.where("cap_tier = 1 AND severe").count() == 0 and scored.where("cap_tier = 3 AND stat_weight <> 0").count() == 0
    assert scored.where("anchor_type = 'SWAP_FULL' AND cap_tier = 1 AND quality_score >= 30").count() > 0
    first = points.where("anchor_type = 'SWAP_FULL'").orderBy("device_id", "ts").offset(3).limit(1).select("device_id", "ts").first()
    doubled = points.withColumn("capacity_corrected", F.when((F.col("device_id") == first.device_id) & (F.col("ts") == F.lit(first.ts)), F.col("capacity_corrected") * 2).otherwise(F.col("capacity_corrected")))
    hit = quality.run(doubled, CFG).where((F.col("device_id") == first.device_id) & (F.col("ts") == F.lit(first.ts))).first()
    assert hit.f_contradiction and hit.cap_tier != 1


def test_months_soh_and_forecast(scored):
    table = monthly.aggregate(scored)
    rows = table.collect()
    assert rows and len({(r.device_id, r.ym) for r in rows}) == len(rows) and all(r.capacity_count >= 3 and r.tier1_count + r.tier2_count == r.capacity_count for r in rows)
    assert monthly.aggregate(scored, from_month="2024-05").where("ym < '2024-05'").count() == 0
    smooth = soh.run(table, CFG).orderBy("device_id", "ym").collect()
    for a, b in zip(smooth, smooth[1:], strict=False):
        assert a.device_id != b.device_id or a.soh >= b.soh - 1e-9
    assert all(0.9 < r.soh <= 1.0001 for r in smooth)


def line(spark, values, first=1, channel="c", device=1):
    return spark.createDataFrame([(channel, device, f"2024-{m:02d}", v, v * 40, float(m), "m", 3) for m, v in enumerate(values, first)], "channel string, device_id bigint, ym string, soh double, capacity_median double, loop_median double, model string, capacity_count bigint")


def test_decay_and_retirement(spark):
    falling = line(spark, [1.0 - 0.01 * k for k in range(6)])
    d = trend.decay(falling).first()
    assert d.decay_rate_pct_month == -1.0 and d.r_squared > 0.99 and d.decay_rate_pct_year == -12.0
    r = retirement.forecast(falling, CFG).first()
    assert r.predicted_retire_month == "2025-09" and r.retire_ci_low <= "2025-09" <= r.retire_ci_high and r.health_level == "健康" and r.note == ""
    assert trend.decay(line(spark, [1.0, 0.9])).first().decay_rate_pct_month is None
    short, flat = retirement.forecast(line(spark, [1.0, 0.9]), CFG).first(), retirement.forecast(line(spark, [1.0] * 4), CFG).first()
    assert short.note == "数据不足" and flat.predicted_retire_month is None and flat.note == "无衰退趋势（R²低）" and flat.r_squared == 0.0


def test_exclusions_are_null_safe(spark):
    low = line(spark, [0.5, 0.4], channel=None, device=7)
    both = low.unionByName(line(spark, [0.95, 0.5], device=8))
    gone = trend.exclusions(both, 0.9)
    assert [(r.device_id, r.reasons, r.soh_second_reliable) for r in gone.collect()] == [(7, "bms_swap", 0.4)]
    assert {r.device_id for r in trend.without(both, gone).collect()} == {8}
    assert [r.alert_type for r in trend.drop_alerts(both).collect()] == ["SOH月跌幅异常"] * 2


def flat_r(spark, fall=0.0):
    import random
    from datetime import datetime, timedelta

    rng, t = random.Random(2), datetime(2024, 1, 1)
    rows = []
    for d in range(2):
        for j in range(300):
            s = round(rng.uniform(0.3, 0.7), 4)
            rows.append(("s", 11000000 + 25 * d, "c", 0.0, round((38 - fall * j) * s, 3), s, 70.0, -10.0, 25.0, t + timedelta(hours=j)))
    return spark.createDataFrame(rows, COLUMNS)


def test_profile_says_when_it_has_too_few_rows(spark):
    few = flat_r(spark).where("device_id = 11000000").limit(10)
    found = profile.decide(few, load_config())
    assert found.unsure == ("r_mode", "chemistry", "route") and found_of(json.loads(json.dumps(asdict(found)))) == found
    assert profile.decide(flat_r(spark), CFG, 2).unsure == () and profile.decide(few.limit(0), load_config()).unsure == ("r_mode", "chemistry", "route", "current_effectively_missing")
    rows = spark.createDataFrame([(88.0, 62.0), (70.0, 48.0), (91.0, 66.0)], "a double, b double")
    for r in rows.withColumn("s", profile.infer_series(F.col("a"), F.col("b"), CFG, profile.FLEET_SERIES)["series"]).collect():
        assert profile.nearest_series(r.a, r.b, CFG, profile.FLEET_SERIES) == r.s


def test_profile_routes(spark):
    constant = profile.decide(telemetry.sampled(flat_r(spark)), CFG)
    assert (constant.r_mode, constant.route) == ("CONSTANT", "L2_TREND")
    falling = profile.decide(flat_r(spark, 0.01), CFG)
    assert (falling.r_mode, falling.route) == ("DYNAMIC", "ABSOLUTE")


def test_configuration():
    with pytest.raises(ValueError, match="v_full"):
        load_config({"chemistry": {"LFP": {"v_full": 60.0, "v_cutoff": 65.0}}})
    with pytest.raises(ValueError, match="soc"):
        load_config({"anchor": {"soc_empty": 0.97}})
    assert load_config({"soh": {"mad_window": 5}}, {"soh": {"mad_window": 9, "mad_threshold": 2.0}}).get("soh.mad_window") == 5
    assert CFG.get("no.such", 1) == 1 and CFG.rest_current() == pytest.approx(0.8) and CFG.anchor_score("OCV") == 10 and ampere_hours("37Ah") == 37.0
    for wrong in ({"anchor": {"zero_frac": 0.5}}, {"no_such_table": {}}, {"quality": {"score": {"OVC": 1.0}}}, {"quality": {"severe_flags": ["odd"]}}):
        with pytest.raises(ValueError):
            load_config(wrong)
        with pytest.raises(ValueError):
            load_config(None, wrong)
    file = {"anchor": {"current_zero_frac_limit": 0.8, "current_near_zero_a": 2.0}, "selfcheck": {"r_cv_dynamic": 0.1, "r_slope_eps": 0.1, "neg_loopnum_frac": 0.1}, "monitoring": {"channel_anchor_rate_drop_mom": 0.1}, "quality": {"severe_flags": ["contradiction"]}}
    assert all(load_config(None, file).get(f"{a}.{b}") == v for a, own in file.items() for b, v in own.items())
    named = load_config({"chemistry": "NMC", "series": 20, "device_filter": "x.csv", "channels": None})
    assert (named.chemistry, named.series, named.get("channels")) == ("NMC", 20, []) and load_config({"chemistry": {"LTO": {"v_full": 60.0, "v_cutoff": 40.0, "alpha": 0.1}}}).chem_params("LTO")
    validate_curve(*ocv_curve("LFP"))
    with pytest.raises(ValueError, match="fall"):
        validate_curve([0.0, 0.2, 0.5, 0.8, 1.0], [3.0, 3.9, 3.5, 4.0, 4.1])
    assert cli.steps("3-7") == (3, 7) and cli.steps("2") == (2, 2)


def test_ocv_tables_of_a_user(spark, raw, labelled, tmp_path):
    soc, volts = ocv_curve("NMC")
    lines = ["ocv_v,soc"] + [f"{v},{k}" for k, v in zip(soc, volts, strict=True)][::-1]  # columns and rows in any order
    (tmp_path / "nmc_21s.csv").write_text("\n".join(lines))
    own = load_config(found=CFG.found, ocv_dir=str(tmp_path))
    assert own.ocv_curve() == (soc, volts) and own.ocv_curve("LFP", 24) == ocv_curve("LFP")
    (tmp_path / "nmc_20s.csv").write_text("soc,ocv_v\n0,3\n0.25,3.3\n0.5,3.6\n0.75,3.5\n1,4.2\n")
    with pytest.raises(ValueError, match="fall"):
        own.ocv_curve("NMC", 20)
    (tmp_path / "lfp.csv").write_text("soc,volts\n0,3\n")
    with pytest.raises(ValueError, match="ocv_v"):
        own.ocv_curve("LFP", 16)
    with pytest.raises(FileNotFoundError):
        ocv_curve("LTO")
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "nmc_21s.csv").write_text("soc,ocv_v\n" + "".join(f"{k / 10},{3 + 0.12 * k}\n" for k in range(11)))
    line = load_config(found=CFG.found, ocv_dir=str(tmp_path / "b"))
    got = anchor.run(clean.run(raw, line), line).where("anchor_type = 'OCV'").select("soc_anchor", "voltage").first()
    assert got.soc_anchor == pytest.approx(min(0.98, max(0.02, (got.voltage / 21 - 3) / 1.2)))


def test_turned_devices_come_as_a_table(spark, raw):
    turned = raw.select("device_id").distinct().where("device_id % 2 = 0")
    a, b = clean.run(raw, CFG, turned), clean.run(raw, load_config(found=Found("NMC", 21, "DYNAMIC", "ABSOLUTE", 88.2, 63.0, (11000002,))))
    assert sorted(map(str, a.select(sorted(a.columns)).collect())) == sorted(map(str, b.select(sorted(b.columns)).collect()))
    signed = raw.withColumn("current", F.when(F.col("device_id") == 11000002, -F.col("current")).otherwise(F.col("current")))
    assert [r.device_id for r in profile.reversed_devices(signed.where("hour(ts) % 2 = 0")).collect()] == [11000002]


def test_ledger(spark, tmp_path):
    book = telemetry.Ledger(spark, f"{tmp_path}/progress")
    assert book.state().count() == 0
    rows = spark.createDataFrame([("c", 1, "2024-01"), ("c", 1, "2024-01"), ("c", 2, "2024-01")], "channel string, device_id bigint, ym string")
    book.mark(rows, "s", "open")
    book.mark(rows.where("device_id = 1"), "s")
    assert [r.device_id for r in book.done("s").collect()] == [1] and [tuple(r) for r in book.pending("s").collect()] == [("c", 2, "2024-01")]
    book.mark(spark.range(3, 4).withColumnRenamed("id", "device_id"), "s")
    assert {(r.channel, r.device_id, r.ym) for r in book.done("s").collect()} == {("c", 1, "2024-01"), ("ALL", 3, "ALL")} and book.done("other").count() == 0


def test_models_must_be_known_and_one_a_device(spark, raw):
    models = raw.select("device_id").distinct().withColumn("model", F.lit("X1"))
    telemetry.require_models(raw, models)
    with pytest.raises(ValueError, match="11000003"):
        telemetry.require_models(raw, models.where("device_id < 11000003"))
    with pytest.raises(Exception, match="two models of device 11000001"):
        telemetry.model_map(models.unionByName(spark.createDataFrame([(11000001, "X2")], "device_id bigint, model string"))).collect()


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Final Plan")[-1].count("Exchange hashpartitioning")


def test_intermediate_tables(spark):
    from voltarc import session

    table = session.settle(spark.range(5), "t")
    assert table.count() == 5
    session.unsettle(table)
    with pytest.raises(Exception, match="(?i)file|path"):
        table.where("id > 1").count()
    session.unsettle(spark.range(3))  # not settled: nothing to delete
    with session.scope() as kept:
        inner = session.settle(spark.range(4), "inner")
        kept.append(session.settle(inner.where("id > 1"), "outer"))
    assert kept[0].count() == 2 and set(session._SETTLED) & {inner._voltarc_path, kept[0]._voltarc_path} == {kept[0]._voltarc_path}
    with pytest.raises(ZeroDivisionError), session.scope() as failed:
        failed.append(session.settle(spark.range(4), "failed"))
        1 / 0
    assert failed[0]._voltarc_path not in session._SETTLED
    session.unsettle(kept[0])
    assert session.quoted("a.b`c") == "`a.b``c`" and spark.range(1).withColumnRenamed("id", "a.b").select(*session.all_columns(spark.range(1).withColumnRenamed("id", "a.b"))).columns == ["a.b"]
    for master, named, good in (("local[4]", None, True), ("local", None, True), ("local-cluster[2,1,512]", None, False), ("yarn", None, False), ("yarn", "hdfs://x/y/", True)):
        conf = SimpleNamespace(get=lambda *_, named=named: named)
        other = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(getConf=lambda conf=conf: conf, master=master, applicationId="test"))
        if good:
            assert session.shared_dir(other).startswith("hdfs://x/y" if named else "file:/")
        else:
            with pytest.raises(RuntimeError, match="checkpoint"):
                session.shared_dir(other)


def test_plans(spark, raw, tmp_path):
    """What is pruned, and how often rows move."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        telemetry.prepare(raw, f"{tmp_path}/buckets")
        some = telemetry.scan(spark, f"{tmp_path}/buckets", spark.createDataFrame([(11000001,)], "device_id bigint"))
        plan = some._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [bucket" in plan.replace("isnotnull(bucket", "bucket") and some.count() == 1920 and "bucket" not in some.columns
        raw.withColumn("cap_tier", F.lit(1)).withColumn("capacity_corrected", F.lit(1.0)).withColumn("stat_weight", F.lit(1.0)).withColumn("quality_score", F.lit(1.0)).withColumn("c_nom_bms", F.lit(1.0)).withColumn("ym", F.date_format("ts", "yyyy-MM")).write.partitionBy("ym").parquet(f"{tmp_path}/observation")
        plan = monthly.aggregate(spark.read.parquet(f"{tmp_path}/observation"), from_month="2024-05")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(ym" in plan
        df = clean.run(telemetry.dedup(telemetry.coerce(raw).repartition("device_id")), CFG)
        assert exchanges(anchor.run(df, CFG)) == 1
        series = spark.read.parquet(f"{tmp_path}/observation").groupBy("channel", "device_id", "ym").agg(F.avg("soc").alias("soh"))
        assert exchanges(trend.analysis(series, CFG)) <= 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_sources(spark, raw, tmp_path):
    wire = telemetry.to_wire(raw.withColumn("extra", F.lit(1))).withColumn("循环次数", F.lit("x"))
    wire.write.parquet(f"{tmp_path}/raw")
    back = telemetry.scan(spark, f"{tmp_path}/raw", spark.createDataFrame([(11000001,)], "device_id bigint"))
    assert back.count() == 1920 and back.columns[0] in ("device_id", "extra") and back.where("loop_count IS NOT NULL").count() == 0
    with pytest.raises(telemetry.SchemaError):
        telemetry.require(raw.drop("soc"))
    twice = raw.unionByName(raw)
    assert telemetry.dedup(twice).count() == raw.count()
    assert not telemetry.is_ready(spark, f"{tmp_path}/buckets")
    telemetry.prepare(raw, f"{tmp_path}/buckets", channels=["TEST"])
    assert telemetry.is_ready(spark, f"{tmp_path}/buckets") and telemetry.scan(spark, f"{tmp_path}/buckets").count() == raw.count()
    nanos = spark.createDataFrame([(1, 1_700_000_000_123_456_789)], "device_id bigint, ts bigint")
    assert str(telemetry.coerce(nanos).first().ts) == "2023-11-14 22:13:20.123456"
    checks = validation.telemetry_checks(raw.withColumn("voltage", F.lit(10.0))).first()
    assert checks.voltage_out == raw.count() and checks.null_soc == 0.0
    assert validation.summarize(spark, [{"a": 1}, {"b": "x"}]).columns == ["a", "b"]
    progress = spark.createDataFrame([("s", 1, "done"), ("s", 2, "open")], "step string, device_id bigint, status string")
    assert [r.device_id for r in telemetry.pending(spark.range(1, 4).withColumnRenamed("id", "device_id"), progress, "s").orderBy("device_id").collect()] == [2, 3]


def test_pipeline_end_to_end(spark, raw, tmp_path):
    raw.write.parquet(f"{tmp_path}/raw")
    models = raw.select("device_id").distinct().withColumn("model", F.lit("X1"))
    p = Pipeline(spark, CFG, f"{tmp_path}/raw", f"{tmp_path}/out", models)
    made = p.run(1, 8)
    assert {"observation", "monthly_capacity", "soh_analysis", "soh_plot", "soh_alert", "dashboard", "retirement_forecast", "model_trend", "retire_schedule"} <= set(made)
    assert made["soh_analysis"].select("device_id").distinct().count() == 3
    before = sorted(map(tuple, made["monthly_capacity"].select("device_id", "ym", "capacity_median").collect()))
    Pipeline(spark, CFG, f"{tmp_path}/raw", f"{tmp_path}/out", models).run(1, 5, from_month="2024-06")
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out/monthly_capacity").select("device_id", "ym", "capacity_median").collect())) == before
    assert {"kpis", "fleet_levels", "model_desc", "model_loop_axis", "model_soh80", "model_age_ticks", "model_loop_ticks", "retire_quarters", "r_drift_verdict", "full_vs_empty"} <= set(made)
    assert made["fleet_levels"].count() == 1 and made["kpis"].count() == 1 and made["model_desc"].first()["c_nom"] == 40.0
    report = spark.read.option("header", "true").csv(f"{tmp_path}/out/reports/by_model/model_trend")
    assert report.where("model = 'X1'").count() == made["model_trend"].count() > 0 and (tmp_path / "out/reports/all/kpis").exists()
    assert p.ledger.done("step1_5").count() == len(before)
    assert "<td>TEST</td>" in html_table(made["dashboard"], "x")
    assert "1 of 12 rows" in html_table(spark.range(12), "x", 1) and "rows;" not in html_table(spark.range(12), "x")
    dry = Pipeline(spark, CFG, f"{tmp_path}/raw", f"{tmp_path}/dry", dry_run=True)
    dry.run(1, 8)
    assert not (tmp_path / "dry").exists()
    with pytest.raises(ValueError, match="steps"):
        p.run(5, 9)


def test_command_line(spark, raw, tmp_path, monkeypatch):
    raw.write.parquet(f"{tmp_path}/raw")
    (tmp_path / "models.csv").write_text("电池id,电池型号\n11000001,X1\n11000002,X1\n11000003,X2\n", encoding="utf-8")
    (tmp_path / "thresholds.json").write_text('{"soh": {"min_anchors_per_month": 2}}')
    (tmp_path / "settings.json").write_text('{"chemistry": "NMC", "series": 21, "c_nom_spec": 40.0, "exclude": {"soh_low_ratio": 0.001}}')
    out = f"{tmp_path}/out"
    cli.main(["--source", f"{tmp_path}/raw", "--out", out, "--settings", f"{tmp_path}/settings.json", "--thresholds", f"{tmp_path}/thresholds.json", "--models", f"{tmp_path}/models.csv"])
    assert (tmp_path / "out/buckets/_layout/_SUCCESS").exists()  # written by itself
    from voltarc.config import read_settings

    assert read_settings(tmp_path / "out/profile/settings.json") == {"chemistry": "NMC", "series": 21}
    later = Pipeline(spark, load_config(), f"{out}/buckets", out)
    later.recall()
    assert later.cfg.chemistry == "NMC" and later.cfg.found.unsure == () and later.turned.count() == 0
    assert Pipeline(spark, CFG, out, f"{tmp_path}/none").recall() is None
    assert "<table>" in (tmp_path / "out/pages/dashboard.html").read_text() and (tmp_path / "out/pages/lagging_devices.html").exists()
    assert spark.read.parquet(f"{out}/device_charts").where("shown > 120 OR shown > n").count() == 0 and spark.read.parquet(f"{out}/profile/devices").count() > 0
    assert {"model_loop_cap", "model_milestones", "model_scales", "model_chart_age"} <= {p.name for p in (tmp_path / "out/reports/all").iterdir()}
    assert spark.read.parquet(f"{out}/soh_analysis").select("model").distinct().count() == 2 and spark.read.parquet(f"{out}/reversed_devices").count() == 0


def test_streams(spark, raw, tmp_path):
    nominal = spark.createDataFrame(c_nom_rows(), "channel string, device_id bigint, c_nom_bms double")
    whole = scored_anchors(raw, nominal, CFG)
    whole.where("ts < '2024-04-15'").coalesce(1).write.parquet(f"{tmp_path}/in/a")
    whole.where("ts >= '2024-04-15'").coalesce(1).write.parquet(f"{tmp_path}/in/b")
    stream = spark.readStream.schema(whole.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    q = maintain_months(stream, f"{tmp_path}/history", f"{tmp_path}/months", CFG, f"{tmp_path}/check", {"availableNow": True})
    q.awaitTermination()
    key = ["device_id", "ym", "capacity_median"]
    got = sorted(map(tuple, spark.read.parquet(f"{tmp_path}/months").select(*key).collect()))
    assert got == sorted(map(tuple, monthly.aggregate(whole).select(*key).collect()))
    sessions = rest_sessions(clean.run(raw, CFG), lambda: F.abs("current") < 0.8)
    assert sessions.agg(F.max("n")).first()[0] == 40
