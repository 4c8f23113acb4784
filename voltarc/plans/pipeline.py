"""The steps wired together, writing what later steps and reports read.

Scored anchors are partitioned by month and the monthly layer by device bucket; both are replaced partition by partition,
so a run that is repeated, or begins at a later month, leaves the same tables.
"""

from __future__ import annotations

import hashlib
import json
import logging
from dataclasses import asdict, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config, found_of
from ..functions.series import month_index
from ..operators import anchor, capacity, charts, clean, cohort, monthly, profile, quality, retirement, soh, state, trend
from ..session import settle, unsettle
from ..sources import layout, telemetry

log = logging.getLogger("voltarc")


def scored_anchors(
    raw: DataFrame, c_nom: DataFrame, cfg: Config, models: DataFrame | None = None, turned: DataFrame | None = None,
    dealt: bool = False, devices: DataFrame | None = None, earlier: DataFrame | None = None,
) -> DataFrame:
    """Raw rows to scored anchors: deduplicated, cleaned, labelled, measured and judged.

    Rows are dealt by device once, unless they come ``dealt``, from a bucketed table; deduplication and every window of a
    device use that. ``devices`` is the state after earlier rows and ``earlier`` the last anchors before these.
    """
    return quality.run(capacity.run(anchor.run(clean.run(with_models(raw, models, dealt), cfg, turned, devices), cfg), c_nom, cfg), cfg, earlier)


def with_models(raw: DataFrame, models: DataFrame | None, dealt: bool) -> DataFrame:
    """Deduplicated rows with their devices' models."""
    df = telemetry.coerce(raw)
    df = telemetry.dedup(df if dealt else df.repartition("device_id"))
    return df if models is None else df.join(models, "device_id", "left")


def month_before(ym: str) -> str:
    year, month = int(ym[:4]), int(ym[5:])
    return f"{year - (month == 1):04d}-{12 if month == 1 else month - 1:02d}"


def monthly_table(scored: DataFrame, cfg: Config, from_month: str | None = None) -> DataFrame:
    return monthly.aggregate(scored, cfg.get("soh.min_anchors_per_month"), cfg.get("soh.anchor_mad_k"), from_month)


class Pipeline:
    """Steps 0 to 8 over one output folder."""

    def __init__(self, spark: SparkSession, cfg: Config, source: str, out: str, models: DataFrame | None = None, dry_run: bool = False, only_known: bool = False) -> None:
        """``only_known``: devices that ``models`` lacks aren't read; else they are an error."""
        self.only_known = only_known and models is not None
        self.spark, self.cfg, self.source, self.out, self.dry_run = spark, cfg, source, out.rstrip("/"), dry_run
        self.models = None if models is None else telemetry.model_map(models)
        self.turned: DataFrame | None = None
        self.ledger = telemetry.Ledger(spark, self.path("progress"))

    def path(self, name: str) -> str:
        return f"{self.out}/{name}"

    def keep(self, df: DataFrame, name: str, by: tuple[str, ...] = (), dynamic: bool = False) -> DataFrame:
        """Write and read back; a dry run only plans and counts."""
        if self.dry_run:
            log.info("%s: %d rows", name, df.count())
            return df
        telemetry.write_partitioned(df, self.path(name), by, dynamic=dynamic)
        return self.spark.read.parquet(self.path(name))

    def raw(self, after_month: str | None = None) -> DataFrame:
        df = telemetry.scan(self.spark, self.source, self.models, after_month) if self.only_known else telemetry.scan(self.spark, self.source, after_month=after_month)
        return telemetry.whitelisted(df, self.cfg.get("channels"))

    @property
    def dealt(self) -> bool:
        return layout.is_bucketed(self.spark, self.source)

    def state_path(self, name: str = "") -> str:
        """States depend on what they were made with: other thresholds or model sheets have a folder of their own."""
        used = json.dumps([self.cfg.get("anchor"), list(self.cfg.get("channels")), self.cfg.rest_current(), sorted((k, self.cfg.rest_current(p.c_nom_spec)) for k, p in self.cfg.models.items()), self.only_known], sort_keys=True, default=str)
        return self.path(f"state-{hashlib.sha256(used.encode()).hexdigest()[:12]}/{name}")

    def state_before(self, month: str) -> tuple[str, dict[str, DataFrame]] | None:
        """The latest state of a month before ``month``, and that month."""
        have = [n.partition("=")[2] for n in telemetry.names_in(self.spark, self.state_path("anchors")) if n.startswith("through=")]
        through = max((n for n in have if n < month and telemetry.is_ready(self.spark, self.state_path(f"anchors/through={n}"))), default=None)
        return None if through is None else (through, {name: self.spark.read.parquet(self.state_path(f"{name}/through={through}")) for name in ("devices", "bins", "anchors")})

    def remember(self, rows: DataFrame, scored: DataFrame, known: dict[str, DataFrame]) -> None:
        """The states before and after the last month of ``rows``, from which a run from that month or the next can go on."""
        last = rows.agg(F.date_format(F.max("ts"), "yyyy-MM").alias("ym")).first()["ym"]
        if last is None:
            return
        ym, has = F.date_format("ts", "yyyy-MM"), dict(known)
        for through, part in ((month_before(last), ym < last), (last, ym == last)):
            some, made = rows.where(part), scored.where(part)
            bins = profile.r_bins(some)
            now = {
                "devices": state.after(with_models(some, self.models, self.dealt), self.cfg, self.turned, has.get("devices")),
                "bins": profile.merged_bins(bins.unionByName(has["bins"]) if has else bins),
                "anchors": state.last_anchors(made, has.get("anchors")),  # the last one to be complete
            }
            for name, df in now.items():
                telemetry.write_partitioned(df, self.state_path(f"{name}/through={through}"))
            has = {name: self.spark.read.parquet(self.state_path(f"{name}/through={through}")) for name in now}

    def profile(self) -> Config:
        """Step 0, on about one device in 25 (all of them if that leaves none), which is read once.

        Leaves ``profile/settings.json``, which a user may correct and give as settings, ``profile/found.json``, which later
        steps read if they run alone, and ``profile/devices``, what each device of the sample shows.
        """
        raw = self.raw()
        part = settle(telemetry.sampled(raw), "sample")
        if not part.limit(1).count():
            unsettle(part)
            part = settle(raw, "sample")
        found = profile.decide(part, self.cfg)
        self.cfg = replace(self.cfg, found=found)
        log.info("profile: %s", json.dumps(asdict(found)))
        if found.unsure:
            log.warning("profile: too few rows to decide %s; check profile/settings.json", ", ".join(found.unsure))
        self.turned = self.keep(profile.reversed_devices(part), "reversed_devices")
        if self.models is not None and self.cfg.models:
            checked = self.keep(profile.against_sheet(part, self.models, self.cfg), "model_check")
            for r in checked.where("NOT ok").collect():  # a row a model
                log.warning("model %s measures as %s/%s, its sheet says %s/%s; the sheet counts", r["model"], r["chemistry"], r["series"], r["sheet_chemistry"], r["sheet_series"])
        if not self.dry_run:
            telemetry.write_text(self.spark, self.path("profile/settings.json"), json.dumps(found.settings(), indent=2))
            telemetry.write_text(self.spark, self.path("profile/found.json"), json.dumps(asdict(found), indent=2))
            shown = profile.voltage_range(part, "device_id").join(profile.r_stats(part), "device_id", "left").join(profile.current_sign(part), "device_id", "left")
            self.keep(shown, "profile/devices")
        unsettle(part)
        return self.cfg

    def recall(self) -> None:
        """What an earlier step 0 has found, for a run that begins after it; what the settings say stays."""
        told = telemetry.read_text(self.spark, self.path("profile/found.json"))
        if told is None:
            return
        own, found = self.cfg.found, found_of(json.loads(told))
        if own.chemistry is not None and (own.chemistry, own.series) != (found.chemistry, found.series):
            found = replace(found, chemistry=own.chemistry, series=own.series, v_full=own.v_full, v_cutoff=own.v_cutoff)
        self.cfg = replace(self.cfg, found=replace(found, reversed_devices=own.reversed_devices or found.reversed_devices))
        if self.turned is None and telemetry.is_ready(self.spark, self.path("reversed_devices")):
            self.turned = self.spark.read.parquet(self.path("reversed_devices"))

    def anchors(self, from_month: str | None = None) -> DataFrame:
        """Steps 1 to 4. With ``from_month`` only those months' partitions are replaced, and only later rows are read than a
        state covers that an earlier run has left; without one, all are, since offsets and nominal capacity need them."""
        before = self.state_before(from_month) if from_month else None
        through, known = before or (None, {})
        log.info("anchors: rows after %s", through or "the beginning")
        raw = self.raw(through)
        if self.models is not None:
            telemetry.require_models(raw, self.models)
        bins = profile.r_bins(raw)
        nominal = profile.nominal(profile.merged_bins(bins.unionByName(known["bins"])) if known else bins).select("channel", "device_id", "c_nom_bms")
        scored = scored_anchors(raw, nominal, self.cfg, self.models, self.turned, self.dealt, known.get("devices"), known.get("anchors")).withColumn("ym", F.date_format("ts", "yyyy-MM"))
        replaced = scored.where(F.col("ym") >= from_month) if from_month else scored
        kept = self.keep(replaced.repartition("ym", F.pmod(F.xxhash64("device_id"), F.lit(16))), "observation", ("ym",), dynamic=bool(from_month))
        if not self.dry_run:
            self.remember(raw, kept.where(F.col("ym") > through) if through else kept, known)
        return kept

    def months(self, scored: DataFrame, from_month: str | None = None) -> DataFrame:
        """Step 5."""
        table = monthly_table(scored, self.cfg, from_month)
        return self.keep(table, "monthly_capacity", ("ym",), dynamic=bool(from_month))

    def run(self, first: int = 0, last: int = 8, from_month: str | None = None) -> dict[str, DataFrame]:
        if not 0 <= first <= last <= 8:
            raise ValueError("steps go from 0 to 8")
        made: dict[str, DataFrame] = {}
        if first == 0 and self.profile().found.route != "ABSOLUTE":
            log.info("route %s: no absolute capacities, later steps are skipped", self.cfg.found.route)
            return made
        if first > 0:
            self.recall()
        if first <= 5 <= last:
            made["observation"] = self.anchors(from_month)
            made["monthly_capacity"] = self.months(made["observation"], from_month)
            if not self.dry_run:
                self.ledger.mark(made["monthly_capacity"], "step1_5")
        scored = made.get("observation") or (self.spark.read.parquet(self.path("observation")) if last >= 6 else None)
        if last >= 6:
            table = made.get("monthly_capacity") or self.spark.read.parquet(self.path("monthly_capacity"))
            made["soh"] = self.keep(soh.run(table, self.cfg), "soh")
        if last >= 7:
            made["excluded_devices"] = self.keep(trend.exclusions(made["soh"], self.cfg.get("exclude.soh_low_ratio")), "excluded_devices")
            made["soh_analysis"] = self.keep(trend.analysis(made["soh"], self.cfg), "soh_analysis")
            made["soh_plot"] = self.keep(capacity.plot_points(scored), "soh_plot")
            made["soh_alert"] = self.keep(trend.alerts(made["soh_analysis"], scored, self.cfg), "soh_alert")
            made["dashboard"] = self.keep(trend.dashboard(scored, made["soh_analysis"]), "dashboard")
            made["group_consistency"] = self.keep(trend.consistency(made["soh_analysis"]), "group_consistency")
            made["full_vs_empty"] = self.keep(trend.full_vs_empty(scored), "full_vs_empty")
            if not self.dry_run:
                self.page(made["dashboard"], "dashboard", "channel")
                self.page(made["group_consistency"].where("lagging"), "lagging_devices", "channel", "device_id")
            made["r_drift"] = self.keep(trend.r_drift(scored), "r_drift")
            made["r_drift_verdict"] = self.keep(trend.r_drift_verdict(made["r_drift"]), "r_drift_verdict")
        if last >= 8:
            made["retirement_forecast"] = self.keep(retirement.forecast(made["soh_analysis"], self.cfg), "retirement_forecast")
            made |= self.reports(made["soh_analysis"], made["retirement_forecast"])
        return made

    def reports(self, table: DataFrame, forecast: DataFrame) -> dict[str, DataFrame]:
        """The tables behind the cohort and schedule reports, and as CSV files, of all models and of each."""
        months = self.keep(cohort.retire_months(forecast, table), "retire_months")
        latest = table.agg(F.max("ym").alias("ym")).first()["ym"]
        made = {name: self.keep(df, name) for name, df in (
            ("model_trend", cohort.by_month(table)), ("model_decay_stats", cohort.decay_stats(table)), ("model_age_trend", cohort.by_age(table)), ("model_loop_trend", cohort.by_loops(table)),
            ("model_stage_loops", cohort.by_stage(table, forecast)), ("fleet", cohort.fleet(table)), ("fleet_levels", cohort.level_counts(forecast)), ("model_desc", cohort.described(table.select("model").distinct(), self.cfg)),
        )}
        made["model_loop_cap"] = self.keep(cohort.loop_cap(made["model_loop_trend"]), "model_loop_cap")
        made["model_chart_age"] = self.keep(charts.bands(made["model_age_trend"], "model", F.col("age_month"), "soh_median", "soh_p10", "soh_p90"), "model_chart_age")
        made["model_chart_loops"] = self.keep(charts.bands(made["model_loop_trend"], "model", F.col("loop_from"), "soh_median", "soh_p10", "soh_p90"), "model_chart_loops")
        made["model_scales"] = self.keep(charts.scales(made["model_age_trend"], ["model"], ["age_month", "soh_p10", "soh_p90", "loop_p75"]), "model_scales")
        devices = charts.curves(table, ["model", *soh.KEYS], month_index("ym"), F.col("soh"))
        self.keep(devices, "device_charts")  # a row a device: no report file
        made["model_loop_axis"] = self.keep(cohort.loop_axis(made["model_trend"], "ym"), "model_loop_axis")
        made["model_soh80"] = self.keep(cohort.crossing_80(made["model_age_trend"], "age_month"), "model_soh80")
        made["model_age_ticks"] = self.keep(cohort.ticks(made["model_age_trend"], "age_month", 0, 2, ("loop_p25", "loop_p75", "birth_p25", "birth_p75")), "model_age_ticks")
        made["model_loop_ticks"] = self.keep(cohort.ticks(made["model_loop_trend"], "loop_from", 50, 50, ("age_p25", "age_p75", "birth_p25", "birth_p75")), "model_loop_ticks")
        if latest:
            today = int(latest[:4]) * 12 + int(latest[5:])
            made["retire_schedule"] = self.keep(cohort.schedule(months, today), "retire_schedule")
            made["retire_outside"] = self.keep(cohort.outside(months, today), "retire_outside")
            made["retire_quarters"] = self.keep(cohort.by_quarter(made["retire_schedule"]), "retire_quarters")
            made["model_milestones"] = self.keep(cohort.peak_month(made["retire_schedule"]).join(cohort.half_way(made["retire_schedule"]), "model"), "model_milestones")
            made["kpis"] = self.keep(cohort.kpis(made["retire_schedule"], made["fleet"], today), "kpis")
        if not self.dry_run:
            for name, df in made.items():
                flat = df.withColumn("points", F.to_json("points")) if "points" in df.columns else df
                telemetry.write_csv(flat, self.path(f"reports/all/{name}"))
                if name.startswith("model_") and name != "model_desc":
                    telemetry.write_csv(flat, self.path(f"reports/by_model/{name}"), ("model",))
        return made

    def page(self, df: DataFrame, name: str, *order: str) -> None:
        """A table as a page of its own, in this order."""
        telemetry.write_text(self.spark, self.path(f"pages/{name}.html"), html_table(df.orderBy(*order), name.replace("_", " ")))


def html_table(df: DataFrame, title: str, most: int = 10_000) -> str:
    """A report table as a page. Of a longer one the page shows ``most`` rows, and says how many there are and that a file has them."""
    import html

    rows = "".join("<tr>" + "".join(f"<td>{html.escape('' if v is None else str(v))}</td>" for v in r) + "</tr>" for r in df.limit(most).toLocalIterator())
    head = "".join(f"<th>{html.escape(c)}</th>" for c in df.columns)
    total = df.count()
    more = f"<p>{most} of {total} rows; the table's files have all of them</p>" if total > most else ""
    return f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><table><tr>{head}</tr>{rows}</table>{more}"
