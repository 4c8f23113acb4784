"""spark-submit entry: python -m voltarc.cli --source RAW --out DIR [--step 0-8] [--from-month YYYY-MM] [--dry-run]"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from .config import load_config, read_model_params, read_settings
from .plans.pipeline import Pipeline
from .sources import layout, telemetry


def steps(text: str) -> tuple[int, int]:
    """'3' or '3-7'"""
    a, _, b = text.partition("-")
    first, last = int(a), int(b or a)
    if not 0 <= first <= last <= 8:
        raise argparse.ArgumentTypeError("steps go from 0 to 8")
    return first, last


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--source", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--step", type=steps, default=(0, 8))
    p.add_argument("--from-month")
    p.add_argument("--dry-run", action="store_true")
    p.add_argument("--prep", action="store_true", help="only write the raw rows by device bucket; a run does so itself where that isn't done")
    p.add_argument("--no-prep", action="store_true", help="read the source as it is")
    p.add_argument("--force", action="store_true", help="do so even if that was done")
    p.add_argument("--settings", help="JSON or YAML")
    p.add_argument("--thresholds", help="JSON or YAML of thresholds under the settings")
    p.add_argument("--ocv-tables", help="folder of OCV tables, {chemistry}_{series}s.csv with soc and ocv_v")
    p.add_argument("--models", help="CSV of devices and models")
    p.add_argument("--model-params", help="CSV of model parameters")
    a = p.parse_args(args)
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("voltarc").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    cfg = load_config(read_settings(a.settings) if a.settings else None, read_settings(a.thresholds) if a.thresholds else None, models=read_model_params(a.model_params) if a.model_params else None, ocv_dir=a.ocv_tables)
    source = a.source
    models = telemetry.read_model_map(spark, a.models) if a.models else None
    if not a.no_prep:
        prepared = f"{a.out.rstrip('/')}/buckets"
        if (a.force or not layout.is_bucketed(spark, prepared)) and not a.dry_run:
            layout.prepare(telemetry.whitelisted(telemetry.scan(spark, source), cfg.get("channels")), prepared, models, layout.bucket_count(spark, source))
        elif a.from_month and not a.dry_run:
            layout.replace_months(telemetry.whitelisted(telemetry.scan(spark, source, models), cfg.get("channels")), prepared, a.from_month)
        source = prepared if layout.is_bucketed(spark, prepared) else source
    if a.prep:
        return
    Pipeline(spark, cfg, source, a.out, models, a.dry_run).run(*a.step, from_month=a.from_month)


if __name__ == "__main__":
    main()
