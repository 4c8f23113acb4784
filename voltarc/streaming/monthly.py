"""Beyond batch: the monthly layer kept up to date by a stream, and rest sessions as session windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import Config
from ..plans.pipeline import monthly_table
from ..sources.telemetry import write_partitioned


def maintain_months(scored: DataFrame, history: str, out: str, cfg: Config, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append scored anchors of a stream to ``history`` (by month), and recompute just the months that a batch touched.

    A batch that is delivered again rewrites its own folder of ``history`` and the same months of ``out``.
    """

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        months = df.withColumn("ym", F.date_format("ts", "yyyy-MM")).withColumn("batch", F.lit(number))
        write_partitioned(months, history, ("ym", "batch"), dynamic=True)
        touched = [r["ym"] for r in months.select("ym").distinct().collect()]  # months of one batch
        if touched:
            whole = spark.read.parquet(history).where(F.col("ym").isin(touched)).drop("batch", "ym")
            write_partitioned(monthly_table(whole, cfg), out, ("ym",), dynamic=True)

    writer = scored.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def rest_sessions(rows: DataFrame, rest: Callable[[], object], gap: str = "6 hours", late: str = "1 day") -> DataFrame:
    """(device_id, start, end, seconds, n) of spells of rest rows no further apart than ``gap``; works on batches and streams."""
    resting = rows.where(rest()).withWatermark("ts", late) if rows.isStreaming else rows.where(rest())
    s = resting.groupBy("device_id", F.session_window("ts", gap).alias("s")).agg(F.count("*").alias("n"), F.min("ts").alias("start"), F.max("ts").alias("end"))
    return s.select("device_id", "start", "end", (F.unix_timestamp(F.col("end").cast("timestamp")) - F.unix_timestamp(F.col("start").cast("timestamp"))).alias("seconds"), "n")
