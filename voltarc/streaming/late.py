"""Monthly weights from a stream with repeated and late rows.

Rows are deduplicated within the watermark, and a day's weights by value are given out once the watermark has passed it.
Weights of a value add up, over days and over batches, so that the monthly layer follows from them alone
(``monthly.from_weights``), and a day is never recomputed.

Defined cases: a row behind the watermark is dropped and counted in the query's progress (``runs.late_rows``); of rows with
one key the first to arrive counts, as long as they are no further apart than the watermark's delay; rows without a time or
a value don't count; a day is given out when a later row has moved the watermark past its end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def daily_weights(rows: DataFrame, value: str, weight: str, key: Sequence[str] = ("device_id", "ts"), late: str = "2 days", device: str = "device_id", ts: str = "ts") -> DataFrame:
    """(device_id, day, ym, value, w, n) of a stream, or of a batch."""
    told = rows.select(*dict.fromkeys([device, *key]), *([] if ts in key else [ts]), F.col(value).alias("_v"), F.col(weight).cast("double").alias("_w")).withColumn(ts, F.col(ts).cast("timestamp"))
    told = told.where(F.col(ts).isNotNull() & F.col("_v").isNotNull())
    once = told.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(key)) if rows.isStreaming else told.dropDuplicates(list(key))
    days = once.groupBy(F.col(device).alias("device_id"), F.window(ts, "1 day").alias("day"), F.col("_v").alias("value"), F.col("_w").alias("w")).agg(F.count("*").alias("n"))
    return days.select("device_id", F.to_date("day.start").alias("day"), F.date_format("day.start", "yyyy-MM").alias("ym"), "value", "w", "n")


def keep_weights(weights: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append finished days to a table by month; a batch that is delivered again is written once."""
    out = weights.writeStream.format("parquet").partitionBy("ym").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return (out.trigger(**trigger) if trigger else out).start()
