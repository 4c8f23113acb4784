"""Streams over micro-batches against the batch operators."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltarc.functions import series
from voltarc.operators import monthly
from voltarc.streaming import late, runs

T0 = datetime(2024, 3, 1)
SCHEMA = "device_id bigint, n bigint, ts timestamp, current double, value double, w double"


@pytest.fixture
def stream(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.shuffle.partitions", "2")

    def run(batches, of, name):
        """The rows that ``of`` a stream of these batches gives, and the query."""
        for k, rows in enumerate(batches):
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/{name}/in/b{k:02}")
        # files are taken in the order of their times
        source = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{name}/in")
        q = of(source).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"{tmp_path}/{name}/check").trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.table(name), q

    yield run
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def readings(seed, n=60):
    rng, out = np.random.default_rng(seed), []
    for d in range(3):
        t = T0
        for _ in range(n):
            t += timedelta(minutes=int(rng.choice([10, 60, 180, 360, 361, 900], p=[0.3, 0.3, 0.2, 0.1, 0.05, 0.05])))
            out.append((d, len(out), t, float(rng.choice([0.1, 0.5, 3.0], p=[0.6, 0.25, 0.15])), 0.0, 1.0))
    return out


SENTINEL = (99, 10_000, T0 + timedelta(days=400), 9.0, 0.0, 1.0)


def test_rest_runs_equal_batch_ones(spark, stream):
    rows = readings(1)
    rng = np.random.default_rng(2)
    ordered = sorted(rows, key=lambda r: (r[2] + timedelta(minutes=int(rng.integers(0, 50))), r[1]))  # up to 50 minutes out of order
    batches = [ordered[k : k + 45] for k in range(0, len(ordered), 45)]
    too_late = (1, 9_999, T0 + timedelta(minutes=1), 0.1, 0.0, 1.0)
    got, q = stream([*batches, [too_late], [SENTINEL]], lambda s: runs.rest_runs(s, F.abs("current") < 0.8, "n", 21600, 7200, "1 hour"), "rest")
    want = series.rest_runs(spark.createDataFrame(rows, SCHEMA), "device_id", "ts", F.abs("current") < 0.8, 21600, 7200).select("n", "is_rest", "rest_s", "run_end")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert want.where("run_end").count() > 5 and runs.late_rows(q) == 1


def test_weights_of_a_stream_give_the_months(spark, stream):
    rng = np.random.default_rng(5)
    rows = [(int(rng.integers(0, 4)), k, T0 + timedelta(hours=int(12 * k + rng.integers(0, 20))), 0.0, float(np.round(rng.normal(40, 1 + 30 * (rng.random() < 0.05)), 1)), float(rng.choice([0.5, 1.0]))) for k in range(150)]
    again = [rows[k] for k in range(2, 150, 9)]
    batches = [rows[k : k + 30] + again[k // 9 : (k + 30) // 9 - 1] for k in range(0, 150, 30)]
    too_late = [(1, 9_000 + k, T0 + timedelta(hours=k), 0.0, 1.0, 1.0) for k in range(3)]
    got, q = stream([*batches, too_late, [SENTINEL]], lambda s: late.daily_weights(s, "value", "w", ("device_id", "n"), "3 days"), "weights")
    whole = late.daily_weights(spark.createDataFrame(rows, SCHEMA), "value", "w", ("device_id", "n"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect())) and runs.late_rows(q) == 3
    e = spark.createDataFrame(rows, SCHEMA).withColumn("ym", F.date_format("ts", "yyyy-MM"))
    keys = ["device_id", "ym"]
    kept = monthly.median_by_weight(monthly.masked(e, keys, "value", 3.0, 3), keys, "value", "w", ["n"])
    want = kept.groupBy(*keys).agg(monthly.weighted_median_of("value"), F.count("*"), F.round(F.avg("value"), 9))
    months = monthly.from_weights(got).withColumn("value_mean", F.round("value_mean", 9))
    assert sorted(map(tuple, months.collect())) == sorted(map(tuple, want.collect())) and want.count() > 4


def test_kept_weights_are_read_back(spark, stream, tmp_path):
    rows = [(1, k, T0 + timedelta(days=k), 0.0, 40.0, 1.0) for k in range(40)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in")
    for _ in range(2):  # the second run finds nothing new
        q = late.keep_weights(late.daily_weights(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in"), "value", "w"), f"{tmp_path}/out", f"{tmp_path}/check", {"availableNow": True})
        q.awaitTermination()
    kept = spark.read.parquet(f"{tmp_path}/out")
    assert kept.count() == 37 and {r.ym for r in kept.select("ym").distinct().collect()} == {"2024-03", "2024-04"}  # the watermark has not passed the last days


def test_months_from_weights_defined_cases(spark):
    w = spark.createDataFrame([(1, "2024-01", 1.0, 0.0, 3), (2, "2024-01", 5.0, 1.0, 2), (3, "2024-01", 1.0, 0.5, 2), (3, "2024-01", 1.0, 0.5, 2), (3, "2024-01", 900.0, 0.5, 1), (3, "2024-01", 2.0, 1.0, 1)], "device_id long, ym string, value double, w double, n long")
    got = {r.device_id: tuple(r)[2:] for r in monthly.from_weights(w).collect()}
    assert got == {1: (1.0, 3, 1.0), 3: (1.0, 6, got[3][2])} and monthly.from_weights(w.limit(0)).count() == 0
