"""Feeds whose files differ in their types."""

from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from voltarc.sources import telemetry

T = datetime(2024, 5, 1, 12, 30)


def table(n, ts=None, voltage=None, **more):
    cols = {
        "source_table": pa.array(["s"] * n), "device_id": pa.array(range(n), pa.int64()), "channel": pa.array(["c"] * n), "loop_count": pa.array([1.0] * n), "remaining_ah": pa.array([20.0] * n), "soc": pa.array([0.5] * n),
        "voltage": pa.array([70.5] * n) if voltage is None else voltage, "current": pa.array([1.0] * n), "temperature": pa.array([25.0] * n), "ts": pa.array([T] * n, pa.timestamp("us")) if ts is None else ts,
    }
    return pa.table(cols | more)


@pytest.fixture
def folder(tmp_path):
    tmp_path = tmp_path / "a feed"
    for k, t in enumerate((
        table(2), table(3, note=pa.array(["x"] * 3)), table(2, ts=pa.array([T] * 2, pa.timestamp("ns"))), table(3, voltage=pa.array(["70.5", "bad", None])), table(1, voltage=pa.array([70], pa.int32()), note=pa.array([7])),
        table(2, ts=pa.array([str(T)] * 2)), table(2), table(0), table(2).drop_columns(["temperature"]),
    )):
        (tmp_path / "feed" / f"day={k}").mkdir(parents=True)
        pq.write_table(t, tmp_path / "feed" / f"day={k}" / "part.parquet", version="2.6", coerce_timestamps=None)
    return str(tmp_path / "feed")


def test_files_of_several_schemas_are_one_table(spark, folder):
    spark.conf.unset(telemetry.NANOS)
    try:
        got = telemetry.read_mixed(spark, folder)
        assert {n: t for n, t in got.dtypes if n in ("ts", "voltage", "note")} == {"ts": "timestamp_ntz", "voltage": "double", "note": "string"}
        rows = got.collect()
        assert len(rows) == 17 and {r.ts for r in rows} == {T} and sorted(str(r.voltage) for r in rows) == ["70.0", *["70.5"] * 14, "None", "None"]
        assert sorted(str(r.note) for r in rows if r.note) == ["7", "x", "x", "x"] and sum(r.temperature is None for r in rows) == 2
        files = sorted(f"{folder}/day={k}/part.parquet" for k in range(9))
        groups = telemetry.schema_groups(spark, files)
        assert sorted(f for _, own in groups for f in own) == files and len(groups) == 6  # an empty file has types of its own
    finally:
        spark.conf.unset(telemetry.NANOS)


def test_plain_files_leave_the_session_alone(spark, tmp_path):
    pq.write_table(table(3), tmp_path / "a.parquet")
    assert telemetry.scan(spark, str(tmp_path)).count() == 3 and spark.conf.get(telemetry.NANOS, "false") == "false"
