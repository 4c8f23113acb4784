"""Rest runs on a stream: each device is a state machine that goes by event time.

Rows wait in the device's state until the watermark has passed them, so that they are taken in the order of their times
however they arrive. A row is given out when the next one shows whether its run goes on, or when the watermark is further
from it than a gap, since then no later row can go on with it. What is kept of a device is its last row and the rows that
the watermark hasn't passed.

Defined cases: a row behind the watermark is dropped by Spark, and counted in the query's progress (``late_rows``); rows of
one time go by their number; a row without a time or a device doesn't count; a device's last rows stay in the state until
later rows of any device move the watermark past them.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.series import seconds
from ..session import ship

ROW = "row_id bigint, is_rest boolean, rest_s bigint, run_end boolean"


class RestRuns(StatefulProcessor):
    """Gaps and islands of one device: rest, the seconds since a run began, and the end of a long run."""

    def __init__(self, gap_s: int, min_s: int) -> None:
        self.gap_s, self.min_s = gap_s, min_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        #: the last row taken: whether it is still to be given out, and where its run began
        self.last = handle.getValueState("last", "row_id bigint, sec bigint, is_rest boolean, began bigint, held boolean")
        self.waiting = handle.getMapState("waiting", "ms bigint, row_id bigint", "sec bigint, rest boolean")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        for part in rows:
            for n, ms, sec, rest in zip(part["row_id"].tolist(), part["ms"].tolist(), part["sec"].tolist(), part["rest"].tolist(), strict=True):
                self.waiting.updateValue((ms, n), (sec, bool(rest)))
                self.handle.registerTimer(ms)
        yield from ()

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        passed, out = timerValues.getCurrentWatermarkInMs(), []
        last = self.last.get() if self.last.exists() else None
        ready = sorted((k, v) for k, v in self.waiting.iterator() if k[0] <= passed)
        for (ms, n), (sec, rest) in ready:
            rest = rest and (last is None or sec - last[1] <= self.gap_s)
            began = last[3] if rest and last is not None and last[2] else sec
            if last is not None and last[4]:
                out.append(self.told(last, rest))
            last = (n, sec, rest, began, True)
            self.waiting.removeKey((ms, n))
        if last is not None and last[4]:
            flush = (last[1] + self.gap_s + 1) * 1000
            if flush <= passed:
                out.append(self.told(last, False))
                last = (*last[:4], False)
            elif ready:
                self.handle.registerTimer(flush)
        if ready or out:
            self.last.update(last)
        if out:
            yield pd.DataFrame(out, columns=["row_id", "is_rest", "rest_s", "run_end"])

    def told(self, row: Any, goes_on: bool) -> tuple:
        n, sec, rest, began, _ = row
        rest_s = sec - began if rest else 0
        return n, rest, rest_s, rest and rest_s >= self.min_s and not goes_on

    def close(self) -> None:
        pass


def rest_runs(rows: DataFrame, rest: Column, row_id: str, gap_s: int, min_s: int, late: str = "1 hour", device: str = "device_id", ts: str = "ts") -> DataFrame:
    """(row_id, is_rest, rest_s, run_end) of a stream's rows: those that ``series.rest_runs`` gives the same rows in batch.

    State goes to RocksDB, which the session must have been told (``spark.sql.streaming.stateStore.providerClass``).
    """
    ship(rows.sparkSession)
    time = F.col(ts).cast("timestamp")
    told = rows.where(time.isNotNull() & F.col(device).isNotNull()).select(
        F.col(device).alias("device_id"), time.alias("ts"), F.unix_millis(time).alias("ms"), seconds(time).alias("sec"), F.col(row_id).cast("bigint").alias("row_id"), F.coalesce(rest, F.lit(False)).alias("rest")
    )
    grouped = told.withWatermark("ts", late).groupBy("device_id")
    return grouped.transformWithStateInPandas(RestRuns(gap_s, min_s), ROW, "Append", "EventTime")


def late_rows(query: StreamingQuery) -> int:
    """Rows that a query has dropped so far because they came after the watermark."""
    return sum(s.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for s in p["stateOperators"])
