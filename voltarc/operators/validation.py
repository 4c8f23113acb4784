"""Row checks in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def row_checks(df: DataFrame, columns: Sequence[str], bad: Mapping[str, Column]) -> DataFrame:
    """One row: n_rows, the share of nulls of each column, and how many rows each test of ``bad`` hits."""
    nulls = [F.avg(F.col(c).isNull().cast("double")).alias(f"null_{c}") for c in columns]
    return df.agg(F.count("*").alias("n_rows"), *nulls, *[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in bad.items()])


def telemetry_checks(df: DataFrame) -> DataFrame:
    v = F.col("voltage")
    return row_checks(df, [c for c in df.columns], {"soc_out": ~F.col("soc").between(0, 1), "capacity_out": F.col("remaining_ah") <= 0, "voltage_out": ~v.between(20, 120)})


def summarize(spark: SparkSession, rows: Sequence[Mapping[str, object]]) -> DataFrame | None:
    """A table of dictionaries with all keys that any of them has; as text where kinds differ."""
    keys = list(dict.fromkeys(k for r in rows for k in r))
    if not keys:
        return None
    return spark.createDataFrame([tuple(None if r.get(k) is None else str(r[k]) for k in keys) for r in rows], ", ".join(f"`{k}` string" for k in keys))
