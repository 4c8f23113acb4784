"""Raw rows as a bucketed, sorted table: what is grouped by device is read without a shuffle.

Rows lie in folders by month, in each as files by hash bucket of the device, in order of device and time. Windows, aggregates
and joins on the device then take the buckets as they lie; a month, a set of devices or both prune files. Spark keeps the
bucketing in its catalogue, so a small description beside the files lets any later session open them again.

Defined cases: rows without a device share one bucket; rows without a time lie in the default partition, and are read with
all; an empty table has a description and no rows; a table that is written again is replaced, and one that is appended to
keeps its buckets, of which the files of one month then aren't in order among each other.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DESCRIPTION = "_layout"
LEAST_BUCKETS = 32
BUCKET_BYTES = 1 << 30
#: Ids that a scan is told one by one; more are joined.
MOST_PUSHED = 512


def _files(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def bucket_count(spark: SparkSession, path: str, bytes_each: int = BUCKET_BYTES, least: int = LEAST_BUCKETS) -> int:
    """Buckets for the files at ``path``: a power of two of about ``bytes_each``, as a bucket is read by one task."""
    files, at = _files(spark, path)
    need = -(-int(files.getContentSummary(at).getLength()) // bytes_each)
    return max(least, 1 << max(0, need - 1).bit_length())


def write_bucketed(df: DataFrame, path: str, key: str = "device_id", order: Sequence[str] = ("ts",), buckets: int = LEAST_BUCKETS, by: Sequence[str] = (), append: bool = False, files_with: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` in buckets of ``key``, sorted by it and ``order``, in folders by the columns ``by``; and read it back.

    Rows are dealt to the buckets before they are written, so that a bucket of a folder is one file. Files hold a Bloom filter
    of the key beside the bounds of their pages; ``files_with`` are options of the Parquet writer, such as parquet.block.size.
    """
    spark = df.sparkSession
    there = bool(append) and is_bucketed(spark, path)
    if there:
        told = _description(spark, path)
        key, order, buckets, by = told["key"], told["order"], told["buckets"], told["by"]
    name = _name()
    dealt = df.repartition(buckets, key).sortWithinPartitions(*by, key, *order)
    out = dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key, *order).option("path", path)
    out = out.option(f"parquet.bloom.filter.enabled#{key}", "true").options(**(files_with or {}))
    out = out.partitionBy(*by) if by else out
    if there:
        _register(spark, path, told, name)
        out.mode("append").saveAsTable(name)
    else:
        files, at = _files(spark, path)
        files.delete(at, True)
        out.saveAsTable(name)
        told = {"key": key, "order": list(order), "buckets": buckets, "by": list(by), "schema": spark.table(name)._jdf.schema().toDDL()}
        spark.createDataFrame([(json.dumps(told),)], "value string").coalesce(1).write.text(f"{path}/{DESCRIPTION}")
    return spark.table(name)


def _name() -> str:
    return f"voltarc_{uuid.uuid4().hex}"


def is_bucketed(spark: SparkSession, path: str) -> bool:
    files, at = _files(spark, f"{path.rstrip('/')}/{DESCRIPTION}/_SUCCESS")
    return bool(files.exists(at))


def _description(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path.rstrip('/')}/{DESCRIPTION}").first()[0])


def _register(spark: SparkSession, path: str, told: dict, name: str) -> None:
    def names(columns: Sequence[str]) -> str:
        return ", ".join(f"`{c}`" for c in columns)

    by = f"PARTITIONED BY ({names(told['by'])})" if told["by"] else ""
    spark.sql(f"CREATE TABLE {name} ({told['schema']}) USING parquet {by} CLUSTERED BY (`{told['key']}`) SORTED BY ({names([told['key'], *told['order']])}) INTO {told['buckets']} BUCKETS LOCATION '{path}'")
    if told["by"]:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def open_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A table that ``write_bucketed`` left at ``path``, with its buckets."""
    name = _name()
    _register(spark, path.rstrip("/"), _description(spark, path), name)
    return spark.table(name)


def of_keys(table: DataFrame, keys: DataFrame, key: str = "device_id") -> DataFrame:
    """The rows of a bucketed table whose key is in ``keys`` (a column of that name).

    Up to MOST_PUSHED keys go to the scan, which leaves out buckets, row groups by their bounds and Bloom filters, and pages
    by their bounds; more are joined, bucket by bucket. The result is the same.
    """
    wanted = keys.select(key).where(F.col(key).isNotNull()).distinct()
    few = [r[0] for r in wanted.limit(MOST_PUSHED + 1).collect()]
    if len(few) > MOST_PUSHED:
        return table.join(wanted, key, "left_semi")
    tests = [F.col(key) == k for k in few]  # a list would be told to the files as its bounds alone
    while len(tests) > 1:  # a flat tree, for the planner's sake
        tests = [reduce(lambda a, b: a | b, tests[k : k + 8]) for k in range(0, len(tests), 8)]
    return table.where(tests[0] if tests else F.lit(False))


def prepare(df: DataFrame, path: str, devices: DataFrame | None = None, buckets: int = LEAST_BUCKETS) -> DataFrame:
    """Raw rows by month, bucketed by device and sorted by time; of ``devices`` (device_id) alone if given."""
    kept = df if devices is None else df.join(devices.select("device_id").distinct(), "device_id", "left_semi")
    return write_bucketed(kept.withColumn("ym", F.date_format("ts", "yyyy-MM")), path, "device_id", ("ts",), buckets, ("ym",))


def replace_months(df: DataFrame, path: str, from_month: str) -> DataFrame:
    """A table of ``prepare`` with the rows of ``df`` in the place of all from that month on."""
    spark, month = df.sparkSession, F.date_format("ts", "yyyy-MM")
    files, at = _files(spark, path)
    for f in files.listStatus(at):
        name = f.getPath().getName()
        if name.startswith("ym=") and name[3:10] >= from_month and not name.startswith("ym=__"):
            files.delete(f.getPath(), True)
    return write_bucketed(df.where(month >= from_month).withColumn("ym", month), path, append=True)
