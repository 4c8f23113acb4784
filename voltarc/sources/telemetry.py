"""Reading, coercing, bucketing and writing telemetry and its side tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import layout

#: Wire name, name used inside, type.
WIRE = (
    ("表名", "source_table", "string"), ("电池id", "device_id", "bigint"), ("渠道号", "channel", "string"), ("循环次数", "loop_count", "double"), ("剩余容量", "remaining_ah", "double"),
    ("SOC", "soc", "double"), ("电压", "voltage", "double"), ("电流", "current", "double"), ("温度", "temperature", "double"), ("更新时间", "ts", "timestamp_ntz"),
)
BUCKETS = 32


class SchemaError(ValueError):
    """A required column is missing."""


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, wherever it lies; none if it isn't one."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [x.getPath().getName() for x in fs.listStatus(at)] if fs.exists(at) and fs.getFileStatus(at).isDirectory() else []


NANOS = "spark.sql.legacy.parquet.nanosAsLong"


def _or_nanos(spark: SparkSession, read: Callable[[], DataFrame]) -> DataFrame:
    """Files with nanoseconds can be read as numbers only, which is a setting of the session; it is touched where they are met."""
    try:
        return read()
    except Exception as e:
        if "NANOS" not in str(e):
            raise
    spark.conf.set(NANOS, "true")
    return read()


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files of one schema below ``path``, in folders of any depth; nanosecond timestamps come as numbers and are turned by ``coerce``.

    Folders written by ``prepare`` keep their ``bucket`` column, so that a filter on it prunes files.
    """
    bucketed = any(n.startswith("bucket=") for n in names_in(spark, path))
    return _or_nanos(spark, lambda: (spark.read if bucketed else spark.read.option("recursiveFileLookup", "true")).parquet(path))


def schema_groups(spark: SparkSession, files: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """``files`` by the schemas that can be read together, each with their merged schema.

    Footers are read and merged on the executors; files that don't merge are halved until they do. Feeds change their types
    from some day on, so in the order of their names few halves are needed.
    """
    try:
        return [(_or_nanos(spark, lambda: spark.read.option("mergeSchema", "true").parquet(*files)).schema, list(files))]
    except Exception as e:
        if len(files) == 1 or "MERGE" not in str(e).upper():
            raise
    half, out = len(files) // 2, []
    for schema, own in [*schema_groups(spark, files[:half]), *schema_groups(spark, files[half:])]:
        for k, (known, held) in enumerate(out):
            kinds = {f.name: f.dataType for f in known}
            if all(kinds.get(f.name, f.dataType) == f.dataType for f in schema):
                out[k] = (T.StructType([*known, *(f for f in schema if f.name not in kinds)]), held + own)
                break
        else:
            out.append((schema, own))
    return out


def read_mixed(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all Parquet files below ``path``, whatever types their columns have: each kind is read by its own schema, coerced to
    the declared types and put together. Other columns are kept; as text where their types differ."""
    files = sorted(unquote(f) for f in spark.read.schema("_ int").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(path).inputFiles())
    if not files:
        return coerce(from_wire(read_parquet(spark, path)))
    parts = [coerce(from_wire(spark.read.schema(schema).parquet(*own))) for schema, own in schema_groups(spark, files)]
    kinds: dict[str, set[str]] = {}
    for p in parts:
        for name, kind in p.dtypes:
            kinds.setdefault(name, set()).add(kind)
    odd = {name for name, k in kinds.items() if len(k) > 1}
    parts = [p.withColumns({c: F.col(f"`{c}`").cast("string") for c in odd if c in p.columns}) for p in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def from_wire(df: DataFrame) -> DataFrame:
    """Rename wire columns to the names used inside; names used inside pass."""
    return df.withColumnsRenamed({wire: name for wire, name, _ in WIRE if wire in df.columns})


def to_wire(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({name: wire for wire, name, _ in WIRE if name in df.columns})


def require(df: DataFrame, names: Sequence[str] = tuple(n for _, n, _ in WIRE)) -> None:
    if missing := [n for n in names if n not in df.columns]:
        raise SchemaError(f"missing columns: {', '.join(missing)}")


def _cast(df: DataFrame, name: str, to: str) -> Column:
    kind, c = df.schema[name].dataType, F.col(name)
    if to == "timestamp_ntz" and isinstance(kind, T.LongType):  # nanoseconds
        return F.timestamp_micros(F.floor(c / 1000)).cast("timestamp_ntz")
    if kind.simpleString() == to:
        return F.when(~F.isnan(c), c) if to == "double" else c
    out = c.cast("string").try_cast(to) if to in ("double", "bigint", "timestamp_ntz") and isinstance(kind, T.StringType) else c.try_cast(to)
    return F.when(~F.isnan(out), out) if to == "double" else out


def coerce(df: DataFrame, declared: Mapping[str, str] | None = None) -> DataFrame:
    """Extra columns first, then the declared ones: cast without failing (NaN and bad values to null), added as null if missing."""
    declared = declared or {n: t for _, n, t in WIRE}
    extra = [F.col(f"`{c}`") for c in df.columns if c not in declared]
    return df.select(*extra, *[(_cast(df, n, t) if n in df.columns else F.lit(None).cast(t)).alias(n) for n, t in declared.items()])


def of_devices(df: DataFrame, devices: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``devices`` (device_id); of bucketed files those of other buckets aren't read."""
    wanted = devices.select("device_id").distinct()
    if "bucket" not in df.columns:
        return df.join(wanted, "device_id", "left_semi")
    held = [r["bucket"] for r in wanted.select(_bucket(buckets)).distinct().collect()]  # at most ``buckets`` numbers
    return df.where(F.col("bucket").isin(held)).join(wanted, "device_id", "left_semi")


def _bucket(buckets: int) -> Column:
    return F.pmod("device_id", F.lit(buckets)).cast("int").alias("bucket")


def _feed(spark: SparkSession, path: str) -> DataFrame:
    """A folder of files as they come; one that ``prepare`` wrote has one schema, and buckets to be pruned."""
    if any(n.startswith("bucket=") for n in names_in(spark, path)):
        return from_wire(read_parquet(spark, path))
    return read_mixed(spark, path)


def scan(spark: SparkSession, path: str, devices: DataFrame | None = None, after_month: str | None = None) -> DataFrame:
    """Raw rows of a file or folder, names checked, types coerced, kept to ``devices`` (device_id) if given. No deduplication.

    With ``after_month``, only rows with a later time; a table that ``layout.prepare`` has left is pruned by months, buckets
    and ids, and read in its buckets.
    """
    bucketed = layout.is_bucketed(spark, path)
    df = layout.open_bucketed(spark, path) if bucketed else _feed(spark, path)
    if bucketed:
        df = df if after_month is None else df.where(F.col("ym") > after_month)
        df = (df if devices is None else layout.of_keys(df, devices)).drop("ym")
    require(df)
    df = coerce(df)
    df = df if bucketed or devices is None else of_devices(df, devices)
    return (df if after_month is None else df.where(F.date_format("ts", "yyyy-MM") > after_month)).drop("bucket")


def dedup(df: DataFrame, keys: Sequence[str] = ("device_id", "ts")) -> DataFrame:
    """One row of each key, the first in the order of all other columns: the same one on every run."""
    rest = [F.col(c) for c in df.columns if c not in keys and not isinstance(df.schema[c].dataType, T.MapType)]
    w = Window.partitionBy(*keys).orderBy(*(rest or [F.lit(0)]))
    return df.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def sampled(df: DataFrame, every: int = 25, device: str = "device_id") -> DataFrame:
    """The rows of about one device in ``every``, always the same ones."""
    return df.where(F.pmod(F.col(device), F.lit(every)) == 0)


def whitelisted(df: DataFrame, channels: Sequence[str]) -> DataFrame:
    return df.where(F.col("channel").isin(list(channels))) if channels else df


def prepare(df: DataFrame, path: str, devices: DataFrame | None = None, channels: Sequence[str] = (), buckets: int = BUCKETS) -> None:
    """Filter and write raw rows by device bucket, so that later reads of some devices prune the rest."""
    kept = whitelisted(df if devices is None else df.join(devices.select("device_id").distinct(), "device_id", "left_semi"), channels)
    # eight salts a bucket keep a large device from making one huge file
    dealt = with_bucket(kept, buckets).repartition("bucket", F.pmod(F.xxhash64("device_id"), F.lit(8)))
    dealt.write.mode("overwrite").partitionBy("bucket").option("maxRecordsPerFile", 5_000_000).parquet(path)


def with_bucket(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Adds the bucket that a device's rows are written to."""
    return df.select("*", _bucket(buckets))


def is_ready(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` was completed, wherever it lies."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    marker = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    return bool(marker.getFileSystem(conf).exists(marker))


def write_partitioned(df: DataFrame, path: str, by: Sequence[str] = (), fmt: str = "parquet", dynamic: bool = False) -> None:
    """Hive folders by columns; ``dynamic`` replaces only the partitions that ``df`` holds, which makes re-runs idempotent."""
    out = df.write.mode("overwrite").format(fmt).option("header", "true")
    out = out.option("partitionOverwriteMode", "dynamic") if dynamic else out
    (out.partitionBy(*by) if by else out).save(path)


def read_dir(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | str | None = None) -> DataFrame:
    """All files of a folder and of the folders in it."""
    reader = spark.read.format(fmt).option("header", "true").option("recursiveFileLookup", "true")
    return (reader.schema(schema) if schema else reader).load(path)


def write_csv(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """A small report table as CSV with a header: one file, or one for each value of ``by`` in a folder of its own."""
    if by:
        df.repartition(*by).write.mode("overwrite").option("header", "true").partitionBy(*by).csv(path)
    else:
        df.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file of text, wherever it lies."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """What ``write_text`` wrote; None if it isn't there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return None
    return spark.read.text(path, wholetext=True).first()[0]


def model_map(df: DataFrame) -> DataFrame:
    """(device_id, model), each device once; a device with two models is an error."""
    devices = df.where("device_id IS NOT NULL AND model IS NOT NULL").groupBy("device_id").agg(F.min("model").alias("model"), F.max("model").alias("_other"))
    return devices.select("device_id", F.when(F.col("model") == F.col("_other"), F.col("model")).otherwise(F.raise_error(F.concat(F.lit("two models of device "), F.col("device_id").cast("string")))).alias("model"))


def read_model_map(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema("`电池id` bigint, `电池型号` string").option("header", "true").option("enforceSchema", "false").csv(path)
    return model_map(raw.select(F.col("电池id").alias("device_id"), F.col("电池型号").alias("model")))


def require_models(df: DataFrame, models: DataFrame, shown: int = 20) -> None:
    """An error that names some of the devices without a model, if there are any."""
    missing = df.select("device_id").distinct().join(models, "device_id", "left_anti").limit(shown).collect()
    if missing:
        raise ValueError(f"devices without a model: {', '.join(sorted(str(r['device_id']) for r in missing))}")


def read_c_nom(spark: SparkSession, path: str) -> DataFrame:
    """(channel, device_id, c_nom_bms); the channel is text, whatever it looks like."""
    return spark.read.schema("channel string, device_id bigint, c_nom_bms double").option("header", "true").csv(path)


class Ledger:
    """What is done, by (step, channel, device_id, ym): an append-only table of marks, of which the latest counts."""

    SCHEMA = "step string, channel string, device_id bigint, ym string, status string, marked_at timestamp"
    KEYS = ("step", "channel", "device_id", "ym")

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def mark(self, rows: DataFrame, step: str, status: str = "done") -> None:
        """Append a mark for each distinct (channel, device_id, ym) of ``rows``; what it lacks counts as ALL."""
        have = {c: F.col(c).cast(t) if c in rows.columns else F.lit("ALL" if t == "string" else None).cast(t) for c, t in (("channel", "string"), ("device_id", "bigint"), ("ym", "string"))}
        marks = rows.select(*[x.alias(c) for c, x in have.items()]).distinct()
        marks.select(F.lit(step).alias("step"), *have, F.lit(status).alias("status"), F.current_timestamp().alias("marked_at")).write.mode("append").parquet(self.path)

    def state(self) -> DataFrame:
        """(step, channel, device_id, ym, status), one row a key."""
        if not names_in(self.spark, self.path):
            return self.spark.createDataFrame([], self.SCHEMA).drop("marked_at")
        return self.spark.read.schema(self.SCHEMA).parquet(self.path).groupBy(*self.KEYS).agg(F.max_by("status", "marked_at").alias("status"))

    def done(self, step: str) -> DataFrame:
        return self.state().where((F.col("step") == step) & (F.col("status") == "done"))

    def pending(self, step: str) -> DataFrame:
        """(channel, device_id, ym) with another mark than done."""
        return self.state().where((F.col("step") == step) & (F.col("status") != "done")).select("channel", "device_id", "ym")


def pending(devices: DataFrame, progress: DataFrame, step: str) -> DataFrame:
    """Devices without a ``done`` row of a step in the progress table (step, device_id, status)."""
    done = progress.where((F.col("step") == step) & (F.col("status") == "done"))
    return devices.join(done.select("device_id").distinct(), "device_id", "left_anti")
