"""What the operators need from the running session: package shipping and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import contextlib
import io
import os
import re
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of an Arrow batch to or from a Python worker; a session that has chosen its own bound keeps it.
ARROW_BATCH_BYTES = 2 << 20
_ARROW_BOUND = "spark.sql.execution.arrow.maxBytesPerBatch"
_ARROW_DEFAULT = 64 << 20

_SHIPPED: set[str] = set()
_OWN_DIR: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Give the executors this package (once per application), so that Python stages need nothing installed on them.

    Arrow batches are bounded by bytes as well, since rows may hold long texts.
    """
    if (spark.conf.get(_ARROW_BOUND, None) or "").rstrip("b") == str(_ARROW_DEFAULT):
        spark.conf.set(_ARROW_BOUND, str(ARROW_BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    path = os.path.join(tempfile.mkdtemp(prefix="voltarc-ship-"), "voltarc.zip")
    Path(path).write_bytes(packed.getvalue())
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Without one a session in one process, as in tests, gets its own; a cluster gets an error."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIR:
        own = tempfile.mkdtemp(prefix="voltarc-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        _OWN_DIR[app] = "file://" + own
    return _OWN_DIR[app]


#: Settled tables by path, with what deletes them; the innermost scope's are the last ones.
_SETTLED: dict[str, tuple] = {}


@atexit.register
def _delete_all() -> None:
    """At the end of the driver nothing that it settled stays behind."""
    for path in list(_SETTLED):
        _delete(path)


def _delete(path: str) -> None:
    files, at = _SETTLED.pop(path)
    with contextlib.suppress(Exception):  # a session that is gone can't delete; what it left lies in its application's folder
        files.delete(at, True)


def settled_path(spark: SparkSession, name: str) -> str:
    """A new place in the application's part of the shared folder, whose files go as those of a settled table do."""
    path = f"{shared_dir(spark)}/voltarc-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    _SETTLED[path] = (at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at)
    return path


def settle(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage is cut, lost executors cost nothing before it.

    Tables lie in a folder of the application, and are deleted by ``unsettle``, at the end of a ``scope`` or with the driver.
    """
    path = settled_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._voltarc_path = path  # for unsettle()
    return out


def unsettle(df: DataFrame) -> None:
    """Delete the files behind a settled table that nothing reads any more, such as a round that the next one replaced."""
    path = getattr(df, "_voltarc_path", None)
    if path in _SETTLED:
        _delete(path)


@contextlib.contextmanager
def scope() -> Iterator[list[DataFrame]]:
    """Tables settled inside are deleted at its end, in failures too, but for those that are appended to the list it gives."""
    before, kept = set(_SETTLED), []
    done = False
    try:
        yield kept
        done = True
    finally:
        stay = {df._voltarc_path for df in kept} if done else set()
        for path in [p for p in _SETTLED if p not in before and p not in stay]:
            _delete(path)


def quoted(name: str) -> str:
    """A column's name as Spark reads it whole, dots included."""
    return "`" + name.replace("`", "``") + "`"


def all_columns(df: DataFrame) -> list[Column]:
    return [F.col(quoted(c)) for c in df.columns]
