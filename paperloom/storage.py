"""Shared intermediate storage.

Intermediate results that several later stages read are written as Parquet
into the folder that ``spark.checkpoint.dir`` names (a folder every executor
shares), so a lost executor never loses the only copy.  The setting is read
from the session. Where it is unset, a temporary folder serves a local
master (tests); on a cluster, where it would be lost with its machine, that is
an error.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_fallback: dict[str, str] = {}
_lock = threading.Lock()
_inside: dict[str, tuple[int, str | None]] = {}


def shared_root(spark: SparkSession) -> str:
    """The shared folder of the session, without a trailing slash."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if "root" not in _fallback:
            _fallback["root"] = "file://" + tempfile.mkdtemp(prefix="paperloom-")
        root = _fallback["root"]
    return root.rstrip("/")


@contextmanager
def _shuffle_cleanup(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when their query ends. Writes that overlap share the
    setting; the last one puts back what was there before the first."""
    key = spark.sparkContext.applicationId
    with _lock:
        n, before = _inside.get(key, (0, None))
        if n == 0:
            before = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _inside[key] = (n + 1, before)
    try:
        yield
    finally:
        with _lock:
            n, before = _inside[key]
            _inside[key] = (n - 1, before)
            if n == 1:
                spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def _hadoop(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage; the shuffle files of the write are released at its end.
    The folder is removed by ``release``, or when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark)}/stage-{name}-{uuid.uuid4().hex}"
    with _shuffle_cleanup(spark):
        df.write.parquet(path)
    where, system = _hadoop(spark, path)
    system.deleteOnExit(where)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def release(*staged: DataFrame) -> None:
    """Remove the files of staged tables that no later action reads."""
    for df in staged:
        path = getattr(df, "_staged_at", None)
        if path:
            where, system = _hadoop(df.sparkSession, path)
            system.delete(where, True)
