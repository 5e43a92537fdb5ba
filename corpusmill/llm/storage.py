"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the session; a temporary one only if none is named and all runs on this machine (tests)."""
    path = spark.conf.get(KEY, None) or spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set {KEY} to a folder that all machines of the cluster share")
        path = "file://" + tempfile.mkdtemp(prefix="corpusmill-")
        spark.sparkContext.setCheckpointDir(path)
        path = spark.sparkContext.getCheckpointDir() or path
    return path.rstrip("/")


#: Paths that materialize() has written since swept() began, innermost last.
_open: list[list[str]] = []


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write df once as Parquet in the shared folder and return the written table, so that lineage ends there.

    Unlike a local checkpoint the copy outlives any executor. It stays until someone deletes it, as discard() and swept() do.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    if _open:
        _open[-1].append(path)
    return out


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def discard(df: DataFrame) -> None:
    """Delete what materialize() wrote for df, once nothing reads it any more."""
    _delete(df.sparkSession, df.written_to)


@contextmanager
def swept(spark: SparkSession):
    """In it, results must be written or read to the end; then the intermediate tables of the operators called in it go.

    It gives a set: of what materialize() wrote, the paths (written_to) put there stay.
    """
    keep: set[str] = set()
    _open.append([])
    try:
        yield keep
    finally:
        made = _open.pop()
        for path in made:
            if path not in keep:
                _delete(spark, path)
            elif _open:
                _open[-1].append(path)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int):
    """In it, Arrow batches have so many rows at most: where rows hold several texts each, the default takes much memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def give_back() -> None:
    """Return what this process has freed to the system; allocators keep it otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU library
        pass


def give_back_driver(spark: SparkSession) -> str | None:
    """give_back() in the driver, and the same in its JVM, whose many short jobs leave freed native memory in all its threads' pools.

    Returns what the JVM says, or None if it has no such command (before 17.0.9, or without the GNU library).
    """
    give_back()
    try:
        lang = spark._jvm.java.lang
        call = next(m for m in lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")  # its class is not open to callers
        given = spark.sparkContext._gateway.new_array(lang.Object, 4)  # no arguments, no signature
        given[0], given[1] = spark._jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        return call.invoke(lang.management.ManagementFactory.getPlatformMBeanServer(), given)
    except Py4JError:
        return None


def frugal(run):
    """The function of batches run; at the end of a task its process, which waits for others next to busy ones, gives memory back."""

    def over(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return over


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
