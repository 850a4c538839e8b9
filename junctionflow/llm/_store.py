"""Intermediate tables in the folder that spark.checkpoint.dir names."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from junctionflow.session import scratch_path
from junctionflow.sources.tables import file_system


#: Rows of narrow tables (ids, hashes) that one task writes to one file.
ROWS_PER_FILE = 500_000


#: Folders and broadcasts that are recorded at the moment, one list for each open :class:`Scratch`.
_open: list[Scratch] = []


class Scratch:
    """What operators leave behind while it is open: tables of the shared folder and broadcasts.

    Their results read these lazily, so only a caller that has written a result,
    or has read it to its end, may :meth:`release` them.
    """

    def __init__(self) -> None:
        self.paths: list[str] = []
        self.sent: list = []

    def __enter__(self) -> Scratch:
        _open.append(self)
        return self

    def __exit__(self, *_) -> None:
        _open.remove(self)

    def release(self, spark: SparkSession) -> None:
        """Delete the tables, destroy the broadcasts, and let the driver's cleaner drop shuffles that no frame refers to."""
        for path in self.paths:
            _delete(spark, path)
        for b in self.sent:
            b.destroy()
        self.paths, self.sent = [], []
        tidy(spark)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def sent(spark: SparkSession, value):
    """A broadcast that the open records know."""
    b = spark.sparkContext.broadcast(value)
    for s in _open:
        s.sent.append(b)
    return b


def discard(*tables: DataFrame) -> None:
    """Delete tables made by :func:`written` that nothing reads any more: all that was made of them is written, too."""
    for t in tables:
        _delete(t.sparkSession, t._scratch)
    tidy(tables[0].sparkSession)


def tidy(spark: SparkSession) -> None:
    """Let the driver's cleaner drop the shuffles of frames that nothing refers to (else they stay until memory is short).

    What the driver's Python and JVM have freed goes back to the system.
    """
    give_back()
    spark.sparkContext._jvm.System.gc()
    trim_jvm(spark)


def trim_jvm(spark: SparkSession) -> str | None:
    """Let the driver's JVM return the memory that it has freed outside its heap (compiled plans and code take and leave much).

    What the JVM says of it; None where it knows no such command (before JDK 17.0.9, other systems than Linux).
    """
    jvm, new_array = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array
    beans = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
    of_name = jvm.java.lang.Class.forName
    # The beans' own class is not open to callers, their interface is.
    kinds = new_array(jvm.java.lang.Class, 4)
    for k, name in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
        kinds[k] = of_name(name)
    given = new_array(jvm.java.lang.Object, 4)
    given[0], given[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    try:
        return of_name("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(beans, given)
    except Py4JJavaError:
        return None


def give_back() -> None:
    """Let this process (the driver's Python or a worker) return the memory that it has freed to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def written(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write df as a parquet table in the shared folder and read it back: cuts lineage, survives lost executors.

    ``rows``, where the caller knows about how many narrow rows there are, sets
    the number of files; else there is one a task.
    """
    path = scratch_path(df.sparkSession, "llm", name)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_PER_FILE)))
    df.write.parquet(path)
    for s in _open:
        s.paths.append(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._scratch = path
    return table


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
