"""Retention and compaction of the stream tables.

Both work on whole date folders: an expired day is dropped without opening a
file, and the batch folders of a closed day (thousands of small ones) are merged
into one ``run=closed/batch_id=0`` folder. ``settle`` says how long to wait; the
streams of readings and alerts have no watermark and may still write to a day
after that, which the next compaction merges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params
from ..sources.tables import PARTITION_COLUMN, file_system, partition_days, range_start_day, stored_schema, table_path

CLOSED = "run=closed"


def drop_expired(spark: SparkSession, base: str, name: str, as_of, keep: str = params.RAW_RETENTION) -> list[str]:
    """Delete the date folders entirely older than ``as_of - keep``; returns the days."""
    root, part = table_path(base, name), PARTITION_COLUMN[name]
    first = range_start_day(spark, as_of, keep)
    days = [d for d in partition_days(spark, root, part) if d < first]
    for d in days:
        fs, p = file_system(spark, f"{root}/{part}={d}")
        fs.delete(p, True)
    return days


def _folders(spark: SparkSession, path: str) -> list[str]:
    fs, p = file_system(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()) if fs.exists(p) else []


def _write_lines(spark: SparkSession, path: str, lines: list[str]) -> None:
    fs, p = file_system(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray("\n".join(lines).encode()))
    finally:
        out.close()


def _read_lines(spark: SparkSession, path: str) -> list[str]:
    fs, p = file_system(spark, path)
    stream = fs.open(p)  # not by a reader of Spark, which skips a name that starts with "_"
    try:
        return str(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")).split("\n")
    finally:
        stream.close()


def _copied(spark: SparkSession, name: str, rows: DataFrame, aside: str, columns: list[str]) -> list[str]:
    """Batch folders whose every row is in a copy that has no list beside it (of a version that wrote none)."""
    copy = spark.read.schema(stored_schema(name)).parquet(aside).select(*(F.col(c).alias(f"__{c}") for c in columns))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in columns))
    batches = rows.select("run", "batch_id").distinct()
    later = rows.join(copy, same, "left_anti").select("run", "batch_id").distinct()
    return [f"run={r.run}/batch_id={r.batch_id}" for r in batches.join(later, ["run", "batch_id"], "left_anti").collect()]


def day_batches(spark: SparkSession, base: str, name: str, day: str) -> list[str]:
    """The batch folders (``run=R/batch_id=N``) of one day."""
    folder = f"{table_path(base, name)}/{PARTITION_COLUMN[name]}={day}"
    return [f"{r}/{b}" for r in _folders(spark, folder) if r.startswith("run=") for b in _folders(spark, f"{folder}/{r}")]


def swap_is_open(spark: SparkSession, base: str, name: str, day: str) -> bool:
    """Whether a merged folder of the day waits aside for its place (:func:`compact_day` ends the swap)."""
    fs, done = file_system(spark, f"{table_path(base, name)}/_closing_{day}/_SUCCESS")
    return fs.exists(done)


def put_aside(spark: SparkSession, base: str, name: str, day: str, folder: str, batches: list[str]) -> None:
    """Hand over ``folder``, which holds what shall take the place of the day's ``batches``, to :func:`compact_day`."""
    root = table_path(base, name)
    aside = f"{root}/_closing_{day}"
    _write_lines(spark, f"{aside}_batches", batches)
    fs, p = file_system(spark, aside)
    fs.delete(p, True)
    if not fs.rename(file_system(spark, folder)[1], p):
        raise OSError(f"{folder} could not be put aside as {aside}")
    _write_lines(spark, f"{aside}/_SUCCESS", [])


def compact_day(spark: SparkSession, base: str, name: str, day: str, file_bytes: int = 256 << 20, only: list[str] | None = None) -> int:
    """Merge one day's batch folders; returns how many there were (0: nothing to do).

    ``only`` names the batch folders to merge (one is enough, if it is not the
    merged one); else all are, if there are at least two.

    The batch folders are listed, the list is written aside and their rows are
    merged aside; then exactly the listed folders go and the merged one takes
    their place. A batch that is stored meanwhile is in no list: it stays for the
    next compaction. A job that dies in between leaves list and copy behind
    (their names start with "_", which readers skip); the next run finishes the
    swap by the list, so no row is lost or doubled.
    """
    part = PARTITION_COLUMN[name]
    root = table_path(base, name)
    folder, aside, listed = f"{root}/{part}={day}", f"{root}/_closing_{day}", f"{root}/_closing_{day}_batches"
    fs, done = file_system(spark, f"{aside}/_SUCCESS")
    reader = spark.read.schema(stored_schema(name)).option("basePath", root)
    columns = [f.name for f in stored_schema(name).fields if f.name not in (part, "run", "batch_id")]
    if not fs.exists(done):
        batches = day_batches(spark, base, name, day)
        if only is not None:  # the merged folder of an earlier pass takes part, as the new one takes its place
            batches = [b for b in batches if b in only or b.startswith(CLOSED + "/")]
        if len(batches) < (1 if only is not None else 2) or batches == [f"{CLOSED}/batch_id=0"]:
            return 0
        _write_lines(spark, listed, batches)
        rows: DataFrame = reader.parquet(*(f"{folder}/{b}" for b in batches)).select(*columns)
        size = sum(fs.getContentSummary(file_system(spark, f"{folder}/{b}")[1]).getLength() for b in batches)
        rows.repartition(max(1, -(-size // file_bytes))).write.mode("overwrite").parquet(aside)
        merged = len(batches)
    elif fs.exists(file_system(spark, listed)[1]):
        batches = _read_lines(spark, listed)
        merged = len(batches)
    else:
        batches = _copied(spark, name, reader.parquet(folder), aside, columns) if _folders(spark, folder) else []
        merged = len({b.partition("/")[0] for b in batches})
    for b in batches:
        fs.delete(file_system(spark, f"{folder}/{b}")[1], True)
    fs.mkdirs(file_system(spark, f"{folder}/{CLOSED}")[1])
    if not fs.rename(file_system(spark, aside)[1], file_system(spark, f"{folder}/{CLOSED}/batch_id=0")[1]):
        raise OSError(f"{aside} could not take its place in {folder}")
    fs.delete(file_system(spark, listed)[1], False)
    return merged


def compact_closed_days(spark: SparkSession, base: str, name: str, as_of, settle: str = "1 day") -> dict[str, int]:
    """Compact every day that ended at least ``settle`` before ``as_of``; folders merged by day."""
    first_open = range_start_day(spark, as_of, settle)
    days = partition_days(spark, table_path(base, name), PARTITION_COLUMN[name])
    merged = {d: compact_day(spark, base, name, d) for d in days if d < first_open}
    return {d: n for d, n in merged.items() if n}
