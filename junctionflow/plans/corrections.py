"""Windows of closed days, corrected by the readings that came too late for them.

The window stream drops a reading whose window the watermark has closed, while
the raw table keeps it; windows that were open when a stream ended, or that two
runs of a stream emitted, are wrong in the table as well. A closed day that has
batches which were stored since its last correction is looked at again: its
windows are computed from its raw rows and held against the stored ones, and
only windows that differ are replaced. All such days go through one job; each
day's folder is then swapped as :func:`.housekeeping.compact_day` does it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params
from ..operators.windows import congestion_windows, window_micros
from ..sources.tables import PARTITION_COLUMN, file_system, partition_days, range_start_day, read_days, stored_schema, table_path
from .housekeeping import CLOSED, compact_day, day_batches, put_aside, swap_is_open

RAW, WINDOWS = "traffic_events", "congestion_index"
KEY = ["sensor_id", "window_start"]
VALUES = ["window_end", "total_vehicles", "avg_speed", "congestion_idx"]


def corrected(fresh: DataFrame, stored: DataFrame, at: Column) -> DataFrame:
    """One row a window: the stored one where it is right, else the one computed from the raw rows, created ``at``.

    A stored window without raw rows stays (its readings may be past their
    retention), the newest of several. Both sides come to the join as one row a
    window, partitioned by its key already.
    """
    columns = [*VALUES, "created_at"]
    held = stored.groupBy(*KEY).agg(F.count(F.lit(1)).alias("copies"), F.max_by(F.struct(*columns), F.coalesce("created_at", F.lit(0).cast("timestamp"))).alias("was"))
    new = fresh.select(*KEY, F.struct(*VALUES, at.alias("created_at")).alias("now"))
    same = F.lit(True)
    for c in VALUES:
        same = same & F.col(f"was.{c}").eqNullSafe(F.col(f"now.{c}"))
    replaced = F.col("now").isNotNull() & ~(F.coalesce(F.col("copies"), F.lit(0)).eqNullSafe(1) & same)
    row = F.when(replaced, F.col("now")).otherwise(F.col("was"))
    return held.join(new, KEY, "full_outer").select(*KEY, row.alias("row")).select(*KEY, "row.*")


def _open(batches: list[str]) -> bool:
    return any(not b.startswith(CLOSED + "/") for b in batches)


def correct_windows(spark: SparkSession, base: str, as_of, settle: str = "1 day", window: str = params.WINDOW_SIZE) -> dict[str, int]:
    """Correct the stored windows of every day that ended ``settle`` before ``as_of``; replaced windows by day looked at.

    Looked at are days whose raw rows or windows are not all in the merged
    folder of an earlier pass. ``settle`` leaves the stream time to store the
    day's last windows; one that comes later is seen by the next pass. Merge the
    raw batches that were there before the call (``compact_day(..., only=...)``)
    after it, and they are not looked at again.
    """
    root, part = table_path(base, WINDOWS), PARTITION_COLUMN[WINDOWS]
    first_open = range_start_day(spark, as_of, settle)
    raw_days = [d for d in partition_days(spark, table_path(base, RAW), PARTITION_COLUMN[RAW]) if d < first_open]
    for d in raw_days:
        if swap_is_open(spark, base, WINDOWS, d):
            compact_day(spark, base, WINDOWS, d)
    listed = {d: day_batches(spark, base, WINDOWS, d) for d in raw_days}
    days = [d for d in raw_days if _open(listed[d]) or _open(day_batches(spark, base, RAW, d))]
    if not days:
        return {}
    # A window belongs to the day of its start; where windows do not divide a day, its last one holds readings of the next.
    apart = window_micros(window) and 86_400_000_000 % window_micros(window) == 0
    raw = read_days(spark, RAW, base, days if apart else raw_days)
    fresh = congestion_windows(raw.withColumnRenamed("event_timestamp", "event_time"), window, watermark=None).filter(F.date_format("window_start", "yyyy-MM-dd").isin(days))
    folders = [f"{root}/{part}={d}/{b}" for d in days for b in listed[d]]
    reader = spark.read.schema(stored_schema(WINDOWS)).option("basePath", root)
    stored = reader.parquet(*folders) if folders else spark.createDataFrame([], stored_schema(WINDOWS))
    aside = f"{root}/_correcting_{uuid.uuid4().hex[:12]}"
    at = F.timestamp_micros(F.lit(spark.range(1).select(F.unix_micros(F.current_timestamp())).first()[0]))
    out = corrected(fresh, stored, at).withColumn(part, F.to_date("window_start"))
    out.hint("rebalance", part).write.partitionBy(part).parquet(aside)
    day = F.date_format(part, "yyyy-MM-dd").alias("day")
    replaced = {r.day: r.n for r in spark.read.schema(out.schema).parquet(aside).groupBy(day).agg(F.count_if(F.col("created_at") == at).alias("n")).collect()}
    fs, p = file_system(spark, aside)
    for d in days:
        if d in replaced and (replaced[d] or _open(listed[d])):
            put_aside(spark, base, WINDOWS, d, f"{aside}/{part}={d}", listed[d])
            compact_day(spark, base, WINDOWS, d)
    fs.delete(p, True)
    return {d: replaced.get(d, 0) for d in days}


def close_days(spark: SparkSession, base: str, as_of, settle: str = "1 day") -> dict[str, int]:
    """Correct the windows of closed days, then merge the raw batches that were looked at; replaced windows by day."""
    first_open = range_start_day(spark, as_of, settle)
    days = [d for d in partition_days(spark, table_path(base, RAW), PARTITION_COLUMN[RAW]) if d < first_open]
    before = {d: day_batches(spark, base, RAW, d) for d in days}
    replaced = correct_windows(spark, base, as_of, settle)
    for d in days:
        if swap_is_open(spark, base, RAW, d):
            compact_day(spark, base, RAW, d)  # ends an earlier pass's swap; the batches of this one wait for the next
        elif _open(before[d]):
            compact_day(spark, base, RAW, d, only=before[d])
    return replaced
