"""The nightly decision from co-located tables: hourly sums bucketed by sensor.

The nightly groups and joins three tables by sensor. Stored as they come, each is
shuffled every night. Here each closed day is stored once more as sums by sensor
and hour, in date folders and bucketed by sensor, so that grouping by sensor,
ranking its hours and joining the three tables all find their rows in place:
a night reads two date folders and shuffles nothing.

What is bucketed are sums: a sensor that holds a third of all readings has 24
rows a day like any other, so no bucket is hot. Readings themselves are shuffled
once, as partial aggregates, when their day is stored.
"""

from __future__ import annotations

from collections.abc import Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params
from ..functions import cutoff, since
from ..operators import peak_hour, police_decision

#: Time column and sums of each table.
SUMS = {
    "traffic_events": (
        "event_timestamp",
        {"vehicles": F.sum, "speed_sum": F.sum, "speeds": F.count, "readings": F.count},
        {"vehicles": "vehicle_count", "speed_sum": "avg_speed", "speeds": "avg_speed", "readings": "event_timestamp"},
    ),
    "critical_traffic": ("alerted_at", {"alerts": F.count}, {"alerts": "alerted_at"}),
    "congestion_index": ("window_start", {"idx_sum": F.sum, "idx_windows": F.count}, {"idx_sum": "congestion_idx", "idx_windows": "congestion_idx"}),
}


def hour_sums(df: DataFrame, name: str) -> DataFrame:
    """sensor_id, hour_start, the table's sums, and their day (last, as the partition column)."""
    time_col, how, of = SUMS[name]
    sums = [fn(of[c]).alias(c) for c, fn in how.items()]
    hours = df.filter(F.col(time_col).isNotNull()).groupBy("sensor_id", F.date_trunc("hour", time_col).alias("hour_start")).agg(*sums)
    return hours.withColumn("event_date", F.to_date("hour_start"))


def store_hours(spark: SparkSession, tables: Mapping[str, DataFrame], prefix: str, location: str, buckets: int) -> None:
    """Replace the days that ``tables`` hold (all rows of each) in the catalog tables ``<prefix>_<name>``.

    A table that does not exist yet is made, in ``location``. All tables of one
    prefix have the same number of buckets, which stays; a day is one file a bucket.
    A day that is stored again replaces itself, so a retried job adds nothing.
    """
    for name, df in tables.items():
        rows, table = hour_sums(df, name), f"{prefix}_{name}"
        if not spark.catalog.tableExists(table):
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
            spark.sql(
                f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY (event_date) "
                f"CLUSTERED BY (sensor_id) SORTED BY (sensor_id) INTO {int(buckets)} BUCKETS LOCATION '{location}/{name}'"
            )
        with _dynamic_overwrite(spark):
            rows.repartition(buckets, "sensor_id").write.insertInto(table, overwrite=True)


@contextmanager
def _dynamic_overwrite(spark: SparkSession):
    """Only the days that are written are replaced (an insert into a table takes this from the session alone)."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _night(spark: SparkSession, prefix: str, name: str, as_of, lookback: str) -> DataFrame:
    rows = spark.table(f"{prefix}_{name}")
    return rows.filter(since("hour_start", as_of, lookback) & (F.col("event_date") >= F.to_date(cutoff(as_of, lookback))))


def colocated_decision(
    spark: SparkSession,
    prefix: str,
    as_of,
    lookback: str = params.LOOKBACK,
    rule: params.PoliceRule = params.PoliceRule(),
) -> DataFrame:
    """:func:`..operators.police_decision` from the tables of :func:`store_hours`, without an exchange.

    Sums are by whole hours, so ``as_of`` has to be one (and ``lookback`` whole hours).
    The joins are merge joins by hint: both sides are in place, at any size.
    """
    cut = spark.range(1).select((F.date_trunc("hour", cutoff(as_of, lookback)) == cutoff(as_of, lookback)).alias("whole")).first()
    if not cut.whole:
        raise ValueError(f"sums by hour start at whole hours: {as_of} - {lookback} is none")
    hour = F.hour("hour_start").alias("hour")
    traffic = _night(spark, prefix, "traffic_events", as_of, lookback)
    hourly = traffic.groupBy("sensor_id", hour).agg(
        F.sum("vehicles").alias("total_vehicles"),
        F.try_divide(F.sum("speed_sum"), F.sum("speeds")).alias("avg_speed"),
        F.sum("readings").alias("reading_count"),
    )
    alerts = _night(spark, prefix, "critical_traffic", as_of, lookback).groupBy("sensor_id").agg(F.sum("alerts").alias("alert_count"))
    windows = _night(spark, prefix, "congestion_index", as_of, lookback)
    means = windows.groupBy("sensor_id").agg(F.try_divide(F.sum("idx_sum"), F.sum("idx_windows")).alias("avg_congestion"))
    return police_decision(peak_hour(hourly), alerts.hint("merge"), means.hint("merge"), rule=rule)
