"""Monitoring and housekeeping operators (row counts, top-k checks, retention,
the profile check, first alerts and tally)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import params, schema
from ..functions import since
from .ingest import critical_filter

def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """UNION ALL of (tbl, row_count) for each named table; each count is one global aggregate."""
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("tbl"), "row_count")
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no tables given")
    return out


def junction_count(hourly: DataFrame) -> DataFrame:
    """Number of junctions that have traffic in the frame."""
    return hourly.agg(F.count_distinct("sensor_id").alias("junctions"))


def alert_tally(readings: DataFrame, max_speed: float = params.CRITICAL_SPEED) -> DataFrame:
    """Messages and alerts per sensor plus a grand-total row (``is_total``).

    The same rows as ``ROLLUP(sensor_id)``, built from the per-sensor counts: a
    rollup runs an Expand that emits every reading once per grouping set before
    aggregating, while here each task pre-counts per sensor and the total is
    summed from the (one row per sensor) result, whose shuffle Spark reuses.
    """
    per = sensor_tally(readings, max_speed)
    total = per.agg(
        F.coalesce(F.sum("messages"), F.lit(0)).alias("messages"),
        F.coalesce(F.sum("alerts"), F.lit(0)).alias("alerts"),
    ).select(F.lit(None).cast("string").alias("sensor_id"), "messages", "alerts", F.lit(True).alias("is_total"))
    return (
        per.withColumn("is_total", F.lit(False))
        .unionByName(total)
        .withColumn("has_alert", F.col("alerts") > 0)
    )


def sensor_tally(readings: DataFrame, max_speed: float = params.CRITICAL_SPEED) -> DataFrame:
    """Running messages / alerts per sensor; a streaming frame runs it in update mode."""
    return readings.groupBy("sensor_id").agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(critical_filter(max_speed)).alias("alerts"),
    )


def latest_alerts(critical_traffic: DataFrame, n: int = 5) -> DataFrame:
    """Newest ``n`` alerts (top-n: per-task candidates, then one merge of n x tasks rows)."""
    return (
        critical_traffic.orderBy(
            F.col("alerted_at").desc(), F.col("sensor_id").asc(), F.col("event_timestamp").desc(), F.col("avg_speed").asc()
        )
        .limit(n)
        .select("sensor_id", "avg_speed", "alerted_at")
    )


def top_congestion_windows(congestion_index: DataFrame, n: int = 4) -> DataFrame:
    """Highest ``n`` congestion indices, ties by sensor then window start."""
    return (
        congestion_index.filter(F.col("congestion_idx").isNotNull())
        .orderBy(F.col("congestion_idx").desc(), F.col("sensor_id").asc(), F.col("window_start").asc())
        .limit(n)
        .select("sensor_id", "window_start", "window_end", "congestion_idx")
    )


def retain(df: DataFrame, time_col: str, as_of=None, keep: str = params.RAW_RETENTION) -> DataFrame:
    """Rows still inside the retention period (``time_col >= as_of - keep``).

    On a date-partitioned table the same cut expressed on the partition column
    drops whole folders; :func:`junctionflow.streaming.sinks.expired_partitions`
    lists those.
    """
    return df.filter(since(time_col, as_of, keep))


def default_profile(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    """Normal operating ranges per sensor (sensor_id, speed_lo, speed_hi, count_lo, count_hi)."""
    return spark.createDataFrame(rows or [], schema.SENSOR_PROFILE)


def sensor_profile_check(readings: DataFrame, profile: DataFrame) -> DataFrame:
    """Flag each reading as inside/outside its sensor's normal speed and count range.

    Sensors missing from the profile get ``profile = 'unknown'`` and NULL flags.
    No hint: AQE broadcasts the profile if its measured size allows, and splits a
    hot sensor's join partition otherwise.
    """
    prof = profile.withColumn("_known", F.lit(True))
    return readings.join(prof, "sensor_id", "left").select(
        "sensor_id",
        "event_time",
        "vehicle_count",
        "avg_speed",
        F.when(F.col("_known"), F.lit("known")).otherwise(F.lit("unknown")).alias("profile"),
        F.col("avg_speed").between(F.col("speed_lo"), F.col("speed_hi")).alias("speed_ok"),
        F.col("vehicle_count").between(F.col("count_lo"), F.col("count_hi")).alias("count_ok"),
    )


def profile_summary(checked: DataFrame) -> DataFrame:
    """Per sensor: readings, in-range speed/count/both counts."""
    return checked.groupBy("sensor_id", "profile").agg(
        F.count(F.lit(1)).alias("readings"),
        F.count_if(F.col("speed_ok")).alias("speed_in_range"),
        F.count_if(F.col("count_ok")).alias("count_in_range"),
        F.count_if(F.col("speed_ok") & F.col("count_ok")).alias("both_in_range"),
    )


def first_n_alerts(critical_traffic: DataFrame, n: int) -> DataFrame:
    """A report of each sensor's ``n`` earliest critical readings (ties: fewer vehicles, then lower speed).

    ``row_number() <= n`` is planned with a partial WindowGroupLimit before the
    shuffle, so a sensor with a third of all alerts still ships only n rows per task.
    """
    w = Window.partitionBy("sensor_id").orderBy(F.col("event_timestamp").asc(), F.col("vehicle_count").asc(), F.col("avg_speed").asc())
    return (
        critical_traffic.withColumn("alert_rank", F.row_number().over(w))
        .filter(F.col("alert_rank") <= n)
        .select("sensor_id", "event_timestamp", "vehicle_count", "avg_speed", "alert_rank")
    )
