"""Chart-ready frames (the data behind the three history charts).

Rendering is the caller's business; these return the exact series a chart
would draw. Per-sensor collections are bounded by the 24 hours of a day: the
inputs are already grouped by (sensor, hour), so no collect holds more than
24 entries regardless of data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params
from ..functions import round_half_up, short_label

HOURS = 24


def _hours() -> Column:
    return F.sequence(F.lit(0), F.lit(HOURS - 1))


def _hour_map(df: DataFrame, value_col: str, name: str) -> DataFrame:
    """sensor_id -> map<hour, value> (at most 24 entries per sensor)."""
    return df.groupBy("sensor_id").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("hour"), F.col(value_col)))).alias(name)
    )


def _dense(map_col: str) -> Column:
    """24-slot array from an hour map, missing hours = 0."""
    return F.transform(
        _hours(), lambda h: F.coalesce(F.try_element_at(F.col(map_col), h), F.lit(0).cast("bigint"))
    )


def _first_argmax(arr: Column) -> Column:
    """Index of the first maximum (lowest hour on ties)."""
    return (F.array_position(arr, F.array_max(arr)) - F.lit(1)).cast("int")


def volume_profile(hourly: DataFrame, vehicles_col: str = "total_vehicles") -> DataFrame:
    """sensor_id, label, vols (24 hourly totals, 0 where no reading), peak_hour."""
    return (
        _hour_map(hourly, vehicles_col, "_vol")
        .select("sensor_id", short_label("sensor_id").alias("label"), _dense("_vol").alias("vols"))
        .withColumn("peak_hour", _first_argmax(F.col("vols")))
    )


def dense_hour_grid(hourly: DataFrame) -> DataFrame:
    """Every sensor x hours 0-23 with vehicles (0 where absent); one row per (label, hour)."""
    return volume_profile(hourly).select(
        "sensor_id", "label", F.posexplode("vols").alias("hour", "vehicles")
    )


def dense_peak_hour(hourly: DataFrame) -> DataFrame:
    """Arg-max over the zero-filled 24-hour series, lowest hour on ties."""
    return volume_profile(hourly).select(
        "sensor_id",
        "label",
        "peak_hour",
        F.element_at("vols", F.col("peak_hour") + 1).alias("peak_vehicles"),
    )


def alert_overlay(alert_hours: DataFrame, hourly: DataFrame, vehicles_col: str = "total_vehicles") -> DataFrame:
    """Alert hours of sensors that have traffic, with bar height = that hour's vehicles (0 if none).

    One inner join on sensor_id against the per-sensor hour map does both the
    semi-join (only sensors present in ``hourly``) and the (sensor, hour) lookup.
    """
    vol = _hour_map(hourly, vehicles_col, "_vol")
    return (
        alert_hours.filter(F.col("hour") < HOURS)
        .join(vol, "sensor_id", "inner")
        .select(
            "sensor_id",
            "hour",
            "alert_count",
            F.coalesce(F.try_element_at(F.col("_vol"), F.col("hour")), F.lit(0).cast("bigint")).alias("height"),
        )
    )


def chart_volume(hourly: DataFrame, alert_hours: DataFrame, vehicles_col: str = "total_vehicles") -> DataFrame:
    """Volume-by-hour frame: 24 rows per sensor with vehicles, alert count and peak flag."""
    alerts = _hour_map(alert_hours.filter(F.col("hour") < HOURS), "alert_count", "_alerts")
    prof = volume_profile(hourly, vehicles_col).join(alerts, "sensor_id", "left")
    return prof.select(
        "sensor_id",
        "label",
        "peak_hour",
        "_alerts",
        F.posexplode("vols").alias("hour", "vehicles"),
    ).select(
        "sensor_id",
        "label",
        "hour",
        "vehicles",
        F.coalesce(F.try_element_at(F.col("_alerts"), F.col("hour")), F.lit(0).cast("bigint")).alias("alert_count"),
        (F.col("hour") == F.col("peak_hour")).alias("is_peak"),
    )


def congestion_by_hour(by_hour: DataFrame, threshold: float = params.CONGESTION_THRESHOLD) -> DataFrame:
    """Mean index per (sensor, hour), its 1-decimal label value and the police threshold line."""
    return by_hour.select(
        "sensor_id",
        short_label("sensor_id").alias("label"),
        "hour",
        "avg_idx",
        round_half_up("avg_idx", 1).alias("idx_label"),
        F.lit(float(threshold)).alias("threshold"),
        (F.col("avg_idx") > F.lit(float(threshold))).alias("over_threshold"),
    )


def hourly_series(hourly_report: DataFrame) -> DataFrame:
    """Per sensor: parallel arrays hours[], vehicles[], speeds[] ordered by hour."""
    s = F.array_sort(F.collect_list(F.struct("hour", "total_vehicles", "avg_speed")))
    return (
        hourly_report.groupBy("sensor_id")
        .agg(s.alias("_s"))
        .select(
            "sensor_id",
            F.col("_s.hour").alias("hours"),
            F.col("_s.total_vehicles").alias("vehicles"),
            F.col("_s.avg_speed").alias("speeds"),
        )
    )


def congestion_series(by_hour: DataFrame, value_col: str = "avg_idx") -> DataFrame:
    """Per sensor: parallel arrays hours[], idx[] ordered by hour."""
    s = F.array_sort(F.collect_list(F.struct(F.col("hour"), F.col(value_col).alias("v"))))
    return (
        by_hour.groupBy("sensor_id")
        .agg(s.alias("_s"))
        .select("sensor_id", F.col("_s.hour").alias("hours"), F.col("_s.v").alias("idx"))
    )


def alert_hour_map(alert_hours: DataFrame) -> DataFrame:
    """Per sensor: map hour -> alert count (keys in hour order)."""
    entries = F.array_sort(F.collect_list(F.struct("hour", "alert_count")))
    return alert_hours.groupBy("sensor_id").agg(F.map_from_entries(entries).alias("alert_hours"))
