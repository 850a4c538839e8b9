"""Rollups by day: what the history charts need, one row a (day, sensor, hour).

A day's rows are sums and counts over all rows of that date, so days do not
overlap whenever the nightly runs, a day that got later rows is replaced whole,
and any set of days folds into the all-history aggregates without reading a
reading again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params
from ..functions import cutoff, ts_literal
from .hourly import PARTITION_OF


def _day(df: DataFrame, time_col: str) -> Column:
    """A row's own day: the date of its folder, or of its time in a table without one."""
    part = PARTITION_OF[time_col]
    return F.col(part) if part in df.columns else F.to_date(time_col)


def day_rollup(traffic_events: DataFrame, critical_traffic: DataFrame, congestion_index: DataFrame) -> DataFrame:
    """report_date, sensor_id, hour: vehicles, speed_sum, readings, alerts, idx_sum, idx_windows (null where a table has no row)
    of all days in the tables, each row counted under its own day."""

    def part(df: DataFrame, time_col: str, *sums) -> DataFrame:
        return df.groupBy(_day(df, time_col).alias("report_date"), "sensor_id", F.hour(time_col).alias("hour")).agg(*sums)

    traffic = part(
        traffic_events,
        "event_timestamp",
        F.sum("vehicle_count").alias("vehicles"),
        F.sum("avg_speed").alias("speed_sum"),
        F.count(F.lit(1)).alias("readings"),
    )
    alerts = part(critical_traffic, "alerted_at", F.count(F.lit(1)).alias("alerts"))
    windows = part(congestion_index, "window_start", F.sum("congestion_idx").alias("idx_sum"), F.count("congestion_idx").alias("idx_windows"))
    # One row a key on each side; the groupings are partitioned by the join keys already.
    keys = ["report_date", "sensor_id", "hour"]
    return traffic.join(alerts, keys, "full").join(windows, keys, "full")


def night_rollup(
    traffic_events: DataFrame,
    critical_traffic: DataFrame,
    congestion_index: DataFrame,
    as_of,
    lookback: str = params.LOOKBACK,
) -> DataFrame:
    """:func:`day_rollup` of the whole days from the one of ``as_of - lookback`` to the last that ended
    by ``as_of``; the tables must hold all rows of these days.
    """

    def cut(df: DataFrame, time_col: str) -> DataFrame:
        day = _day(df, time_col)
        return df.filter((day >= F.to_date(cutoff(as_of, lookback))) & (day < F.to_date(ts_literal(as_of))))

    return day_rollup(cut(traffic_events, "event_timestamp"), cut(critical_traffic, "alerted_at"), cut(congestion_index, "window_start"))


def rollup_hourly(rollup: DataFrame) -> DataFrame:
    """All-history :func:`hourly_traffic` from rollup rows."""
    return (
        rollup.filter("readings > 0")
        .groupBy("sensor_id", "hour")
        .agg(
            F.sum("vehicles").alias("total_vehicles"),
            (F.sum("speed_sum") / F.sum("readings")).alias("avg_speed"),
            F.sum("readings").alias("reading_count"),
        )
    )


def rollup_alerts(rollup: DataFrame) -> DataFrame:
    """All-history alert counts by sensor and hour from rollup rows."""
    return rollup.filter("alerts > 0").groupBy("sensor_id", "hour").agg(F.sum("alerts").alias("alert_count"))


def rollup_congestion(rollup: DataFrame) -> DataFrame:
    """All-history mean congestion index by sensor and hour from rollup rows."""
    mean = F.try_divide(F.sum("idx_sum"), F.sum("idx_windows"))
    return rollup.filter("idx_windows is not null").groupBy("sensor_id", "hour").agg(mean.alias("avg_idx"))


def rollup_congestion_all(rollup: DataFrame) -> DataFrame:
    """All-history :func:`congestion_avg` by sensor from rollup rows: one row a (day, sensor, hour) instead of all windows."""
    mean = F.try_divide(F.sum("idx_sum"), F.sum("idx_windows"))
    return rollup.filter("idx_windows is not null").groupBy("sensor_id").agg(mean.alias("avg_congestion"))
