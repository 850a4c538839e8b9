"""Nightly aggregates: hourly traffic, alert counts, mean congestion.

"Hour" is the hour of day (0-23), not a truncated timestamp: a 24 h range that
straddles midnight folds its partial first and last hour into one bucket, and
the all-history variants fold every day into 24 buckets.

Every grouping here is a hash aggregate with a partial (map-side) step, so a
sensor holding a third of all rows still ships at most (sensors x 24) partial
rows per task into the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params
from ..functions import cutoff, round_half_up, since

# Date partition column the sinks write next to each time column.
PARTITION_OF = {"event_timestamp": "event_date", "alerted_at": "alert_date", "window_start": "window_date"}


def _in_range(df: DataFrame, time_col: str, as_of, lookback: str | None) -> DataFrame:
    """Trailing filter on the time column, plus the same cut on the date partition
    column when the frame has one (so a partitioned table is pruned to the last
    day or two of folders before any file is opened)."""
    out = df.filter(since(time_col, as_of, lookback))
    part = PARTITION_OF.get(time_col)
    if lookback is not None and part in df.columns:
        out = out.filter(F.col(part) >= F.to_date(cutoff(as_of, lookback)))
    return out


def _keys(time_col: str, by_hour: bool):
    keys = [F.col("sensor_id")]
    if by_hour:
        keys.append(F.hour(time_col).alias("hour"))
    return keys


def hourly_traffic(
    traffic_events: DataFrame,
    as_of=None,
    lookback: str | None = params.LOOKBACK,
) -> DataFrame:
    """(sensor_id, hour) -> total_vehicles BIGINT, avg_speed DOUBLE (exact mean), reading_count BIGINT."""
    return (
        _in_range(traffic_events, "event_timestamp", as_of, lookback)
        .groupBy(*_keys("event_timestamp", True))
        .agg(
            F.sum("vehicle_count").alias("total_vehicles"),
            F.avg("avg_speed").alias("avg_speed"),
            F.count(F.lit(1)).alias("reading_count"),
        )
    )


def hourly_report(hourly: DataFrame, decimals: int = 1) -> DataFrame:
    """Report form of :func:`hourly_traffic`: mean speed rounded (numeric rounding)."""
    return hourly.select(
        "sensor_id",
        "hour",
        "total_vehicles",
        round_half_up("avg_speed", decimals).alias("avg_speed"),
        F.col("reading_count").alias("readings"),
    )


def alert_counts(
    critical_traffic: DataFrame,
    as_of=None,
    lookback: str | None = params.LOOKBACK,
    by_hour: bool = False,
) -> DataFrame:
    """Alerts per sensor (or per sensor and hour), filtered on ``alerted_at``."""
    return (
        _in_range(critical_traffic, "alerted_at", as_of, lookback)
        .groupBy(*_keys("alerted_at", by_hour))
        .agg(F.count(F.lit(1)).alias("alert_count"))
    )


def congestion_avg(
    congestion_index: DataFrame,
    as_of=None,
    lookback: str | None = params.LOOKBACK,
    by_hour: bool = False,
) -> DataFrame:
    """Mean congestion index per sensor (or per sensor and hour of ``window_start``)."""
    name = "avg_idx" if by_hour else "avg_congestion"
    return (
        _in_range(congestion_index, "window_start", as_of, lookback)
        .groupBy(*_keys("window_start", by_hour))
        .agg(F.avg("congestion_idx").alias(name))
    )
