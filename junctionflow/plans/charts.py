"""The three history charts as one job of DataFrames (rendering is the caller's)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import params
from ..operators import (
    alert_counts,
    chart_volume,
    congestion_avg,
    congestion_by_hour,
    dense_hour_grid,
    hourly_report,
    hourly_traffic,
    rollup_alerts,
    rollup_congestion,
    rollup_hourly,
)


def chart_frames(
    traffic_events: DataFrame,
    critical_traffic: DataFrame,
    congestion_index: DataFrame,
    threshold: float = params.CONGESTION_THRESHOLD,
) -> dict[str, DataFrame]:
    """volume_by_hour (C1), comparison (C2) and congestion_index (C3) over all history."""
    hourly = hourly_report(hourly_traffic(traffic_events, lookback=None))
    alerts = alert_counts(critical_traffic, lookback=None, by_hour=True)
    by_hour = congestion_avg(congestion_index, lookback=None, by_hour=True)
    return {
        "volume_by_hour": chart_volume(hourly, alerts),
        "comparison": dense_hour_grid(hourly),
        "congestion_index": congestion_by_hour(by_hour, threshold),
    }


def chart_frames_from_rollup(rollup: DataFrame, threshold: float = params.CONGESTION_THRESHOLD) -> dict[str, DataFrame]:
    """The same frames folded from the nightly rollup: no reading is read again."""
    hourly = hourly_report(rollup_hourly(rollup))
    return {
        "volume_by_hour": chart_volume(hourly, rollup_alerts(rollup)),
        "comparison": dense_hour_grid(hourly),
        "congestion_index": congestion_by_hour(rollup_congestion(rollup), threshold),
    }


def write_charts(frames: dict[str, DataFrame], out: str) -> None:
    """One parquet folder per chart; skipped entirely when there is no traffic."""
    if frames["comparison"].isEmpty():
        return
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{out.rstrip('/')}/{name}")
