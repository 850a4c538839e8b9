"""Event-time congestion windows (stream and batch share this one function)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params
from ..functions import cutoff, round_half_up, safe_div


def congestion_windows(
    readings: DataFrame,
    window: str = params.WINDOW_SIZE,
    watermark: str | None = params.WATERMARK,
    time_col: str = "event_time",
) -> DataFrame:
    """Tumbling windows per sensor: vehicle total, mean speed, congestion index.

    The index divides by the *rounded* mean speed, then rounds again, as the
    original does; a zero mean speed gives a NULL index instead of an error.
    Aggregation is partial per task before the shuffle on (sensor, window), so
    a hot sensor only sends one partial row per window per task.
    """
    df = readings.withWatermark(time_col, watermark) if watermark else readings
    speed = round_half_up(F.col("mean_speed"), 2)
    return (
        df.groupBy("sensor_id", F.window(time_col, window).alias("w"))
        .agg(
            F.sum("vehicle_count").alias("total_vehicles"),
            F.avg("avg_speed").alias("mean_speed"),
        )
        .select(
            "sensor_id",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "total_vehicles",
            speed.alias("avg_speed"),
            round_half_up(safe_div(F.col("total_vehicles"), speed), 2).alias("congestion_idx"),
        )
    )


def window_micros(window: str) -> int:
    """Length of a ``"<n> <unit>"`` window in microseconds (seconds/minutes/hours/days)."""
    n, unit = window.split()
    scale = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return int(n) * scale * 1_000_000


def readings_for_windows_since(
    readings: DataFrame,
    as_of,
    lookback: str,
    window: str = params.WINDOW_SIZE,
    time_col: str = "event_time",
) -> DataFrame:
    """Readings that fall in tumbling windows starting at or after ``as_of - lookback``.

    For epoch-aligned tumbling windows ``window_start >= c`` holds exactly when
    ``t >= ceil_to_window(c)``, so the window-start range becomes a plain time
    filter that Catalyst folds to a literal and pushes into the scan, instead
    of windowing all history and filtering afterwards. Kept windows are whole.
    """
    w = window_micros(window)
    start = F.unix_micros(cutoff(as_of, lookback))
    aligned = F.timestamp_micros(((start + F.lit(w - 1)) / F.lit(w)).cast("bigint") * F.lit(w))
    return readings.filter(F.col(time_col) >= aligned)
