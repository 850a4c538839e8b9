"""One formatted text line per row, built on the executors (no collect)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import hh_mm, round_half_up, thousands

# --- fixed values: line layouts -------------------------------------------
ALERT_LINE = "🚨 ALERT | %-28s | vehicles: %3d | speed: %.1f km/h ← CRITICAL"
WINDOW_LINE = "[Window] %s→%s | %-28s | vehicles: %4d | speed: %5.1f | idx: %.2f"
PEAK_SUMMARY_LINE = "  %-25s | Peak: %02d:00 | Vehicles: %6s | Alerts: %d"
PEAK_LOG_LINE = "Junction %-25s | Peak Hour: %02d:00 | Vehicles: %4d | Alerts: %d | %s"
STATUS_POLICE = "POLICE NEEDED"
STATUS_NORMAL = "✅ Normal"
# ---------------------------------------------------------------------------


def alert_lines(alerts: DataFrame) -> DataFrame:
    return alerts.select(
        "sensor_id",
        "event_timestamp",
        F.format_string(
            ALERT_LINE, F.col("sensor_id"), F.col("vehicle_count"), round_half_up("avg_speed", 1)
        ).alias("line"),
    )


def window_lines(windows: DataFrame) -> DataFrame:
    return windows.select(
        "sensor_id",
        "window_start",
        F.format_string(
            WINDOW_LINE,
            hh_mm("window_start"),
            hh_mm("window_end"),
            F.col("sensor_id"),
            F.col("total_vehicles"),
            round_half_up("avg_speed", 1),
            F.col("congestion_idx"),
        ).alias("line"),
    )


def peak_lines(decisions: DataFrame, style: str = "summary") -> DataFrame:
    """``summary``: console summary with thousands separators; ``log``: per-junction log line."""
    if style == "summary":
        line = F.format_string(
            PEAK_SUMMARY_LINE, F.col("sensor_id"), F.col("peak_hour"), thousands("peak_vehicles"), F.col("alert_count")
        )
    elif style == "log":
        status = F.when(F.col("needs_police"), F.lit(STATUS_POLICE)).otherwise(F.lit(STATUS_NORMAL))
        line = F.format_string(
            PEAK_LOG_LINE, F.col("sensor_id"), F.col("peak_hour"), F.col("peak_vehicles"), F.col("alert_count"), status
        )
    else:
        raise ValueError("style must be 'summary' or 'log'")
    return decisions.select("sensor_id", "peak_vehicles", line.alias("line"))
