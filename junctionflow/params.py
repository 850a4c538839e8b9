"""Thresholds and defaults.

Every value below is a keyword default of some operator; callers override them
per call. They are collected here so a deployment can see the whole rule set.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values (must equal the original pipeline's settings) -------------
CRITICAL_SPEED = 10.0            # alert when avg_speed < this (strict)
WINDOW_SIZE = "5 minutes"        # tumbling congestion window
WATERMARK = "10 minutes"         # event-time lateness allowed for windows
CONGESTION_THRESHOLD = 8.0       # police when mean index > this (strict)
ALERTS_AT_LEAST = 2              # police when alert count >= this
PEAK_SPEED_BELOW = 15.0          # police when peak-hour mean speed < this (strict)
LOOKBACK = "24 hours"            # nightly trailing range, lower bound inclusive
RAW_RETENTION = "90 days"        # raw readings kept this long
AGGREGATE_RETENTION = "2 years"  # windows / history kept this long
ALERT_MESSAGE = "CRITICAL: avg_speed below 10 km/h"
LABEL_PREFIX = "Junction_"       # stripped for short chart labels
TRIGGER_RAW = "10 seconds"
TRIGGER_ALERTS = "5 seconds"
TRIGGER_WINDOWS = "30 seconds"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class PoliceRule:
    """The three-way OR that decides whether a junction needs police."""

    index_gt: float = CONGESTION_THRESHOLD
    alerts_ge: int = ALERTS_AT_LEAST
    speed_lt: float = PEAK_SPEED_BELOW
