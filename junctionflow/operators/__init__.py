"""DataFrame -> DataFrame operators. Each works on batch frames; the stateless
ones and ``congestion_windows`` also work on streaming frames."""

from .decision import (
    append_history,
    daily_peak_rows,
    peak_hour,
    police_decision,
    police_plan,
    rows_to_append,
)
from .frames import (
    alert_hour_map,
    alert_overlay,
    chart_volume,
    congestion_by_hour,
    congestion_series,
    dense_hour_grid,
    dense_peak_hour,
    hourly_series,
    volume_profile,
)
from .hourly import alert_counts, congestion_avg, hourly_report, hourly_traffic
from .ingest import critical_alerts, critical_filter, distinct_readings, raw_events
from .lines import alert_lines, peak_lines, window_lines
from .monitor import (
    alert_tally,
    default_profile,
    first_n_alerts,
    junction_count,
    latest_alerts,
    profile_summary,
    retain,
    sensor_profile_check,
    sensor_tally,
    table_row_counts,
    top_congestion_windows,
)
from .rollup import day_rollup, night_rollup, rollup_alerts, rollup_congestion, rollup_congestion_all, rollup_hourly
from .windows import congestion_windows, readings_for_windows_since

__all__ = [name for name in dir() if not name.startswith("_")]
