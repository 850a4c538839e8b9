"""Independent SQL twins of the registered queries (DuckDB dialect).

Written from the operator semantics, not generated from the Spark plans; the
only shared pieces are the fixed values (thresholds, layouts, dates). Each text
runs on the pre-registered ``events`` view.
"""

from __future__ import annotations

from .. import params
from ..operators import lines as L
from . import catalog as C
from . import report as R


def rnd(expr: str, n: int) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,10)), {n}) AS DOUBLE)"


AS_OF = f"TIMESTAMP '{C.AS_OF}'"
PREV_AS_OF = f"TIMESTAMP '{C.PREVIOUS_AS_OF}'"
CUT = f"{AS_OF} - INTERVAL 24 HOUR"
PROFILE_VALUES = ", ".join(f"('{s}', {a}, {b}, {c}, {d})" for s, a, b, c, d in C.PROFILE)


def base(sensor: str = "event_type") -> str:
    """readings / traffic / alerts / windows as CTEs (no WITH keyword)."""
    sid = {"user_id": "CAST(user_id AS VARCHAR)", "junction": "'Junction_' || event_type"}.get(sensor, "event_type")
    return f"""
readings AS (
  SELECT {sid} AS sensor_id, ts AS event_time,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS vehicle_count,
         value AS avg_speed
  FROM events),
traffic AS (
  SELECT sensor_id, event_time AS event_timestamp, vehicle_count, avg_speed, event_time AS ingested_at
  FROM readings),
alerts AS (
  SELECT sensor_id, event_time AS event_timestamp, vehicle_count, avg_speed,
         '{params.ALERT_MESSAGE}' AS alert_message, event_time AS alerted_at
  FROM readings WHERE avg_speed < {params.CRITICAL_SPEED}),
win_raw AS (
  SELECT sensor_id, time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start,
         CAST(SUM(vehicle_count) AS BIGINT) AS total_vehicles,
         {rnd('AVG(avg_speed)', 2)} AS avg_speed
  FROM readings GROUP BY 1, 2),
windows AS (
  SELECT sensor_id, window_start, window_start + INTERVAL 5 MINUTE AS window_end, total_vehicles, avg_speed,
         {rnd('total_vehicles / NULLIF(avg_speed, 0)', 2)} AS congestion_idx
  FROM win_raw)"""


def hourly_cte(name: str, as_of: str | None) -> str:
    where = f"WHERE event_timestamp >= {as_of} - INTERVAL 24 HOUR" if as_of else ""
    return f"""
{name} AS (
  SELECT sensor_id, CAST(EXTRACT(hour FROM event_timestamp) AS INTEGER) AS hour,
         CAST(SUM(vehicle_count) AS BIGINT) AS total_vehicles,
         AVG(avg_speed) AS avg_speed, COUNT(*) AS reading_count
  FROM traffic {where} GROUP BY 1, 2)"""


def decisions_cte(name: str, variant: str = "rule", as_of: str = AS_OF, quiet: bool = False) -> str:
    cong_where = f"WHERE window_start >= {as_of} - INTERVAL 24 HOUR" if variant == "rule" else ""
    if variant == "rule":
        flag = (
            f"(COALESCE(c.avg_congestion, 0.0) > {params.CONGESTION_THRESHOLD} "
            f"OR COALESCE(a.alert_count, 0) >= {params.ALERTS_AT_LEAST} "
            f"OR p.avg_speed < {params.PEAK_SPEED_BELOW})"
        )
    else:
        flag = "TRUE"
    if quiet:
        flag = "FALSE"
    return f"""{hourly_cte(name + '_hourly', as_of)},
{name}_peaks AS (
  SELECT sensor_id, hour AS peak_hour, total_vehicles AS peak_vehicles, avg_speed, reading_count
  FROM (SELECT *, row_number() OVER (PARTITION BY sensor_id ORDER BY total_vehicles DESC, hour) AS rn
        FROM {name}_hourly) WHERE rn = 1),
{name}_alerts AS (
  SELECT sensor_id, COUNT(*) AS alert_count FROM alerts
  WHERE alerted_at >= {as_of} - INTERVAL 24 HOUR GROUP BY 1),
{name}_cong AS (
  SELECT sensor_id, AVG(congestion_idx) AS avg_congestion FROM windows {cong_where} GROUP BY 1),
{name} AS (
  SELECT p.sensor_id, p.peak_hour, p.peak_vehicles, p.avg_speed,
         COALESCE(a.alert_count, 0) AS alert_count,
         COALESCE(c.avg_congestion, 0.0) AS avg_congestion,
         {flag} AS needs_police
  FROM {name}_peaks p
  LEFT JOIN {name}_alerts a ON a.sensor_id = p.sensor_id
  LEFT JOIN {name}_cong c ON c.sensor_id = p.sensor_id)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


DECISION_COLS = f"""sensor_id, peak_hour, peak_vehicles, {rnd('avg_speed', 6)} AS avg_speed,
       alert_count, {rnd('avg_congestion', 6)} AS avg_congestion, needs_police"""

HISTORY_COLS = f"report_date, sensor_id, peak_hour, peak_vehicles, {rnd('avg_congestion', 6)} AS avg_congestion, needs_police"

HOURLY_ALL = f"""
hourly_all AS (
  SELECT sensor_id, CAST(EXTRACT(hour FROM event_timestamp) AS INTEGER) AS hour,
         CAST(SUM(vehicle_count) AS BIGINT) AS total_vehicles,
         {rnd('AVG(avg_speed)', 1)} AS avg_speed, COUNT(*) AS readings
  FROM traffic GROUP BY 1, 2)"""

ALERT_HOURS = """
alert_hours AS (
  SELECT sensor_id, CAST(EXTRACT(hour FROM alerted_at) AS INTEGER) AS hour, COUNT(*) AS alert_count
  FROM alerts GROUP BY 1, 2)"""

CONG_HOURS = f"""
cong_hours AS (
  SELECT sensor_id, CAST(EXTRACT(hour FROM window_start) AS INTEGER) AS hour,
         {rnd('AVG(congestion_idx)', 6)} AS avg_idx
  FROM windows GROUP BY 1, 2)"""

GRID = f"""
grid AS (
  SELECT s.sensor_id, replace(s.sensor_id, '{params.LABEL_PREFIX}', '') AS label, CAST(r.range AS INTEGER) AS hour,
         COALESCE(h.total_vehicles, 0) AS vehicles
  FROM (SELECT DISTINCT sensor_id FROM hourly_all) s
  CROSS JOIN range(24) r
  LEFT JOIN hourly_all h ON h.sensor_id = s.sensor_id AND h.hour = r.range),
grid_peak AS (
  SELECT sensor_id, label, hour AS peak_hour, vehicles AS peak_vehicles
  FROM (SELECT *, row_number() OVER (PARTITION BY sensor_id ORDER BY vehicles DESC, hour) AS rn FROM grid)
  WHERE rn = 1)"""


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def report_sql(variant: str, sensor: str = "event_type", quiet: bool = False) -> str:
    eq = "=" * R.RULE_WIDTH
    dash = "-" * R.RULE_WIDTH
    header = [eq, f"  {R.DEFAULT_TITLE}", f"  Generated: {C.GENERATED}", eq, "", R.SUMMARY_HEADING, dash]

    def fixed(section: int, lines: list[str]) -> str:
        rows = ", ".join(f"({i}, {_lit(s)})" for i, s in enumerate(lines))
        return (
            f"SELECT {section} AS section, CAST(0 AS BIGINT) AS sort_key, '' AS sensor_id, "
            f"CAST(i AS INTEGER) AS line_no, line FROM (VALUES {rows}) t(i, line)"
        )

    vehicles = "format('{:,}', peak_vehicles)" if variant == "all" else "CAST(peak_vehicles AS VARCHAR)"
    block_lines = [
        "'Junction  : ' || sensor_id",
        "printf('Peak Hour : %02d:00 - %02d:00', peak_hour, peak_hour + 1)",
        f"'Vehicles  : ' || {vehicles}",
        f"'Avg Speed : ' || printf('%.1f', {rnd('avg_speed', 1)}) || ' km/h'",
        "printf('Alerts    : %d critical alerts', alert_count)",
        f"'Status    : ' || CASE WHEN needs_police THEN {_lit(R.STATUS_YES)} ELSE {_lit(R.STATUS_NO)} END",
        _lit(dash),
    ]
    blocks = " UNION ALL ".join(
        f"SELECT {R.SECTION_BLOCKS} AS section, -peak_vehicles AS sort_key, sensor_id, {i} AS line_no, {expr} AS line FROM d"
        for i, expr in enumerate(block_lines)
    )
    key = "-peak_vehicles" if variant == "all" else "CAST(0 AS BIGINT)"
    plan = (
        f"SELECT {R.SECTION_PLAN} AS section, {key} AS sort_key, sensor_id, 0 AS line_no, "
        f"printf('  {R.ARROW[variant]} Deploy to %s by %02d:00', sensor_id, peak_hour) AS line FROM d WHERE needs_police"
    )
    parts = [
        fixed(R.SECTION_HEADER, header),
        blocks,
        fixed(R.SECTION_PLAN_HEAD, ["", R.PLAN_HEADING, eq]),
        plan,
        fixed(R.SECTION_FOOTER, ["", eq]),
    ]
    if variant == "rule":
        parts.append(
            f"SELECT {R.SECTION_FALLBACK} AS section, CAST(0 AS BIGINT) AS sort_key, '' AS sensor_id, 0 AS line_no, "
            f"{_lit('  ' + R.ARROW[variant] + ' ' + R.NO_PLAN)} AS line "
            "FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE needs_police) AS f FROM d) WHERE n > 0 AND f = 0"
        )
    return with_(base(sensor), decisions_cte("d", variant, quiet=quiet)) + "\nUNION ALL\n".join(parts)


def sql_queries() -> dict[str, str]:
    b = base()
    q: dict[str, str] = {}

    q["parse_readings"] = with_(b) + """
SELECT event_type AS sensor_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp",
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS vehicle_count,
       value AS avg_speed, ts AS event_time
FROM events"""

    q["payload_peek"] = """
SELECT event_id AS "offset",
       '{"sensor_id":"' || event_type || '","timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
       || '","vehicle_count":' || CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR)
       || ',"avg_speed":' || CAST(value AS VARCHAR) || '}' AS value
FROM events ORDER BY event_id LIMIT 5"""

    q["raw_events"] = with_(b) + "SELECT * FROM traffic"
    q["critical_alerts"] = with_(b) + "SELECT * FROM alerts"
    q["congestion_windows"] = with_(b) + "SELECT * FROM windows"
    q["congestion_corrected"] = q["congestion_windows"]
    q["raw_stream_distinct"] = with_(b) + "SELECT DISTINCT * FROM traffic"
    q["batch_counts_stream"] = "SELECT 'traffic_events' AS tbl, COUNT(*) AS row_count, CAST(0 AS BIGINT) AS late_rows FROM events"

    q["hourly_traffic_24h"] = with_(b, hourly_cte("h", AS_OF)) + f"""
SELECT sensor_id, hour, total_vehicles, {rnd('avg_speed', 6)} AS avg_speed, reading_count FROM h"""
    q["hourly_report_24h"] = with_(b, hourly_cte("h", AS_OF)) + f"""
SELECT sensor_id, hour, total_vehicles, {rnd('avg_speed', 1)} AS avg_speed FROM h"""
    q["hourly_all_time"] = with_(b, HOURLY_ALL) + "SELECT * FROM hourly_all"

    q["alert_counts_24h"] = with_(b) + f"""
SELECT sensor_id, COUNT(*) AS alert_count FROM alerts WHERE alerted_at >= {CUT} GROUP BY 1"""
    q["alert_counts_by_hour"] = with_(b, ALERT_HOURS) + "SELECT * FROM alert_hours"
    q["congestion_avg_24h"] = with_(b) + f"""
SELECT sensor_id, {rnd('AVG(congestion_idx)', 6)} AS avg_congestion FROM windows WHERE window_start >= {CUT} GROUP BY 1"""
    q["congestion_avg_all"] = with_(b) + f"""
SELECT sensor_id, {rnd('AVG(congestion_idx)', 6)} AS avg_congestion FROM windows GROUP BY 1"""
    q["congestion_by_hour"] = with_(b, CONG_HOURS) + f"""
SELECT sensor_id, replace(sensor_id, '{params.LABEL_PREFIX}', '') AS label, hour, avg_idx,
       {rnd('avg_idx', 1)} AS idx_label, CAST({params.CONGESTION_THRESHOLD} AS DOUBLE) AS threshold,
       avg_idx > {params.CONGESTION_THRESHOLD} AS over_threshold
FROM cong_hours"""

    q["peak_hour"] = with_(b, decisions_cte("d")) + f"""
SELECT sensor_id, peak_hour, peak_vehicles, {rnd('avg_speed', 6)} AS avg_speed, reading_count FROM d_peaks"""
    q["police_decision"] = with_(b, decisions_cte("d")) + f"SELECT {DECISION_COLS} FROM d"
    q["police_decision_all"] = with_(b, decisions_cte("d", "all")) + f"SELECT {DECISION_COLS} FROM d"
    q["police_decision_users"] = with_(base("user_id"), decisions_cte("d")) + f"SELECT {DECISION_COLS} FROM d"
    q["police_plan"] = with_(b, decisions_cte("d")) + """
SELECT sensor_id, peak_hour, peak_vehicles, printf('%02d:00', peak_hour) AS deploy_by FROM d WHERE needs_police"""
    q["police_plan_users"] = with_(base("user_id"), decisions_cte("d")) + """
SELECT sensor_id, peak_hour, peak_vehicles, printf('%02d:00', peak_hour) AS deploy_by FROM d WHERE needs_police"""
    q["nightly_from_tables"] = q["police_decision"]
    q["daily_peak_rows"] = with_(b, decisions_cte("d")) + f"""
SELECT DATE '{C.REPORT_DATE}' AS report_date, sensor_id, peak_hour, peak_vehicles,
       {rnd('avg_congestion', 6)} AS avg_congestion, needs_police FROM d"""
    q["daily_peak_idempotent"] = with_(
        b,
        decisions_cte("d"),
        decisions_cte("p", as_of=PREV_AS_OF),
        f"""
tonight AS (SELECT DATE '{C.REPORT_DATE}' AS report_date, sensor_id, peak_hour, peak_vehicles, avg_congestion, needs_police FROM d),
history AS (
  SELECT DATE '{C.PREVIOUS_REPORT_DATE}' AS report_date, sensor_id, peak_hour, peak_vehicles, avg_congestion, needs_police FROM p
  UNION ALL
  SELECT * FROM tonight WHERE peak_hour < {C.PARTIAL_RUN_BEFORE_HOUR})""",
    ) + f"""
SELECT {HISTORY_COLS} FROM history
UNION ALL
SELECT {HISTORY_COLS} FROM tonight t
WHERE NOT EXISTS (SELECT 1 FROM history h WHERE h.report_date = t.report_date AND h.sensor_id = t.sensor_id)"""

    q["hourly_csv_rows"] = with_(b, hourly_cte("h", AS_OF)) + f"""
SELECT sensor_id, printf('%02d:00', hour) AS hour, total_vehicles, {rnd('avg_speed', 1)} AS avg_speed_kmh,
       '{C.REPORT_DATE}' AS report_date FROM h"""
    q["deployment_report_lines"] = report_sql("rule")
    q["deployment_report_all"] = report_sql("all")
    q["deployment_report_users"] = report_sql("rule", sensor="user_id")
    q["deployment_report_quiet"] = report_sql("rule", quiet=True)

    q["alert_lines"] = with_(b) + f"""
SELECT sensor_id, event_timestamp,
       printf({_lit(L.ALERT_LINE)}, sensor_id, vehicle_count, {rnd('avg_speed', 1)}) AS line
FROM alerts"""
    q["window_lines"] = with_(b) + f"""
SELECT sensor_id, window_start,
       printf({_lit(L.WINDOW_LINE)}, strftime(window_start, '%H:%M'), strftime(window_end, '%H:%M'), sensor_id,
              total_vehicles, {rnd('avg_speed', 1)}, congestion_idx) AS line
FROM windows"""
    q["peak_lines"] = with_(b, decisions_cte("d", "all")) + f"""
SELECT sensor_id, peak_vehicles,
       printf({_lit(L.PEAK_SUMMARY_LINE)}, sensor_id, peak_hour, format('{{:,}}', peak_vehicles), alert_count) AS line
FROM d"""
    for name, sensor in (("peak_log_lines", "event_type"), ("peak_log_lines_users", "user_id")):
        q[name] = with_(base(sensor), decisions_cte("d")) + f"""
SELECT sensor_id, peak_vehicles,
       printf({_lit(L.PEAK_LOG_LINE)}, sensor_id, peak_hour, peak_vehicles, alert_count,
              CASE WHEN needs_police THEN {_lit(L.STATUS_POLICE)} ELSE {_lit(L.STATUS_NORMAL)} END) AS line
FROM d"""

    q["dense_hour_grid"] = with_(b, HOURLY_ALL, GRID) + "SELECT sensor_id, label, hour, vehicles FROM grid"
    q["dense_peak_hour"] = with_(b, HOURLY_ALL, GRID) + "SELECT * FROM grid_peak"
    q["alert_overlay"] = with_(b, HOURLY_ALL, ALERT_HOURS) + """
SELECT a.sensor_id, a.hour, a.alert_count, COALESCE(h.total_vehicles, 0) AS height
FROM alert_hours a
LEFT JOIN hourly_all h ON h.sensor_id = a.sensor_id AND h.hour = a.hour
WHERE a.hour < 24 AND a.sensor_id IN (SELECT sensor_id FROM hourly_all)"""
    for name, sensor in (("chart_volume", "event_type"), ("chart_volume_rollup", "junction")):
        q[name] = with_(base(sensor), HOURLY_ALL, ALERT_HOURS, GRID) + """
SELECT g.sensor_id, g.label, g.hour, g.vehicles, COALESCE(a.alert_count, 0) AS alert_count,
       g.hour = p.peak_hour AS is_peak
FROM grid g
JOIN grid_peak p ON p.sensor_id = g.sensor_id
LEFT JOIN alert_hours a ON a.sensor_id = g.sensor_id AND a.hour = g.hour"""
    q["hourly_series"] = with_(b, HOURLY_ALL) + """
SELECT sensor_id, list(hour ORDER BY hour) AS hours, list(total_vehicles ORDER BY hour) AS vehicles,
       list(avg_speed ORDER BY hour) AS speeds
FROM hourly_all GROUP BY 1"""
    q["congestion_series"] = with_(b, CONG_HOURS) + """
SELECT sensor_id, list(hour ORDER BY hour) AS hours, list(avg_idx ORDER BY hour) AS idx
FROM cong_hours GROUP BY 1"""
    q["alert_hour_map"] = with_(b, ALERT_HOURS) + """
SELECT sensor_id, map(list(hour ORDER BY hour), list(alert_count ORDER BY hour)) AS alert_hours
FROM alert_hours GROUP BY 1"""

    q["table_row_counts"] = with_(b) + """
SELECT 'traffic_events' AS tbl, COUNT(*) AS row_count FROM traffic
UNION ALL SELECT 'critical_traffic', COUNT(*) FROM alerts
UNION ALL SELECT 'congestion_index', COUNT(*) FROM windows"""
    q["junction_count"] = with_(b, hourly_cte("h", AS_OF)) + "SELECT COUNT(DISTINCT sensor_id) AS junctions FROM h"
    q["alert_tally"] = with_(b) + f"""
SELECT sensor_id, COUNT(*) AS messages,
       COUNT(*) FILTER (WHERE avg_speed < {params.CRITICAL_SPEED}) AS alerts,
       GROUPING(sensor_id) = 1 AS is_total,
       COUNT(*) FILTER (WHERE avg_speed < {params.CRITICAL_SPEED}) > 0 AS has_alert
FROM readings GROUP BY ROLLUP (sensor_id)"""
    q["alert_tally_stream"] = with_(b) + f"""
SELECT sensor_id, COUNT(*) AS messages, COUNT(*) FILTER (WHERE avg_speed < {params.CRITICAL_SPEED}) AS alerts
FROM readings GROUP BY 1"""
    q["latest_alerts"] = with_(b) + """
SELECT sensor_id, avg_speed, alerted_at FROM alerts
ORDER BY alerted_at DESC, sensor_id, event_timestamp DESC, avg_speed LIMIT 5"""
    q["top_congestion_windows"] = with_(b) + """
SELECT sensor_id, window_start, window_end, congestion_idx FROM windows
WHERE congestion_idx IS NOT NULL
ORDER BY congestion_idx DESC, sensor_id, window_start LIMIT 4"""
    q["retention_raw"] = with_(b) + f"SELECT * FROM traffic WHERE event_timestamp >= TIMESTAMP '{C.RAW_RETENTION_AS_OF}' - INTERVAL 90 DAY"
    q["retention_aggregates"] = with_(b) + f"SELECT * FROM windows WHERE window_start >= TIMESTAMP '{C.AGGREGATE_RETENTION_AS_OF}' - INTERVAL 2 YEAR"
    q["sensor_profile_check"] = with_(
        b, f"profile(sensor_id, speed_lo, speed_hi, count_lo, count_hi) AS (VALUES {PROFILE_VALUES})"
    ) + """
SELECT r.sensor_id, CASE WHEN p.sensor_id IS NULL THEN 'unknown' ELSE 'known' END AS profile,
       COUNT(*) AS readings,
       COUNT(*) FILTER (WHERE r.avg_speed BETWEEN p.speed_lo AND p.speed_hi) AS speed_in_range,
       COUNT(*) FILTER (WHERE r.vehicle_count BETWEEN p.count_lo AND p.count_hi) AS count_in_range,
       COUNT(*) FILTER (WHERE r.avg_speed BETWEEN p.speed_lo AND p.speed_hi
                         AND r.vehicle_count BETWEEN p.count_lo AND p.count_hi) AS both_in_range
FROM readings r LEFT JOIN profile p ON p.sensor_id = r.sensor_id
GROUP BY 1, 2"""
    q["first_n_alerts"] = with_(b) + f"""
SELECT sensor_id, event_timestamp, vehicle_count, avg_speed, alert_rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY sensor_id ORDER BY event_timestamp, vehicle_count, avg_speed) AS INTEGER) AS alert_rank
  FROM alerts) WHERE alert_rank <= {C.FIRST_ALERTS}"""

    # A rank is known once the watermark has passed the alert.
    q["first_n_alerts_stream"] = f"""{q["first_n_alerts"]}
AND event_timestamp <= (SELECT MAX(event_timestamp) FROM alerts) - INTERVAL {C.FIRST_ALERTS_DELAY.upper()}"""

    # Streams: raw and alerts keep every row; windows are emitted once the
    # watermark (max event time - 10 min) has passed their end.
    q["hourly_all_time_rollup"] = q["hourly_all_time"]
    q["congestion_by_hour_rollup"] = q["congestion_by_hour"]
    q["raw_stream"] = q["raw_events"]
    q["critical_stream"] = q["critical_alerts"]
    q["congestion_stream"] = with_(b) + """
SELECT * FROM windows
WHERE window_end <= (SELECT MAX(event_time) FROM readings) - INTERVAL 10 MINUTE"""
    for stored, plain in (
        ("stored_row_counts", "table_row_counts"),
        ("latest_alerts_stored", "latest_alerts"),
        ("top_congestion_windows_stored", "top_congestion_windows"),
        ("congestion_avg_all_rollup", "congestion_avg_all"),
        ("police_decision_colocated", "police_decision"),
    ):
        q[stored] = q[plain]
    return q
