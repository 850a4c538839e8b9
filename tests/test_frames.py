"""Chart frames, monitoring operators and invariants on hand-made and driver data."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from junctionflow import schema
from junctionflow.operators import (
    alert_hour_map,
    alert_overlay,
    alert_tally,
    chart_volume,
    dense_hour_grid,
    dense_peak_hour,
    first_n_alerts,
    hourly_report,
    hourly_series,
    hourly_traffic,
    latest_alerts,
    retain,
    sensor_profile_check,
    table_row_counts,
)
from junctionflow.operators.monitor import default_profile
from junctionflow.plans.catalog import EventTables
from junctionflow.streaming.sinks import expired_partitions

from .conftest import SF_SMALL

HOURLY = "sensor_id string, hour int, total_vehicles bigint, avg_speed double, readings bigint"
ALERT_HOURS = "sensor_id string, hour int, alert_count bigint"


def _hourly(spark):
    return spark.createDataFrame(
        [("Junction_A", 7, 10, 20.0, 1), ("Junction_A", 9, 10, 20.0, 1), ("Junction_B", 23, 5, 20.0, 1)], HOURLY
    )


def test_dense_grid_fills_24_hours_and_strips_prefix(spark):
    g = dense_hour_grid(_hourly(spark))
    assert g.count() == 48
    a = {r.hour: r.vehicles for r in g.filter("sensor_id = 'Junction_A'").collect()}
    assert a[7] == 10 and a[9] == 10 and a[0] == 0 and len(a) == 24
    assert {r.label for r in g.collect()} == {"A", "B"}


def test_dense_peak_lowest_hour_on_ties_and_all_zero(spark):
    h = _hourly(spark).unionByName(spark.createDataFrame([("Z", 5, 0, 1.0, 1)], HOURLY))
    got = {r.sensor_id: (r.peak_hour, r.peak_vehicles) for r in dense_peak_hour(h).collect()}
    assert got == {"Junction_A": (7, 10), "Junction_B": (23, 5), "Z": (0, 0)}


def test_alert_overlay_only_sensors_with_traffic(spark):
    alerts = spark.createDataFrame(
        [("Junction_A", 9, 2), ("Junction_A", 3, 1), ("Junction_C", 9, 4)], ALERT_HOURS
    )
    got = sorted((r.sensor_id, r.hour, r.alert_count, r.height) for r in alert_overlay(alerts, _hourly(spark)).collect())
    assert got == [("Junction_A", 3, 1, 0), ("Junction_A", 9, 2, 10)]


def test_chart_volume_marks_alerts_and_peak(spark):
    alerts = spark.createDataFrame([("Junction_A", 9, 2)], ALERT_HOURS)
    v = chart_volume(_hourly(spark), alerts).filter("sensor_id = 'Junction_A'")
    rows = {r.hour: r for r in v.collect()}
    assert len(rows) == 24
    assert rows[9].alert_count == 2 and rows[7].alert_count == 0
    assert [h for h, r in rows.items() if r.is_peak] == [7]


def test_series_and_map_are_hour_ordered(spark):
    s = hourly_series(_hourly(spark)).filter("sensor_id = 'Junction_A'").first()
    assert s.hours == [7, 9] and s.vehicles == [10, 10] and s.speeds == [20.0, 20.0]
    alerts = spark.createDataFrame([("A", 9, 2), ("A", 3, 1)], ALERT_HOURS)
    m = alert_hour_map(alerts).select("alert_hours", F.map_keys("alert_hours").alias("k")).first()
    assert m.alert_hours == {3: 1, 9: 2} and m.k == [3, 9]


def test_profile_check_unknown_sensor(spark):
    r = spark.createDataFrame(
        [("click", dt.datetime(2024, 1, 1), 30, 20.0), ("click", dt.datetime(2024, 1, 1), 90, 60.0), ("error", dt.datetime(2024, 1, 1), 1, 1.0)],
        "sensor_id string, event_time timestamp, vehicle_count int, avg_speed double",
    )
    prof = default_profile(spark, [("click", 15, 55, 20, 80)])
    got = sorted((x.sensor_id, x.profile, x.speed_ok, x.count_ok) for x in sensor_profile_check(r, prof).collect())
    assert got == [("click", "known", False, False), ("click", "known", True, True), ("error", "unknown", None, None)]


def test_first_n_alerts_and_latest(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("A", t0 + dt.timedelta(minutes=i), 1, 5.0, "m", t0 + dt.timedelta(minutes=i)) for i in range(6)]
    alerts = spark.createDataFrame(rows, schema.CRITICAL_TRAFFIC)
    first = first_n_alerts(alerts, 3).collect()
    assert [r.alert_rank for r in first] == [1, 2, 3]
    assert max(r.event_timestamp for r in first) == t0 + dt.timedelta(minutes=2)
    latest = latest_alerts(alerts, 2).collect()
    assert [r.alerted_at for r in latest] == [t0 + dt.timedelta(minutes=5), t0 + dt.timedelta(minutes=4)]


def test_retention_and_expired_partitions(spark):
    t = spark.createDataFrame(
        [("A", dt.datetime(2023, 10, 1), 1, 1.0, None), ("A", dt.datetime(2024, 1, 2), 1, 1.0, None)], schema.TRAFFIC_EVENTS
    )
    assert retain(t, "event_timestamp", "2024-01-31 00:00:00", "90 days").count() == 1
    parts = spark.createDataFrame([(dt.date(2023, 11, 1),), (dt.date(2023, 11, 2),), (dt.date(2024, 1, 1),)], "event_date date")
    gone = [r.event_date for r in expired_partitions(parts, "event_date", "2024-01-31 00:00:00", "90 days").collect()]
    assert gone == [dt.date(2023, 11, 1)]  # cut is 2023-11-02 00:00


def test_invariants_on_driver_data(spark):
    t = EventTables(spark, SF_SMALL)
    total = t.readings.agg(F.sum("vehicle_count")).first()[0]
    hourly = hourly_traffic(t.traffic_events, lookback=None)
    assert hourly.agg(F.sum("total_vehicles")).first()[0] == total  # sum of hourly = sum of readings
    assert t.congestion_index.agg(F.sum("total_vehicles")).first()[0] == total
    grid = dense_hour_grid(hourly_report(hourly))
    per_sensor = {r[0]: r[1] for r in grid.groupBy("sensor_id").count().collect()}
    assert set(per_sensor.values()) == {24}
    tally = {r.sensor_id: r for r in alert_tally(t.readings).collect()}
    assert tally[None].is_total and tally[None].messages == t.readings.count()
    assert tally[None].alerts == t.critical_traffic.count()
    counts = {r.tbl: r.row_count for r in table_row_counts({"r": t.traffic_events, "a": t.critical_traffic}).collect()}
    assert counts["r"] == t.readings.count()


def test_alert_tally_total_row_like_rollup(spark):
    """Per-sensor rows plus one total row; on empty input only the total, with zero counts (as ROLLUP)."""
    from junctionflow.operators import alert_tally

    rows = [("A", 5.0), ("A", 20.0), ("B", 30.0)]
    df = spark.createDataFrame(rows, "sensor_id string, avg_speed double")
    got = {(r.sensor_id, r.is_total): (r.messages, r.alerts, r.has_alert) for r in alert_tally(df).collect()}
    assert got == {("A", False): (2, 1, True), ("B", False): (1, 0, False), (None, True): (3, 1, True)}
    empty = alert_tally(df.limit(0)).collect()
    assert [(r.sensor_id, r.messages, r.alerts, r.is_total, r.has_alert) for r in empty] == [(None, 0, 0, True, False)]
