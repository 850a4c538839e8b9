"""Nightly rules at their edges (hand-made rows)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from junctionflow import schema
from junctionflow.operators import (
    alert_counts,
    append_history,
    congestion_avg,
    critical_alerts,
    daily_peak_rows,
    hourly_traffic,
    peak_hour,
    police_decision,
    police_plan,
    rows_to_append,
)
from junctionflow.plans import nightly_frames, ordered_lines

AS_OF = "2024-01-31 00:00:00"
T = dt.datetime


def _traffic(spark, rows):
    return spark.createDataFrame([(s, t, c, v, t) for s, t, c, v in rows], schema.TRAFFIC_EVENTS)


def _alerts(spark, rows):
    return spark.createDataFrame([(s, t, 100, 5.0, "x", t) for s, t in rows], schema.CRITICAL_TRAFFIC)


def _windows(spark, rows):
    return spark.createDataFrame(
        [(s, t, t + dt.timedelta(minutes=5), 10, 5.0, idx) for s, t, idx in rows], schema.CONGESTION_INDEX
    )


def _fixture(spark):
    noon = T(2024, 1, 30, 12, 0)
    traffic = _traffic(
        spark,
        [
            ("S1", noon, 50, 30.0),
            ("S2", noon, 50, 30.0),
            ("S3", noon, 50, 30.0),
            ("S4", noon, 50, 30.0),
            ("S5", noon, 50, 15.0),
            ("S6", noon, 50, 14.9),
        ],
    )
    alerts = _alerts(spark, [("S3", noon), ("S4", noon), ("S4", noon), ("S7", noon)] + [("S7", noon)] * 4)
    windows = _windows(
        spark, [("S1", noon, 8.0), ("S2", noon, 8.01), ("S5", noon, 1.0), ("S6", noon, 1.0), ("S7", noon, 20.0)]
    )
    return traffic, alerts, windows


def test_police_rule_edges(spark):
    traffic, alerts, windows = _fixture(spark)
    n = nightly_frames(traffic, alerts, windows, AS_OF, "2024-01-31")
    got = {r.sensor_id: r for r in n.decisions.collect()}
    assert sorted(got) == ["S1", "S2", "S3", "S4", "S5", "S6"]  # S7 has no readings: absent
    assert {k: v.needs_police for k, v in got.items()} == {
        "S1": False,  # index must be strictly above 8
        "S2": True,
        "S3": False,  # one alert is not enough
        "S4": True,
        "S5": False,  # speed must be strictly below 15
        "S6": True,
    }
    assert got["S3"].avg_congestion == 0.0 and got["S5"].alert_count == 0


def test_variant_all_flags_everyone_and_uses_all_history(spark):
    traffic, alerts, windows = _fixture(spark)
    old = _windows(spark, [("S1", T(2023, 6, 1), 100.0)])
    n = nightly_frames(traffic, alerts, windows.unionByName(old), AS_OF, "2024-01-31", variant="all")
    got = {r.sensor_id: r for r in n.decisions.collect()}
    assert all(r.needs_police for r in got.values())
    assert got["S1"].avg_congestion == (8.0 + 100.0) / 2


def test_lookback_is_inclusive_lower_bound(spark):
    traffic = _traffic(
        spark,
        [
            ("A", T(2024, 1, 30, 0, 0, 0), 5, 20.0),  # exactly 24 h old: kept
            ("A", T(2024, 1, 29, 23, 59, 59, 999999), 7, 20.0),  # just older: dropped
            ("A", T(2024, 1, 31, 5, 0), 11, 20.0),  # after as_of: kept (no upper bound)
        ],
    )
    h = hourly_traffic(traffic, AS_OF)
    assert sorted((r.hour, r.total_vehicles) for r in h.collect()) == [(0, 5), (5, 11)]


def test_peak_ties_go_to_lowest_hour_and_hour_23_label(spark):
    traffic = _traffic(
        spark,
        [
            ("A", T(2024, 1, 30, 7, 0), 10, 20.0),
            ("A", T(2024, 1, 30, 9, 0), 10, 20.0),
            ("B", T(2024, 1, 30, 23, 30), 99, 20.0),
        ],
    )
    peaks = {r.sensor_id: r.peak_hour for r in peak_hour(hourly_traffic(traffic, AS_OF)).collect()}
    assert peaks == {"A": 7, "B": 23}
    empty = traffic.sparkSession.createDataFrame([], schema.CRITICAL_TRAFFIC)
    n = nightly_frames(traffic, empty, traffic.sparkSession.createDataFrame([], schema.CONGESTION_INDEX), AS_OF, "2024-01-31")
    lines = [r.line for r in ordered_lines(n.report_lines).collect()]
    assert "Peak Hour : 23:00 - 24:00" in lines


def test_speed_exactly_ten_is_no_alert(spark):
    r = spark.createDataFrame(
        [("A", T(2024, 1, 30), 1, 10.0, T(2024, 1, 30)), ("A", T(2024, 1, 30), 1, 9.99, T(2024, 1, 30))],
        "sensor_id string, event_time timestamp, vehicle_count int, avg_speed double, ingested_at timestamp",
    )
    got = critical_alerts(r, at=F.col("event_time")).collect()
    assert [x.avg_speed for x in got] == [9.99]
    assert got[0].alert_message == "CRITICAL: avg_speed below 10 km/h"


def test_empty_plan_gets_fallback_line(spark):
    traffic = _traffic(spark, [("A", T(2024, 1, 30, 8), 10, 40.0)])
    empty_a = spark.createDataFrame([], schema.CRITICAL_TRAFFIC)
    empty_w = spark.createDataFrame([], schema.CONGESTION_INDEX)
    n = nightly_frames(traffic, empty_a, empty_w, AS_OF, "2024-01-31", generated="2024-01-31 00:00:00")
    lines = [r.line for r in ordered_lines(n.report_lines).collect()]
    assert "  → No police deployment needed tomorrow" in lines
    assert "Status    : No intervention needed" in lines
    assert police_plan(n.decisions).count() == 0


def test_history_append_vs_idempotent(spark):
    traffic, alerts, windows = _fixture(spark)
    peaks = peak_hour(hourly_traffic(traffic, AS_OF))
    d = police_decision(peaks, alert_counts(alerts, AS_OF), congestion_avg(windows, AS_OF))
    rows = daily_peak_rows(d, "2024-01-31")
    history = rows.filter(F.col("sensor_id").isin("S1", "S2"))
    assert append_history(rows, history, "append").count() == 8  # duplicates, as the original
    assert append_history(rows, history, "idempotent").count() == 6
    assert rows_to_append(rows, history, "idempotent", report_date="2024-01-31").count() == 4
    assert rows_to_append(rows, rows, "idempotent").count() == 0  # re-running a night adds nothing
