"""Payload decoding: permissive JSON, ANSI-safe timestamps, quarantine routing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from junctionflow.sources import parse
from junctionflow.sources.events import load_events, payloads, readings

from .conftest import SF_SMALL

PAYLOADS = [
    '{"sensor_id":"A","timestamp":"2026-05-09T19:41:12.985773","vehicle_count":47,"avg_speed":34.2}',
    "junk",
    '{"sensor_id":null}',
    '{"sensor_id":"B","timestamp":"bad","vehicle_count":"x","avg_speed":0.0}',
    '{"sensor_id":"C","timestamp":"2026-05-09T19:41:12","vehicle_count":1.5,"avg_speed":9}',
    '{"sensor_id":"D","extra":1,"vehicle_count":3000000000}',
    '{"sensor_id":"E","timestamp":"2026-05-09T19:41:12+05:30"}',
]


def _payload(spark):
    return spark.createDataFrame([(p,) for p in PAYLOADS], "value string")


def test_accepted_row_keeps_microseconds_and_exact_speed(spark):
    accepted, _ = parse(_payload(spark))
    got = accepted.collect()
    assert [r.sensor_id for r in got] == ["A"]
    r = got[0]
    assert r.vehicle_count == 47
    assert r.avg_speed == 34.2  # DOUBLE, not FLOAT widened to 34.20000076293945
    assert r.event_time == dt.datetime(2026, 5, 9, 19, 41, 12, 985773)


def test_null_sensor_dropped_and_bad_fields_quarantined(spark):
    _, quarantined = parse(_payload(spark))
    got = {r.sensor_id: r for r in quarantined.collect()}
    assert sorted(got) == ["B", "C", "D", "E"]
    assert got["B"].event_time is None and got["B"].vehicle_count is None and got["B"].avg_speed == 0.0
    assert got["B"].reason == "bad or missing timestamp"
    assert got["C"].vehicle_count is None and got["C"].avg_speed == 9.0
    assert got["C"].reason == "bad or missing vehicle_count"
    assert got["D"].vehicle_count is None  # INT overflow -> NULL, not an error
    # an explicit offset is honoured: 19:41:12+05:30 is 14:11:12 UTC (session zone UTC)
    assert got["E"].event_time == dt.datetime(2026, 5, 9, 14, 11, 12)


def test_binary_value_is_decoded(spark):
    df = _payload(spark).select(F.col("value").cast("binary").alias("value"))
    accepted, quarantined = parse(df)
    assert accepted.count() == 1 and quarantined.count() == 4


def test_events_payload_round_trip(spark):
    events = load_events(spark, SF_SMALL)
    accepted, quarantined = parse(payloads(events))
    direct = readings(events)
    assert quarantined.count() == 0
    a = accepted.select("sensor_id", "event_time", "vehicle_count", "avg_speed")
    b = direct.select("sensor_id", "event_time", "vehicle_count", "avg_speed")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
