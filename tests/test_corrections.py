"""Stored windows of closed days against windows computed from all stored readings."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from junctionflow import cli
from junctionflow.operators import congestion_windows
from junctionflow.plans import corrections
from junctionflow.plans.catalog import AS_OF, EventTables
from junctionflow.plans.corrections import close_days, correct_windows
from junctionflow.plans.housekeeping import compact_day, day_batches
from junctionflow.sources import read_table
from junctionflow.streaming.sinks import table_writer

from .conftest import SF_SMALL, rows

DAY = "2024-01-10"
RIGHT = ["sensor_id", "window_start", "window_end", "total_vehicles", "avg_speed", "congestion_idx"]


def store(base, name, df, batch):
    table_writer(f"{base}/{name}", name)(df, batch)


@pytest.fixture()
def parts(spark, tmp_dir):
    """(folder, readings, late readings): the windows of a few days are stored without the late readings."""
    base = f"{tmp_dir}/t"
    raw = EventTables(spark, SF_SMALL).traffic_events.filter("to_date(event_timestamp) between '2024-01-09' and '2024-01-12'")
    late = F.crc32(F.col("event_timestamp").cast("string")) % 12 == 0
    store(base, "traffic_events", raw.filter(~late), 0)
    store(base, "traffic_events", raw.filter(late), 1)
    store(base, "congestion_index", windows(raw.filter(~late)), 0)
    return base, raw, raw.filter(late)


def windows(raw):
    return congestion_windows(raw.withColumnRenamed("event_timestamp", "event_time"), watermark=None)


def stored(spark, base, *cols):
    return rows(read_table(spark, "congestion_index", base).select(*(cols or RIGHT)))


def test_only_windows_of_late_readings_are_replaced(spark, parts):
    base, raw, late = parts
    before = dict((r[:2], r[2]) for r in stored(spark, base, "sensor_id", "window_start", "created_at"))
    touched = {(r.sensor_id, r.window_start) for r in windows(late).collect()}
    replaced = correct_windows(spark, base, AS_OF)
    assert stored(spark, base) == rows(windows(raw).select(*RIGHT))
    after = dict((r[:2], r[2]) for r in stored(spark, base, "sensor_id", "window_start", "created_at"))
    assert {k for k in after if after[k] != before.get(k)} == touched and sum(replaced.values()) == len(touched)
    assert {r[0] for r in stored(spark, base, "run")} == {"closed"}
    assert not [f for f in os.listdir(f"{base}/congestion_index") if f.startswith("_clos") or f.startswith("_corr")]


def test_days_are_looked_at_again_for_later_batches_only(spark, parts):
    base, raw, _ = parts
    assert len(close_days(spark, base, AS_OF)) == 4
    assert close_days(spark, base, AS_OF) == {}
    more = raw.filter(f"to_date(event_timestamp) = '{DAY}'").limit(3)
    store(base, "traffic_events", more, 7)
    assert list(close_days(spark, base, AS_OF)) == [DAY]
    assert stored(spark, base) == rows(windows(raw.unionByName(more)).select(*RIGHT))
    assert close_days(spark, base, AS_OF) == {}
    assert correct_windows(spark, base, "2024-01-11 12:00:00") == {}  # no day that closed then has new rows


def test_a_reading_that_comes_during_a_pass_is_for_the_next(spark, parts, monkeypatch):
    base, raw, _ = parts
    more = raw.filter(f"to_date(event_timestamp) = '{DAY}'").limit(2)
    real = corrections.correct_windows

    def and_then(*args, **kwargs):
        out = real(*args, **kwargs)
        store(base, "traffic_events", more, 9)
        return out

    monkeypatch.setattr(corrections, "correct_windows", and_then)
    close_days(spark, base, AS_OF)
    monkeypatch.undo()
    assert any("batch_id=9" in b for b in day_batches(spark, base, "traffic_events", DAY))
    assert list(close_days(spark, base, AS_OF)) == [DAY]
    assert stored(spark, base) == rows(windows(raw.unionByName(more)).select(*RIGHT))


def test_windows_of_two_runs_and_windows_without_readings(spark, parts):
    base, raw, _ = parts
    store(base, "congestion_index", windows(raw).filter(f"to_date(window_start) = '{DAY}'"), 1)  # emitted twice
    alone = windows(raw).filter(f"to_date(window_start) = '{DAY}'").limit(2).withColumn("sensor_id", F.lit("gone"))
    store(base, "congestion_index", alone, 2)  # its readings are past their retention
    missing = raw.filter("to_date(event_timestamp) = '2024-01-12'")
    correct_windows(spark, base, AS_OF)
    assert stored(spark, base) == sorted(rows(windows(raw).select(*RIGHT)) + rows(alone.select(*RIGHT)))
    assert missing.count() > 0


def test_a_day_without_any_stored_window(spark, parts):
    base, raw, _ = parts
    extra = raw.withColumn("event_timestamp", F.col("event_timestamp") - F.expr("INTERVAL 20 DAYS")).filter("to_date(event_timestamp) = '2023-12-21'")
    store(base, "traffic_events", extra, 5)
    correct_windows(spark, base, AS_OF)
    assert stored(spark, base) == rows(windows(raw.unionByName(extra)).select(*RIGHT))


def test_a_pass_that_died_is_ended_by_the_next(spark, parts, monkeypatch):
    base, raw, _ = parts
    calls = []

    def dies(*args, **kwargs):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("died")
        return compact_day(*args, **kwargs)

    monkeypatch.setattr(corrections, "compact_day", dies)
    with pytest.raises(RuntimeError, match="died"):
        correct_windows(spark, base, AS_OF)
    monkeypatch.undo()
    correct_windows(spark, base, AS_OF)
    assert stored(spark, base) == rows(windows(raw).select(*RIGHT))
    assert not [f for f in os.listdir(f"{base}/congestion_index") if f.startswith("_clos")]


def test_housekeeping_corrects_before_it_merges(spark, parts, monkeypatch):
    base, raw, _ = parts
    monkeypatch.setattr(cli, "_spark", lambda args: spark)
    assert cli.main(["housekeeping", "--tables", base, "--as-of", AS_OF]) == 0
    assert stored(spark, base) == rows(windows(raw).select(*RIGHT))
    assert {r[0] for r in rows(read_table(spark, "traffic_events", base).select("run"))} == {"closed"}
    assert read_table(spark, "traffic_events", base).count() == raw.count()


def test_no_tables(spark, tmp_dir):
    assert close_days(spark, f"{tmp_dir}/none", AS_OF) == {}
