"""The batch jobs end to end: stored tables, nightly outputs, charts, housekeeping, command line."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from junctionflow import cli
from junctionflow.functions import now_text, round_half_up
from junctionflow.plans import housekeeping, run_nightly
from junctionflow.plans.catalog import EventTables
from junctionflow.plans.charts import chart_frames, chart_frames_from_rollup, write_charts
from junctionflow.plans.housekeeping import compact_closed_days, compact_day, drop_expired
from junctionflow.plans.nightly import update_rollup
from junctionflow.sources.tables import read_range, read_table
from junctionflow.streaming import table_writer

from .conftest import SF_SMALL, rows

TABLES = ("traffic_events", "critical_traffic", "congestion_index")
AS_OF = "2024-01-31 00:00:00"


@pytest.fixture()
def stored(spark, tmp_dir):
    """The three tables of sf0.001 in four batches each."""
    t = EventTables(spark, SF_SMALL)
    for name in TABLES:
        for k, part in enumerate(getattr(t, name).randomSplit([1.0] * 4, seed=1)):
            table_writer(f"{tmp_dir}/t/{name}", name)(part, k)
    return f"{tmp_dir}/t"


def test_absent_tables_are_empty(spark, tmp_dir):
    for name in (*TABLES, "daily_peak_report", "night_rollup"):
        assert read_table(spark, name, tmp_dir).count() == 0
        assert read_range(spark, name, tmp_dir, AS_OF).count() == 0


def test_charts_without_any_alert(spark, stored, tmp_dir):
    traffic, windows = (read_table(spark, n, stored) for n in ("traffic_events", "congestion_index"))
    none = read_table(spark, "critical_traffic", f"{tmp_dir}/nowhere")
    write_charts(chart_frames(traffic, none, windows), f"{tmp_dir}/charts")
    got = spark.read.parquet(f"{tmp_dir}/charts/volume_by_hour")
    assert got.count() == 5 * 24 and got.agg(F.sum("alert_count")).first()[0] == 0


def test_nightly_hands_its_results_on(spark, stored, tmp_dir):
    t = [read_range(spark, n, stored, AS_OF) for n in TABLES]
    out = f"{tmp_dir}/out"
    n = run_nightly(*t, out, AS_OF, "2024-01-31")
    plan = spark.read.option("header", True).csv(f"{out}/police_plan_2024-01-31.csv")
    assert rows(plan, "sensor_id", "deploy_by") == rows(n.plan, "sensor_id", "deploy_by") != []
    listing = [r.value for r in spark.read.text(f"{out}/peak_summary_2024-01-31.txt").collect()]
    d = n.decisions.orderBy("sensor_id").first()
    mark = "POLICE NEEDED" if d.needs_police else "✅ Normal"
    assert f"Junction {d.sensor_id:<25} | Peak Hour: {d.peak_hour:02d}:00 | Vehicles: {d.peak_vehicles:4d} | Alerts: {d.alert_count} | {mark}" in listing
    history = read_table(spark, "daily_peak_report", out)
    assert history.count() == 5 and history.filter("created_at is null").count() == 0


def test_charts_from_the_rollup_read_no_readings(spark, stored, tmp_dir):
    whole = [read_table(spark, n, stored) for n in TABLES]
    out = f"{tmp_dir}/out"
    days = [f"2024-01-{d:02d}" for d in range(2, 32)]
    for day in days[:2] + days[:1]:  # the first night is run again and replaces itself
        run_nightly(*(read_range(spark, n, stored, f"{day} 00:00:00") for n in TABLES), out, f"{day} 00:00:00", day)
    cut = [df.filter(F.col(c) < "2024-01-03 00:00:00") for df, c in zip(whole, ("event_timestamp", "alerted_at", "window_start"))]
    want, got = chart_frames(*cut), chart_frames_from_rollup(read_table(spark, "night_rollup", out))
    for name in ("volume_by_hour", "comparison"):
        assert rows(got[name]) == rows(want[name])
    r6 = [round_half_up("avg_idx", 6).alias("avg_idx"), "sensor_id", "hour"]
    assert rows(got["congestion_index"].select(*r6)) == rows(want["congestion_index"].select(*r6))
    for df in got.values():
        assert all("night_rollup" in f for f in df.inputFiles())


def test_rollup_takes_rows_that_come_after_a_night(spark, stored, tmp_dir, monkeypatch):
    """Nights at drifting times, one left out; windows and readings of closed days are stored after their night."""
    monkeypatch.setattr(cli, "_spark", lambda args: spark)
    times = dict(zip(TABLES, ("event_timestamp", "alerted_at", "window_start")))
    whole = {n: read_table(spark, n, stored).filter(F.col(c) < "2024-01-05 00:00:00").localCheckpoint() for n, c in times.items()}
    late = {
        "traffic_events": F.col("event_timestamp").between("2024-01-01 10:00:00", "2024-01-01 14:00:00"),
        "critical_traffic": F.hour("alerted_at") == 11,
        "congestion_index": F.hour("window_start") >= 20,
    }
    base, out = f"{tmp_dir}/late", f"{tmp_dir}/late_out"

    def store(k, late_rows):
        for n, df in whole.items():
            table_writer(f"{base}/{n}", n)(df.filter(late[n] if late_rows else ~late[n]).drop("run", "batch_id"), k)

    def night(as_of):
        assert cli.main(["nightly", "--tables", base, "--out", out, "--as-of", as_of]) == 0

    store(0, False)
    night("2024-01-02 00:00:07")
    night("2024-01-04 00:00:03")
    store(1, True)
    night("2024-01-05 00:00:01")
    want, got = chart_frames(*whole.values()), chart_frames_from_rollup(read_table(spark, "night_rollup", out))
    for name in ("volume_by_hour", "comparison"):
        assert rows(got[name]) == rows(want[name])
    r6 = [round_half_up("avg_idx", 6).alias("avg_idx"), "sensor_id", "hour"]
    assert rows(got["congestion_index"].select(*r6)) == rows(want["congestion_index"].select(*r6))
    assert update_rollup(spark, base, out, "2024-01-05 00:00:01") == []


def test_retention_and_compaction(spark, stored):
    name = "traffic_events"
    before = read_table(spark, name, stored).drop("run", "batch_id")
    n, last = before.count(), before.filter("event_date >= '2024-01-20'").count()
    merged = compact_closed_days(spark, stored, name, AS_OF)
    assert len(merged) >= 28 and set(merged.values()) <= {2, 3, 4}
    after = read_table(spark, name, stored)
    assert after.count() == n and after.exceptAll(spark.createDataFrame(after.rdd, after.schema)).count() == 0
    day = after.filter("event_date = '2024-01-10'")
    assert day.select("run", "batch_id").distinct().collect() == [("closed", 0)]
    assert compact_closed_days(spark, stored, name, AS_OF) == {}
    gone = drop_expired(spark, stored, name, "2024-04-19 00:00:00", "90 days")
    assert gone and max(gone) == "2024-01-19"
    assert read_table(spark, name, stored).count() == last


def test_compaction_ends_a_swap_that_was_cut_short(spark, stored):
    folder = f"{stored}/traffic_events"
    n = read_table(spark, "traffic_events", stored).count()
    day = read_table(spark, "traffic_events", stored).filter("event_date = '2024-01-10'").drop("run", "batch_id", "event_date")
    day.coalesce(1).write.parquet(f"{folder}/_closing_2024-01-10")  # a job died after this write
    assert compact_day(spark, stored, "traffic_events", "2024-01-10") == 1
    assert read_table(spark, "traffic_events", stored).count() == n
    assert not os.path.exists(f"{folder}/_closing_2024-01-10")


@pytest.mark.parametrize("died", ["no", "after the copy", "after the copy, without a list"])
def test_compaction_keeps_a_batch_that_comes_between_copy_and_swap(spark, tmp_dir, monkeypatch, died):
    name, day = "traffic_events", "2024-01-10"
    t = EventTables(spark, SF_SMALL).traffic_events.filter(f"to_date(event_timestamp) = '{day}'").localCheckpoint()
    hour, base = F.hour("event_timestamp"), f"{tmp_dir}/t"
    for k, part in enumerate((hour < 8, (hour >= 8) & (hour < 16))):
        table_writer(f"{base}/{name}", name)(t.filter(part), k)
    swaps, real = [], housekeeping.file_system

    def late(s, path):  # the swap's first step is to name the listed folders for deletion
        if path.endswith("batch_id=0") and "run=batch" in path and not swaps and os.path.exists(f"{base}/{name}/_closing_{day}/_SUCCESS"):
            swaps.append(path)
            table_writer(f"{base}/{name}", name)(t.filter(hour >= 16), 2)
            if died != "no":
                raise RuntimeError("died")
        return real(s, path)

    monkeypatch.setattr(housekeeping, "file_system", late)
    if died == "no":
        assert compact_day(spark, base, name, day) == 2
    else:
        with pytest.raises(RuntimeError, match="died"):
            compact_day(spark, base, name, day)
        if "without" in died:
            os.remove(f"{base}/{name}/_closing_{day}_batches")
        assert compact_day(spark, base, name, day) == (1 if "without" in died else 2)
    assert swaps
    after = read_table(spark, name, base)
    assert rows(after.select(*t.columns)) == rows(t)
    assert sorted(map(tuple, after.select("run", "batch_id").distinct().collect())) == [("batch", 2), ("closed", 0)]
    assert compact_day(spark, base, name, day) == 2 and compact_day(spark, base, name, day) == 0
    assert rows(read_table(spark, name, base).select(*t.columns)) == rows(t)
    assert not [f for f in os.listdir(f"{base}/{name}") if f.startswith("_closing")]


def test_session_clock_and_not_the_process_zone(spark, monkeypatch):
    import time

    monkeypatch.setenv("TZ", "Asia/Colombo")
    time.tzset()
    try:
        here, session = time.strftime("%H:%M"), now_text(spark)[11:16]
    finally:
        monkeypatch.delenv("TZ")
        time.tzset()
    assert here != session


def test_damaged_history_is_an_error(spark, stored, tmp_dir, monkeypatch):
    monkeypatch.setattr(cli, "_spark", lambda args: spark)
    out = f"{tmp_dir}/out"
    args = ["nightly", "--tables", stored, "--out", out, "--as-of", AS_OF]
    assert cli.main(args) == 0 and cli.main(args) == 0
    assert read_table(spark, "daily_peak_report", out).count() == 5  # the second run added nothing
    os.makedirs(f"{out}/daily_peak_report/report_date=2024-01-31", exist_ok=True)
    with open(f"{out}/daily_peak_report/report_date=2024-01-31/part-x.parquet", "w") as f:
        f.write("not a parquet file")
    with pytest.raises(Exception, match="parquet|Parquet|PARQUET"):
        cli.main(args)


def test_charts_command_over_the_rollup(spark, stored, tmp_dir, monkeypatch):
    monkeypatch.setattr(cli, "_spark", lambda args: spark)
    assert cli.main(["nightly", "--tables", stored, "--out", f"{tmp_dir}/out", "--as-of", AS_OF]) == 0
    assert cli.main(["charts", "--rollup", f"{tmp_dir}/out", "--out", f"{tmp_dir}/charts"]) == 0
    assert cli.main(["housekeeping", "--tables", stored, "--as-of", AS_OF]) == 0
    assert spark.read.parquet(f"{tmp_dir}/charts/comparison").count() == 5 * 24


def test_rounding_of_very_large_numbers(spark):
    df = spark.createDataFrame([(1e300,), (-1e30,), (2.0**53,), (2.345,), (float("inf"),), (float("nan"),), (None,)], "x double")
    assert [r[0] for r in df.select(round_half_up("x", 2)).collect()] == [1e300, -1e30, 2.0**53, 2.35, None, None, None]
