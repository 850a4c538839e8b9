"""Footers, top-k over few folders, distinct readings, state deltas and the progress table."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from junctionflow.operators import distinct_readings, latest_alerts, raw_events, top_congestion_windows
from junctionflow.plans.catalog import EventTables
from junctionflow.sources import read_table
from junctionflow.sources.footers import by_folder, day_maxima, footer_session, newest_days, stored_row_counts, top_days, _table
from junctionflow.sources.tables import partition_days, read_days
from junctionflow.streaming import progress, sinks
from junctionflow.streaming.sinks import delta_writer, read_deltas, start, table_writer

from .conftest import SF_SMALL, rows

NAMES = ("traffic_events", "critical_traffic", "congestion_index")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("stored"))
    t = EventTables(spark, SF_SMALL)
    for name in NAMES:
        table_writer(f"{base}/{name}", name)(getattr(t, name), 0)
    return base


# footers


def test_counts_come_from_footers(spark, stored):
    counts = stored_row_counts(spark, stored, NAMES)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedAggregation: [COUNT(*)]") == 3 and "ReadSchema: struct<count(*)" in plan
    assert rows(counts) == sorted((n, read_table(spark, n, stored).count()) for n in NAMES)
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")  # the caller's session is as before
    assert rows(stored_row_counts(spark, f"{stored}/none", NAMES)) == sorted((n, 0) for n in NAMES)


def test_maxima_come_from_footers(spark, stored):
    table = _table(footer_session(spark), "congestion_index", stored)
    plan = by_folder(table, "congestion_index", F.max("congestion_idx"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(congestion_idx)]" in plan and "PushedGroupBy: [window_date, run, batch_id]" in plan
    want = read_table(spark, "congestion_index", stored).groupBy("window_date").agg(F.max("congestion_idx").alias("m"))
    assert day_maxima(spark, stored, "congestion_index", "congestion_idx") == sorted((str(r.window_date), r.m) for r in want.collect())


def test_newest_alerts_read_few_days(spark, stored):
    days = partition_days(spark, f"{stored}/critical_traffic", "alert_date")
    for n in (1, 5, 40, 10**6):
        taken = newest_days(spark, stored, "critical_traffic", days, n)
        got = latest_alerts(read_days(spark, "critical_traffic", stored, taken), n)
        assert rows(got) == rows(latest_alerts(read_table(spark, "critical_traffic", stored), n))
        assert taken == sorted(days, reverse=True)[: len(taken)] and (len(taken) < 5 if n <= 5 else True)
    assert len(taken) == len(days)


def test_greatest_windows_read_few_days(spark, stored):
    days = len(partition_days(spark, f"{stored}/congestion_index", "window_date"))
    everything = read_table(spark, "congestion_index", stored)
    for n in (1, 4, 30, 10**6):
        some = top_days(spark, stored, "congestion_index", "congestion_idx", n)
        assert rows(top_congestion_windows(some, n)) == rows(top_congestion_windows(everything, n))
        read = {f.split("window_date=")[1][:10] for f in some.inputFiles()}
        assert len(read) < days / 2 if n <= 4 else len(read) <= days


def test_equal_values_of_several_days_are_all_read(spark, tmp_dir):
    at = dt.datetime(2024, 1, 1)
    same = [("S", at + dt.timedelta(days=d), at + dt.timedelta(days=d, minutes=5), 1, 1.0, 7.0) for d in range(9)]
    df = spark.createDataFrame(same, "sensor_id string, window_start timestamp, window_end timestamp, total_vehicles long, avg_speed double, congestion_idx double")
    table_writer(f"{tmp_dir}/congestion_index", "congestion_index")(df, 0)
    assert top_days(spark, tmp_dir, "congestion_index", "congestion_idx", 2).count() == 9


# distinct readings


def reading_files(spark, folder, batches):
    """One file a batch of (minute, sensor)."""
    t0 = dt.datetime(2024, 1, 1)
    for k, batch in enumerate(batches):
        data = [(s, t0 + dt.timedelta(minutes=m), 5, 20.0, t0) for m, s in batch]
        spark.createDataFrame(data, "sensor_id string, event_time timestamp, vehicle_count int, avg_speed double, ingested_at timestamp").coalesce(1).write.mode("append").parquet(f"{folder}/b{k}")


def test_distinct_state_is_bounded_by_the_watermark(spark, tmp_dir):
    batches = []
    for k in range(14):  # ten minutes a batch; each is followed by the repeats of the one before
        now = [(10 * k + m, f"S{m}") for m in range(8)]
        batches.append(now + now[:3] + (batches[-1][:8] if batches else []))
    reading_files(spark, f"{tmp_dir}/in", batches)
    schema = "sensor_id string, event_time timestamp, vehicle_count int, avg_speed double, ingested_at timestamp"
    sizes = []
    out = {}
    for k in range(14):
        # One file a run, from one checkpoint: the order of the files is that of the batches.
        os.makedirs(f"{tmp_dir}/src", exist_ok=True)
        (f,) = [x for x in os.listdir(f"{tmp_dir}/in/b{k}") if x.endswith(".parquet")]
        with open(f"{tmp_dir}/in/b{k}/{f}", "rb") as a, open(f"{tmp_dir}/src/{k:02d}.parquet", "wb") as b:
            b.write(a.read())
        stream = distinct_readings(spark.readStream.schema(schema).parquet(f"{tmp_dir}/src"), "20 minutes")
        q = start(raw_events(stream), table_writer(f"{tmp_dir}/out", "traffic_events"), f"d{k}_{abs(hash(tmp_dir)) % 10**6}", f"{tmp_dir}/cp", available_now=True)
        q.awaitTermination()
        assert q.exception() is None
        sizes.append(q.lastProgress.stateOperators[0].numRowsTotal)
    got = sinks.read_sink(spark, f"{tmp_dir}/out", table="traffic_events")
    out = sorted((r.sensor_id, r.event_timestamp) for r in got.collect())
    assert len(out) == len(set(out)) == 14 * 8  # repeats of the batch before are found in the state
    assert max(sizes[4:]) <= 6 * 8 and sizes[-1] <= max(sizes[:6])  # and it does not grow with the stream


def test_distinct_batch_frame(spark):
    r = EventTables(spark, SF_SMALL).readings
    assert distinct_readings(r.unionByName(r)).count() == r.count()


# state as deltas


def deltas(path):
    (run,) = os.listdir(path)
    return sorted(x for x in os.listdir(f"{path}/{run}") if x.startswith("delta="))


def test_a_batch_writes_its_changed_keys_only(spark, tmp_dir):
    write = delta_writer(f"{tmp_dir}/s", ["sensor_id"], fold_after=4)
    state = {}
    sizes = []
    for b in range(11):
        changed = {f"S{k}": b for k in (range(20_000) if b == 0 else range(b, b + 3))}
        state.update(changed)
        write(spark.createDataFrame(list(changed.items()), "sensor_id string, n long"), b)
        assert {r.sensor_id: r.n for r in read_deltas(spark, f"{tmp_dir}/s", "batch", ["sensor_id"]).collect()} == state
        own = f"{tmp_dir}/s/run=batch/delta={b}-{b}"
        sizes.append(sum(os.path.getsize(f"{own}/{f}") for f in os.listdir(own)))
    assert max(sizes[1:]) < sizes[0] / 10
    assert len(deltas(f"{tmp_dir}/s")) <= 5 and deltas(f"{tmp_dir}/s")[0].startswith("delta=0-")


def test_replay_and_a_fold_that_was_cut_short(spark, tmp_dir, monkeypatch):
    write = delta_writer(f"{tmp_dir}/s", ["k"], fold_after=3)

    def batch(b, *pairs):
        write(spark.createDataFrame(list(pairs), "k string, n long"), b)

    def read():
        return {r.k: r.n for r in read_deltas(spark, f"{tmp_dir}/s", "batch", ["k"]).collect()}

    batch(0, ("a", 1), ("b", 1))
    batch(1, ("a", 9))
    batch(1, ("a", 2))  # a replay replaces its first attempt
    batch(2, ("c", 3))
    assert read() == {"a": 2, "b": 1, "c": 3}
    real = sinks._delta_spans
    monkeypatch.setattr(sinks, "_delta_spans", lambda spark, root, covered=False: (_ for _ in ()).throw(RuntimeError("died")) if covered else real(spark, root))
    with pytest.raises(RuntimeError, match="died"):
        batch(3, ("a", 4))  # folded, but the folded deltas are still there
    monkeypatch.undo()
    assert read() == {"a": 4, "b": 1, "c": 3}
    batch(3, ("a", 4))
    batch(4, ("b", 5))
    assert read() == {"a": 4, "b": 5, "c": 3}
    with pytest.raises(FileNotFoundError):
        read_deltas(spark, f"{tmp_dir}/none", "batch", ["k"])


# progress


def test_progress_is_stored_by_batch(spark, tmp_dir):
    from .test_streaming import _write_files
    from junctionflow.operators import congestion_windows
    from junctionflow.sources import parse, text_source

    _write_files(f"{tmp_dir}/src", [[("10:01:00", 1), ("10:04:00", 2)], [("10:16:00", 4)], [("10:17:00", 8)], [("10:03:00", 16), ("10:07:00", 64)], [("10:40:00", 128)]])
    listener = progress.ProgressTable(spark, f"{tmp_dir}/progress", every=2)
    spark.streams.addListener(listener)
    name = f"p{abs(hash(tmp_dir)) % 10**8}"
    try:
        accepted, _ = parse(text_source(spark, f"{tmp_dir}/src", max_files_per_trigger=1))
        q = start(congestion_windows(accepted), table_writer(f"{tmp_dir}/out", "congestion_index"), name, f"{tmp_dir}/cp", available_now=True)
        q.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    got = progress.read_progress(spark, f"{tmp_dir}/progress").filter(F.col("query") == name)
    by_batch = {r.batch_id: r for r in got.collect()}
    assert [by_batch[b].rows for b in range(5)] == [2, 1, 1, 2, 1]
    assert sum(r.late_rows for r in by_batch.values()) >= 1 and by_batch[0].lag_seconds > 0
    assert by_batch[1].max_event_time == dt.datetime(2026, 5, 9, 10, 16)
    total = progress.query_totals(got).first()
    assert (total.query, total.batches, total.rows) == (name, 5, 7)


def test_the_newest_report_of_a_batch_counts(spark, tmp_dir):
    table = progress.ProgressTable(spark, f"{tmp_dir}/p", every=10)
    row = {"query": "q", "id": "i", "run": "r", "batch_id": 0, "at": "2024-01-01T00:00:00.000Z", "rows": 3, "late_rows": 0, "max_event_time": None, "watermark": None, "lag_seconds": None}
    table.held["i"] = [row]
    table.flush("i")
    table.held["i"] = [{**row, "run": "r2", "at": "2024-01-01T00:05:00.000Z", "rows": 4}, {**row, "batch_id": 1}]
    table.flush("i")
    table.flush("i")
    got = progress.read_progress(spark, f"{tmp_dir}/p")
    assert sorted((r.batch_id, r.rows) for r in got.collect()) == [(0, 4), (1, 3)]
    assert progress.read_progress(spark, f"{tmp_dir}/none").count() == 0
