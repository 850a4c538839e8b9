"""Structured Streaming: late data, restart from checkpoint, replay, the full pipeline."""

from __future__ import annotations

import json
import os

import pytest

from pyspark.sql import functions as F

from junctionflow.operators import congestion_windows, critical_alerts, raw_events
from junctionflow.sources import parse, text_source
from junctionflow.sources.events import load_events, payloads
from junctionflow.streaming import await_all, late_rows_dropped, read_sink, run_pipeline, start, table_writer

from .conftest import SF_SMALL


def _write_files(folder, batches, t0=1_700_000_000):
    """One JSON-lines file per micro-batch, with increasing modification times."""
    os.makedirs(folder, exist_ok=True)
    for i, batch in enumerate(batches):
        path = os.path.join(folder, f"part-{i:03d}.json")
        with open(path, "w") as f:
            for hhmmss, vehicles in batch:
                f.write(
                    json.dumps(
                        {"sensor_id": "A", "timestamp": f"2026-05-09T{hhmmss}", "vehicle_count": vehicles, "avg_speed": 20.0}
                    )
                    + "\n"
                )
        os.utime(path, (t0 + i * 10, t0 + i * 10))


def _run_windows(spark, src, out, cp):
    accepted, _ = parse(text_source(spark, src, max_files_per_trigger=1))
    q = start(
        congestion_windows(accepted),
        table_writer(out, "congestion_index"),
        name=None or f"w{abs(hash(out)) % 10**8}",
        checkpoint=cp,
        available_now=True,
    )
    q.awaitTermination()
    assert q.exception() is None
    dropped = late_rows_dropped(q)
    got = {}
    if os.path.exists(out):
        got = {
            r.window_start.strftime("%H:%M"): r.total_vehicles
            for r in read_sink(spark, out).collect()
        }
    return got, dropped


def test_late_row_in_same_batch_as_closing_data_is_counted(spark, tmp_dir):
    _write_files(
        f"{tmp_dir}/src",
        [
            [("10:01:00", 1), ("10:04:00", 2)],
            [("10:16:00", 4)],
            [("10:03:00", 8), ("10:05:30", 16), ("10:07:00", 32)],
            [("10:40:00", 64)],
        ],
    )
    got, dropped = _run_windows(spark, f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/cp")
    assert got == {"10:00": 11, "10:05": 48, "10:15": 4}  # 10:40's window stays open
    assert dropped == 0


def test_late_row_after_watermark_moved_is_dropped(spark, tmp_dir):
    _write_files(
        f"{tmp_dir}/src",
        [
            [("10:01:00", 1), ("10:04:00", 2)],
            [("10:16:00", 4)],
            [("10:17:00", 8)],
            [("10:03:00", 16), ("10:05:30", 32), ("10:07:00", 64)],
            [("10:40:00", 128)],
        ],
    )
    got, dropped = _run_windows(spark, f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/cp")
    assert got == {"10:00": 3, "10:05": 96, "10:15": 12}
    assert dropped == 1


def _raw_query(spark, src, out, cp):
    accepted, _ = parse(text_source(spark, src))
    q = start(raw_events(accepted), table_writer(out, "traffic_events"), name=None, checkpoint=cp, available_now=True)
    q.awaitTermination()
    assert q.exception() is None


def test_restart_resumes_from_checkpoint(spark, tmp_dir):
    src, out, cp = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/cp"
    _write_files(src, [[("10:00:00", 1)], [("10:01:00", 2)]])
    _raw_query(spark, src, out, cp)
    assert read_sink(spark, out).count() == 2
    _write_files(src, [[("10:00:00", 1)], [("10:01:00", 2)], [("10:02:00", 4)]])  # one new file
    _raw_query(spark, src, out, cp)
    got = read_sink(spark, out)
    assert got.count() == 3  # old files not re-read after restart
    assert got.agg(F.sum("vehicle_count")).first()[0] == 7


def test_replayed_batch_overwrites_instead_of_duplicating(spark, tmp_dir):
    out = f"{tmp_dir}/out"
    df = spark.createDataFrame(
        [("A", "2026-05-09 10:00:00", 1, 5.0)], "sensor_id string, event_timestamp string, vehicle_count int, avg_speed double"
    ).withColumn("event_timestamp", F.to_timestamp("event_timestamp"))
    counts = []
    write = table_writer(out, "traffic_events", on_batch=lambda t, b, n: counts.append(n))
    write(df, 7)
    write(df, 7)  # at-least-once replay of batch 7
    write(df.limit(0), 8)  # empty batch: nothing written
    assert read_sink(spark, out).count() == 1
    assert counts == [1, 1]
    assert sorted(r.batch_id for r in read_sink(spark, out).select("batch_id").distinct().collect()) == [7]


@pytest.mark.parametrize("fan_out", [True, False])
def test_pipeline_matches_batch_twin(spark, tmp_dir, fan_out):
    """Both layouts (stateless tables from one query, or one query per table) equal the batch operators."""
    events = load_events(spark, SF_SMALL)
    src = f"{tmp_dir}/payload"
    payloads(events).select("value").write.text(src)
    queries = run_pipeline(
        spark, text_source(spark, src), f"{tmp_dir}/tables", f"{tmp_dir}/cp", available_now=True, fan_out=fan_out
    )
    assert set(queries) == (
        {"stateless", "congestion_index"} if fan_out else {"traffic_events", "critical_traffic", "congestion_index", "quarantine"}
    )
    await_all(queries)
    accepted, _ = parse(payloads(events))
    raw = read_sink(spark, f"{tmp_dir}/tables/traffic_events")
    alerts = read_sink(spark, f"{tmp_dir}/tables/critical_traffic")
    wins = read_sink(spark, f"{tmp_dir}/tables/congestion_index")
    assert raw.count() == events.count()
    assert alerts.count() == critical_alerts(accepted).count()
    batch = congestion_windows(accepted, watermark=None)
    max_t = accepted.agg(F.max("event_time")).first()[0]
    import datetime as dt

    expected = batch.filter(F.col("window_end") <= F.lit(max_t - dt.timedelta(minutes=10)))
    cols = ["sensor_id", "window_start", "window_end", "total_vehicles", "avg_speed", "congestion_idx"]
    assert wins.select(cols).exceptAll(expected.select(cols)).count() == 0
    assert expected.select(cols).exceptAll(wins.select(cols)).count() == 0
    assert "event_date" in raw.columns and "window_date" in wins.columns  # date-partitioned sinks
    assert read_sink(spark, f"{tmp_dir}/tables/quarantine", table="quarantine").count() == 0


def test_late_data_semantics_with_rocksdb_state(spark, tmp_dir):
    """Same outcome with the RocksDB state store that cluster_conf() selects."""
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        _write_files(
            f"{tmp_dir}/src",
            [
                [("10:01:00", 1), ("10:04:00", 2)],
                [("10:16:00", 4)],
                [("10:17:00", 8)],
                [("10:03:00", 16), ("10:05:30", 32), ("10:07:00", 64)],
                [("10:40:00", 128)],
            ],
        )
        got, dropped = _run_windows(spark, f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/cp")
    finally:
        spark.conf.set(key, old)
    assert got == {"10:00": 3, "10:05": 96, "10:15": 12}
    assert dropped == 1


def test_fan_out_batch_fills_every_table_once_even_when_replayed(spark, tmp_dir):
    from junctionflow.sources import decode
    from junctionflow.streaming import fan_out_writer, stateless_outputs

    lines = [
        {"sensor_id": "A", "timestamp": "2026-05-09T10:00:00", "vehicle_count": 40, "avg_speed": 30.0},
        {"sensor_id": "A", "timestamp": "2026-05-09T10:00:05", "vehicle_count": 90, "avg_speed": 4.5},
        {"sensor_id": "B", "timestamp": "not a time", "vehicle_count": 10, "avg_speed": 20.0},
    ]
    payload = spark.createDataFrame([(json.dumps(x),) for x in lines], "value string")
    batch = decode(payload, ingested_at=F.lit("2026-05-09 10:00:10").cast("timestamp"))
    base = f"{tmp_dir}/tables"
    write = fan_out_writer(stateless_outputs(base))
    write(batch, 3)
    write(batch, 3)  # replay of the same micro-batch
    raw = read_sink(spark, f"{base}/traffic_events")
    alerts = read_sink(spark, f"{base}/critical_traffic")
    bad = read_sink(spark, f"{base}/quarantine")
    assert raw.count() == 2 and alerts.count() == 1 and bad.count() == 1
    alert = alerts.first()
    assert (alert.vehicle_count, alert.alerted_at.strftime("%H:%M:%S")) == (90, "10:00:10")
    assert bad.first().reason == "bad or missing timestamp"


def test_batch_is_written_by_the_tasks_that_made_it(spark, tmp_dir):
    """No task count by size: each of the 16 tasks writes its rows; no file is longer than asked; nothing stays cached."""
    import glob

    import pyarrow.parquet as pq

    df = (
        spark.range(0, 400, numPartitions=16)
        .select(
            F.lit("A").alias("sensor_id"),
            F.timestamp_seconds(F.lit(1_778_400_000) + F.col("id")).alias("window_start"),
            F.col("id").cast("bigint").alias("total_vehicles"),
        )
        .withColumn("window_end", F.col("window_start") + F.expr("INTERVAL 5 MINUTES"))
    )
    out = f"{tmp_dir}/windows"
    table_writer(out, "congestion_index", rows_per_file=10)(df, 0)
    files = glob.glob(f"{out}/window_date=*/run=batch/batch_id=0/*.parquet")
    assert len(files) == 48 and max(pq.read_metadata(f).num_rows for f in files) == 10
    assert read_sink(spark, out).count() == 400
    assert spark._jsparkSession.sharedState().cacheManager().isEmpty()


@pytest.mark.parametrize("again", ["new checkpoint", "other mode"])
def test_a_new_checkpoint_never_overwrites_stored_rows(spark, tmp_dir, again):
    """Batch numbers start at 0 again with a new checkpoint; the rows of the first run stay."""
    for k, fan_out in enumerate([True, again == "new checkpoint"]):
        _write_files(f"{tmp_dir}/src{k}", [[(f"10:0{i}:{k}0", 1 + i) for i in range(5)]])
        cp = f"{tmp_dir}/cp{k}" if again == "new checkpoint" else f"{tmp_dir}/cp"
        source = text_source(spark, f"{tmp_dir}/src{k}")
        await_all(run_pipeline(spark, source, f"{tmp_dir}/t", cp, available_now=True, fan_out=fan_out))
        assert read_sink(spark, f"{tmp_dir}/t/traffic_events").count() == 5 * (k + 1)


@pytest.mark.parametrize("name", ["raw_stream", "critical_stream", "congestion_stream", "alert_tally_stream"])
def test_streams_read_a_table_of_several_files(spark, tmp_dir, name):
    from junctionflow.plans.catalog import QUERIES

    load_events(spark, SF_SMALL).repartition(4).write.parquet(f"{tmp_dir}/events.parquet")
    got, want = QUERIES[name](spark, tmp_dir), QUERIES[name](spark, SF_SMALL)
    assert want.count() > 0
    assert got.exceptAll(want.select(*got.columns)).count() == 0 == want.select(*got.columns).exceptAll(got).count()


def test_stream_reads_its_source_once_a_batch(spark, tmp_dir):
    """No count or emptiness job beside the write: each file's rows are read once."""
    _write_files(f"{tmp_dir}/src", [[("10:00:00", 1)], [("10:01:00", 2)]])
    reads = spark.sparkContext.accumulator(0)
    source = text_source(spark, f"{tmp_dir}/src", max_files_per_trigger=1)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    accepted, _ = parse(source.select("value").mapInArrow(counted, "value string"))
    q = start(raw_events(accepted), table_writer(f"{tmp_dir}/out", "traffic_events"), None, f"{tmp_dir}/cp", available_now=True)
    q.awaitTermination()
    assert read_sink(spark, f"{tmp_dir}/out").count() == 2 and reads.value == 2


def test_state_writer_keeps_one_row_a_key_and_survives_a_replay(spark, tmp_dir):
    from junctionflow.streaming import read_state, state_writer

    write = state_writer(f"{tmp_dir}/s", ["k"])
    frame = lambda rows: spark.createDataFrame(rows, "k string, n long")
    write(frame([("a", 1), ("b", 1)]), 0)
    write(frame([("a", 2)]), 1)
    write(frame([("c", 1)]), 2)
    write(frame([("c", 1)]), 2)
    got = read_state(spark, f"{tmp_dir}/s", "batch")
    assert sorted(map(tuple, got.collect())) == [("a", 2), ("b", 1), ("c", 1)]
    assert sorted(x for x in os.listdir(f"{tmp_dir}/s/run=batch") if x.startswith("version")) == ["version=1", "version=2"]


def test_streams_write_their_lines(spark, tmp_dir):
    """Literal lines, as the original prints them."""
    rows = [("10:00:00", 90, 4.5), ("10:01:00", 30, 25.5), ("10:30:00", 1, 50.0)]
    os.makedirs(f"{tmp_dir}/src")
    with open(f"{tmp_dir}/src/a.json", "w") as f:
        for t, n, v in rows:
            f.write(json.dumps({"sensor_id": "Junction_A", "timestamp": f"2026-05-09T{t}", "vehicle_count": n, "avg_speed": v}) + "\n")
    source = text_source(spark, f"{tmp_dir}/src")
    await_all(run_pipeline(spark, source, f"{tmp_dir}/t", f"{tmp_dir}/cp", available_now=True, with_lines=True))
    alert = spark.read.text(f"{tmp_dir}/t/critical_traffic_lines").select("value").collect()
    window = spark.read.text(f"{tmp_dir}/t/congestion_index_lines").select("value").collect()
    assert [r.value for r in alert] == ["🚨 ALERT | Junction_A                   | vehicles:  90 | speed: 4.5 km/h ← CRITICAL"]
    assert [r.value for r in window] == ["[Window] 10:00→10:05 | Junction_A                   | vehicles:  120 | speed:  15.0 | idx: 8.00"]


def test_default_mode_runs_at_the_shorter_trigger(spark):
    from junctionflow.streaming.pipeline import shorter

    assert shorter(spark, "10 seconds", "5 seconds") == "5 seconds"
    assert shorter(spark, "2 seconds", "1 minute") == "2 seconds"


def test_source_zone_reads_naive_times_of_another_clock(spark):
    payload = spark.createDataFrame(
        [(json.dumps({"sensor_id": k, "timestamp": t, "vehicle_count": 1, "avg_speed": 1.0}),) for k, t in
         (("a", "2026-05-09T10:00:00"), ("b", "2026-05-09T10:00:00Z"), ("c", "nonsense"))],
        "value string",
    )
    from junctionflow.sources import decode

    show = lambda zone: {r.sensor_id: r.t for r in decode(payload, source_zone=zone).selectExpr("sensor_id", "date_format(event_time, 'HH:mm') t").collect()}
    assert show(None) == {"a": "10:00", "b": "10:00", "c": None}
    assert show("Asia/Colombo") == {"a": "04:30", "b": "10:00", "c": None}


def test_batch_and_stream_shuffle_widths_are_separate(spark, tmp_dir):
    """cluster_conf: batch shuffles start wide (AQE coalesces); window state keeps its own width."""
    from junctionflow.session import cluster_conf

    conf = cluster_conf(executors=4, cores_per_executor=1)
    assert conf["spark.sql.shuffle.partitions"] == "4"
    assert conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "16"
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, conf[k])
        batch = load_events(spark, SF_SMALL).groupBy("event_type").count()
        assert ", 16), ENSURE_REQUIREMENTS" in batch._jdf.queryExecution().executedPlan().toString()
        _write_files(f"{tmp_dir}/src", [[("10:01:00", 1)], [("10:20:00", 2)]])
        accepted, _ = parse(text_source(spark, f"{tmp_dir}/src"))
        q = start(
            congestion_windows(accepted),
            table_writer(f"{tmp_dir}/out", "congestion_index"),
            name=None,
            checkpoint=f"{tmp_dir}/cp",
            available_now=True,
        )
        q.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    widths = {op["numShufflePartitions"] for p in q.recentProgress for op in p["stateOperators"]}
    assert widths == {4}


def test_stateful_streams_aggregate_each_batch_before_the_state_shuffle(spark, tmp_dir):
    """Window and tally state see pre-aggregated rows: a hot sensor adds one row per task and key."""
    import contextlib
    import io

    from junctionflow.operators import sensor_tally
    from junctionflow.sources.events import readings, stream_events

    frames = {
        "congestion_index": (congestion_windows(readings(stream_events(spark, SF_SMALL))), "append"),
        "sensor_tally": (sensor_tally(readings(stream_events(spark, SF_SMALL))), "update"),
    }
    for table, (df, mode) in frames.items():
        q = start(
            df,
            table_writer(f"{tmp_dir}/{table}", table),
            name=None,
            checkpoint=f"{tmp_dir}/cp_{table}",
            available_now=True,
            mode=mode,
        )
        q.awaitTermination()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            q.explain()
        lines = buf.getvalue().splitlines()
        i = next(k for k, line in enumerate(lines) if "Exchange hashpartitioning" in line)
        assert "REQUIRED_BY_STATEFUL_OPERATOR" in lines[i]
        assert "HashAggregate" in lines[i + 1] and "partial_" in lines[i + 1], lines[i + 1]
        assert any("StateStoreSave" in line for line in lines[:i])
