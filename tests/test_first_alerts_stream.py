"""The per-sensor cap on a stream: ranks, late rows, ties and nulls, and a restart in the middle."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from junctionflow.operators import first_n_alerts
from junctionflow.streaming.first_alerts import PROVIDER, first_alerts_stream, rocksdb_state
from junctionflow.streaming.sinks import read_sink, start, table_writer

from .conftest import rows

SCHEMA = "sensor_id string, event_timestamp timestamp, vehicle_count int, avg_speed double, alerted_at timestamp"
COLS = ("sensor_id", "event_timestamp", "vehicle_count", "avg_speed", "alert_rank")
T0 = dt.datetime(2024, 1, 1)


def alert(sensor, minute, count=1, speed=5.0):
    at = None if minute is None else T0 + dt.timedelta(minutes=minute)
    return (sensor, at, count, speed, at)


class Run:
    """A folder of alerts that one query reads a file at a time, over as many starts as a test likes."""

    def __init__(self, spark, base, n=3, delay="10 minutes"):
        self.spark, self.base, self.n, self.delay = spark, base, n, delay

    def send(self, alerts):
        self.spark.createDataFrame(alerts, SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.base}/in")

    def drain(self):
        source = self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{self.base}/in")
        with rocksdb_state(self.spark):
            q = start(first_alerts_stream(source, self.n, self.delay), table_writer(f"{self.base}/out", "first_alerts"), None, f"{self.base}/cp", available_now=True)
            q.awaitTermination()
        assert q.exception() is None
        return q

    def result(self):
        return rows(read_sink(self.spark, f"{self.base}/out"), *COLS)


def test_ranks_come_out_once_over_a_restart(spark, tmp_dir):
    before = spark.conf.get(PROVIDER)
    run = Run(spark, tmp_dir)
    rng = random.Random(5)
    minutes = sorted(rng.sample(range(0, 400), 40))
    alerts = [alert(s, m, rng.randrange(3), float(rng.randrange(40))) for s in "abc" for m in minutes if rng.random() < 0.5]
    early, late = [a for a in alerts if a[1] < T0 + dt.timedelta(minutes=200)], [a for a in alerts if a[1] >= T0 + dt.timedelta(minutes=200)]
    run.send(early[:: 2] + early[1::2])
    run.drain()
    some = run.result()
    run.send(late + [alert("d", 399)])
    run.send([alert("z", 10_000)])
    run.drain()
    want = rows(first_n_alerts(spark.createDataFrame(early + late + [alert("d", 399)], SCHEMA), 3), *COLS)
    assert run.result() == want and set(some) < set(want)  # z waits for the watermark
    run.send([alert("z", 20_000)])
    run.drain()
    assert run.result() == sorted(want + [("z", T0 + dt.timedelta(minutes=10_000), 1, 5.0, 1)])
    assert spark.conf.get(PROVIDER) == before


def test_late_within_the_delay_takes_its_rank_and_later_is_dropped(spark, tmp_dir):
    run = Run(spark, tmp_dir, n=2)
    run.send([alert("a", 100), alert("a", 101), alert("a", 102)])
    run.send([alert("b", 101)])
    run.send([alert("a", 95, 7), alert("a", 80)])  # rows up to minute 92 were settled in the batch before
    run.send([alert("b", 1_000)])
    q = run.drain()
    got = [(s, (t - T0).seconds // 60, c, r) for s, t, c, _, r in run.result()]
    assert got == [("a", 95, 7, 1), ("a", 100, 1, 2), ("b", 101, 1, 1)]
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 3 * 2  # a value and a timer a sensor, not its alerts


def test_ties_nulls_and_repeats(spark, tmp_dir):
    run = Run(spark, tmp_dir, n=4)
    alerts = [alert("a", 5, 2, 3.0), alert("a", 5, 1, 9.0), alert("a", 5, 1, 4.0), alert("a", 5, None, 8.0), alert("a", 5, 1, 4.0), alert(None, 6), alert("a", None)]
    run.send(alerts)
    run.send([alert("z", 10_000)])
    run.drain()
    got = [(s, c, v, r) for s, _, c, v, r in sorted(read_sink(spark, f"{tmp_dir}/out").select(*COLS).collect(), key=lambda r: (r.sensor_id is None, r.alert_rank))]
    assert got == [("a", None, 8.0, 1), ("a", 1, 4.0, 2), ("a", 1, 4.0, 3), ("a", 1, 9.0, 4), (None, 1, 5.0, 1)]


@pytest.mark.parametrize("chunk", [1, 7])
def test_blocks_of_rows_do_not_matter(spark, tmp_dir, chunk):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, chunk)
    try:
        run = Run(spark, tmp_dir, n=3)
        alerts = [alert("hot", m % 97, m % 5, float(m % 11)) for m in range(200)]
        run.send(alerts)
        run.send([alert("z", 10_000)])
        run.drain()
        assert run.result() == rows(first_n_alerts(spark.createDataFrame(alerts, SCHEMA), 3), *COLS)
    finally:
        spark.conf.set(key, before)
