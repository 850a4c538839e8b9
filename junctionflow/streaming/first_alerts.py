"""The per-sensor cap on a stream: each sensor's earliest ``n`` alerts, each reported once.

The batch form is :func:`..operators.first_n_alerts`. On a stream an alert's rank
is known when the watermark has passed its time, as no earlier alert can come
after that; until then at most ``n`` candidates of a sensor wait in its state.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ORDER = ["at", "vehicle_count", "avg_speed"]
STATE = "given int, timer long, at array<long>, vehicle_count array<int>, avg_speed array<double>"
OUT = "sensor_id string, at long, vehicle_count int, avg_speed double, alert_rank int"


def _or_none(values) -> list:
    return [None if pd.isna(v) else v for v in values]


class FirstAlerts(StatefulProcessor):
    """One value a sensor: how many alerts are out, the waiting candidates, and the timer of the earliest one."""

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("first_alerts", STATE)

    def _read(self) -> tuple[int, int, pd.DataFrame]:
        given, timer, *held = self.state.get() if self.state.exists() else (0, -1, [], [], [])
        return given, timer, pd.DataFrame({c: pd.Series(list(v), dtype=t) for c, v, t in zip(ORDER, held, ("int64", "Int32", "float64"))})

    def _keep(self, given: int, timer: int, held: pd.DataFrame) -> None:
        """Store what waits, with one timer: the millisecond in which the earliest candidate is settled."""
        due = -(-int(held["at"].iloc[0]) // 1000) if len(held) else -1
        if due != timer:
            if timer >= 0:
                self.handle.deleteTimer(timer)
            if due >= 0:
                self.handle.registerTimer(due)
        counts = [None if v is None else int(v) for v in _or_none(held["vehicle_count"])]
        self.state.update((given, due, [int(v) for v in held["at"]], counts, [float(v) for v in held["avg_speed"]]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        given, timer, held = self._read()
        if given >= self.n:
            return iter(())
        for chunk in rows:
            chunk = chunk[ORDER].astype({"vehicle_count": "Int32"})
            held = pd.concat([held, chunk]).sort_values(ORDER, kind="stable", na_position="first").head(self.n - given)
        self._keep(given, timer, held)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        given, _, held = self._read()
        settled = held["at"] <= timerValues.getCurrentWatermarkInMs() * 1000
        out = held[settled].reset_index(drop=True)
        self._keep(given + len(out), -1, held[~settled].reset_index(drop=True))
        out.insert(0, "sensor_id", key[0])
        yield out.assign(alert_rank=range(given + 1, given + len(out) + 1))

    def close(self) -> None:
        pass


def first_alerts_stream(critical_traffic: DataFrame, n: int, delay: str) -> DataFrame:
    """A streaming frame of each sensor's ``n`` earliest alerts (ties: fewer vehicles, then lower speed), in append mode.

    An alert comes out when the watermark, ``delay`` behind the newest alert, has
    passed it; alerts later than that are dropped. State is at most ``n``
    candidates a sensor, whatever the number of its alerts; once ``n`` are out
    only that number stays. Rows of a sensor are cut to the ``n`` least a block
    of Arrow rows at a time. Alerts without a time have no rank and are left out.
    Start the query inside :func:`rocksdb_state`.
    """
    rows = critical_traffic.filter("event_timestamp is not null").withWatermark("event_timestamp", delay)
    rows = rows.select("sensor_id", "event_timestamp", F.unix_micros("event_timestamp").alias("at"), F.col("vehicle_count").cast("int").alias("vehicle_count"), "avg_speed")
    out = rows.groupBy("sensor_id").transformWithStateInPandas(FirstAlerts(n), OUT, "Append", "EventTime")
    return out.select("sensor_id", F.timestamp_micros("at").alias("event_timestamp"), "vehicle_count", "avg_speed", "alert_rank")


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries that start inside keep their state in RocksDB (arbitrary state needs it); the session is as before after that."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)
