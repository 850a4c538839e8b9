"""Micro-batch sinks and query start-up.

``foreachBatch`` is at-least-once: after a failure the last batch is replayed.
Tables are laid out ``<date>=D/run=R/batch_id=N`` and each batch is written with
dynamic partition overwrite, so a replay replaces exactly the folders of its
first attempt instead of appending twice. R is the id of the streaming query,
which its checkpoint keeps: a new checkpoint counts batches from 0 again, but
under another R, so it never touches rows that are stored. A nightly read prunes
to the date folders of its range before listing any batch folder.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..sources.jdbc import store_once
from ..sources.tables import PARTITION_COLUMN, STAMPED, file_system, read_files

log = logging.getLogger("junctionflow.sinks")

# Time column whose date becomes the partition column of each table.
DATE_SOURCE = {
    "traffic_events": "event_timestamp",
    "critical_traffic": "alerted_at",
    "congestion_index": "window_start",
}

BatchFn = Callable[[DataFrame, int], None]


def with_partition_date(df: DataFrame, table: str) -> DataFrame:
    part = PARTITION_COLUMN.get(table)
    src = DATE_SOURCE.get(table)
    if part and src and src in df.columns and part not in df.columns:
        return df.withColumn(part, F.to_date(F.col(src)))
    return df


def stamped(df: DataFrame, table: str) -> DataFrame:
    """Rows with the time they are stored, for the table that keeps it (windows have no ingest time of their own)."""
    if table in STAMPED and "created_at" not in df.columns:
        return df.withColumn("created_at", F.current_timestamp())
    return df


def run_key(spark: SparkSession) -> str:
    """Id of the streaming query that runs this micro-batch (kept in its checkpoint); "batch" outside of one."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def table_writer(
    path: str,
    table: str,
    fmt: str = "parquet",
    jdbc: dict | None = None,
    on_batch: Callable[[str, int, int], None] | None = None,
    rows_per_file: int = 5_000_000,
    lines: Callable[[DataFrame], DataFrame] | None = None,
) -> BatchFn:
    """A ``foreachBatch`` function that appends one micro-batch to ``table``.

    * one job a batch: the tasks that made the rows write them, and the row count
      comes from an ``Observation`` on that write. An empty batch writes no rows;
    * no file holds more than ``rows_per_file`` rows; the small files of many
      batches are merged when their day is closed (:func:`..plans.housekeeping.compact_day`);
    * ``jdbc`` = ``{"url":..., "props": {...}}`` appends through JDBC instead of files, each
      batch once (:func:`..sources.jdbc.store_once`);
    * ``lines`` also writes the batch's formatted lines, as text next to the table
      (``<path>_lines``); the batch is cached for the two writes.
    """

    def save(df: DataFrame, batch_id: int, target: str, kind: str) -> None:
        df = with_partition_date(df, table).withColumns({"run": F.lit(run_key(df.sparkSession)), "batch_id": F.lit(batch_id)})
        part = PARTITION_COLUMN.get(table)
        # Date first: a nightly read lists only the date folders it needs.
        keys = [part, "run", "batch_id"] if part and part in df.columns else ["run", "batch_id"]
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("maxRecordsPerFile", rows_per_file)
            .partitionBy(*keys)
            .format(kind)
            .save(target)
        )

    def write(df: DataFrame, batch_id: int) -> None:
        df = df.persist() if lines is not None else df
        try:
            obs = Observation(f"{table}_{batch_id}")
            out = stamped(df, table).observe(obs, F.count(F.lit(1)).alias("rows"))
            if jdbc is not None:
                if not store_once(out, jdbc["url"], jdbc.get("table", table), run_key(df.sparkSession), batch_id, jdbc.get("props")):
                    # Stored by an attempt that was cut before the query noted it; a stateful query still has to commit its state.
                    out.write.format("noop").mode("overwrite").save()
                    log.info("[%s] batch %d was stored before", table, batch_id)
                    return
            else:
                save(out, batch_id, path, fmt)
            if lines is not None:
                save(lines(df).select("line"), batch_id, f"{path}_lines", "text")
            rows = int(obs.get.get("rows", 0))
            log.info("[%s] batch %d -> %d rows", table, batch_id, rows)
            if on_batch is not None and rows:
                on_batch(table, batch_id, rows)
        finally:
            if lines is not None:
                df.unpersist()

    return write


def state_writer(path: str, keys: list[str]) -> BatchFn:
    """A ``foreachBatch`` function that keeps only the newest row of each key of an update-mode stream.

    Each batch writes the whole state as a new version (the one before it, with
    this batch's keys replaced), so a replayed batch starts from the same version
    again; versions before the last two are dropped. Size: one row a key, not one
    row a key and batch.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        root = f"{path}/run={run_key(spark)}"
        before = [v for v in state_versions(spark, root) if v < batch_id]
        df = df.persist()
        try:
            new = df
            if before:
                old = spark.read.schema(df.schema).parquet(f"{root}/version={before[-1]}")
                new = old.join(df.select(*keys), keys, "left_anti").unionByName(df)
            new.write.mode("overwrite").parquet(f"{root}/version={batch_id}")
        finally:
            df.unpersist()
        for v in before[:-1]:
            fs, p = file_system(spark, f"{root}/version={v}")
            fs.delete(p, True)

    return write


def state_versions(spark: SparkSession, root: str) -> list[int]:
    fs, p = file_system(spark, root)
    if not fs.exists(p):
        return []
    names = [st.getPath() for st in fs.listStatus(p) if st.isDirectory()]
    done = [n.getName() for n in names if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(n, "_SUCCESS"))]
    return sorted(int(n.partition("=")[2]) for n in done if n.startswith("version="))


def read_state(spark: SparkSession, path: str, run: str) -> DataFrame:
    """The newest finished version of a :func:`state_writer` folder for one streaming query."""
    root = f"{path}/run={run}"
    return spark.read.parquet(f"{root}/version={state_versions(spark, root)[-1]}")


#: Deltas of a keyed state that are folded into one when there are more.
FOLD_AFTER = 16


def delta_writer(path: str, keys: list[str], fold_after: int = FOLD_AFTER) -> BatchFn:
    """A ``foreachBatch`` function that keeps the newest row of each key of an update-mode stream as deltas.

    A batch writes only the keys it changed, as ``run=R/delta=A-B`` (batches A to
    B; A = B at first), so its bytes follow the changed keys and not the state.
    After ``fold_after`` deltas the finished ones before this batch are folded
    into one. A reader (:func:`read_deltas`) takes, of deltas that overlap, the
    widest, so it sees each batch once whether or not the folded ones are gone
    yet. A replayed batch replaces its own delta.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        root = f"{path}/run={run_key(spark)}"
        df.write.mode("overwrite").parquet(f"{root}/delta={batch_id}-{batch_id}")
        spans = _delta_spans(spark, root)
        if len([s for s in spans if s[1] < batch_id]) >= fold_after:
            _fold_deltas(spark, root, keys, df, [s for s in spans if s[1] < batch_id])

    return write


def _delta_spans(spark: SparkSession, root: str, covered: bool = False) -> list[tuple[int, int]]:
    """Finished deltas (first, last batch) in order: those that no other holds, or those that another does (``covered``)."""
    fs, p = file_system(spark, root)
    if not fs.exists(p):
        return []
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    names = [st.getPath() for st in fs.listStatus(p) if st.isDirectory() and st.getPath().getName().startswith("delta=")]
    spans = sorted(tuple(map(int, n.getName()[6:].split("-"))) for n in names if fs.exists(path(n, "_SUCCESS")))
    held = {s for s in spans if any(o != s and o[0] <= s[0] and s[1] <= o[1] for o in spans)}
    return sorted(held) if covered else [s for s in spans if s not in held]


def _newest(spark: SparkSession, root: str, keys: list[str], schema, spans: list[tuple[int, int]]) -> DataFrame:
    """The newest row of each key over some deltas, which hold a key once each."""
    parts = [spark.read.schema(schema).parquet(f"{root}/delta={a}-{b}").withColumn("__last", F.lit(b)) for a, b in spans]
    whole = reduce(DataFrame.unionByName, parts)
    rest = [c for c in whole.columns if c not in keys and c != "__last"]
    newest = whole.groupBy(*keys).agg(F.max_by(F.struct(*rest), "__last").alias("__row"))
    return newest.select(*keys, "__row.*").select(*[c for c in whole.columns if c != "__last"])


def _fold_deltas(spark: SparkSession, root: str, keys: list[str], like: DataFrame, spans: list[tuple[int, int]]) -> None:
    folded = f"{root}/delta={spans[0][0]}-{spans[-1][1]}"
    _newest(spark, root, keys, like.schema, spans).write.mode("overwrite").parquet(folded)
    for a, b in _delta_spans(spark, root, covered=True):
        fs, p = file_system(spark, f"{root}/delta={a}-{b}")
        fs.delete(p, True)


def read_deltas(spark: SparkSession, path: str, run: str, keys: list[str]) -> DataFrame:
    """The state that a :func:`delta_writer` keeps for one streaming query: each key's newest row."""
    root = f"{path}/run={run}"
    spans = _delta_spans(spark, root)
    if not spans:
        raise FileNotFoundError(f"no state in {root}")
    return _newest(spark, root, keys, spark.read.parquet(f"{root}/delta={spans[0][0]}-{spans[0][1]}").schema, spans)


def fan_out_writer(outputs: Mapping[str, tuple[Callable[[DataFrame], DataFrame], BatchFn]]) -> BatchFn:
    """One ``foreachBatch`` function that fills several tables from one micro-batch.

    ``outputs`` maps a table to ``(rows_of(batch), writer)``. The batch is read
    from the source and decoded once, cached, and every table's rows are derived
    from the cache; each writer keeps its own replay-safe ``(date, run, batch_id)``
    overwrite, so a replayed batch still replaces all of its tables.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            for rows_of, writer in outputs.values():
                writer(rows_of(df), batch_id)
        finally:
            df.unpersist()

    return write


def start(
    df: DataFrame,
    batch_fn: BatchFn,
    name: str | None,
    checkpoint: str,
    trigger: str | None = None,
    available_now: bool = False,
    mode: str = "append",
) -> StreamingQuery:
    """Start one streaming query with a durable checkpoint and a trigger.

    ``trigger`` is a processing-time interval (e.g. "10 seconds");
    ``available_now`` processes everything present, then stops (tests, backfills).
    """
    late_rows(df.sparkSession)
    w = (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(batch_fn)
    )
    if name:
        w = w.queryName(name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()


class LateRows(StreamingQueryListener):
    """Adds up, over a query's whole run, the rows that the watermark dropped as too late."""

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        late = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        key = str(event.progress.id)
        self.dropped[key] = self.dropped.get(key, 0) + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


_listeners: dict[str, LateRows] = {}


def late_rows(spark: SparkSession) -> LateRows:
    """The session's counter of late rows; registered once, before the first query that it should see."""
    key = f"{spark.sparkContext.applicationId}/{id(spark._jsparkSession)}"
    if key not in _listeners:
        _listeners[key] = LateRows()
        spark.streams.addListener(_listeners[key])
    return _listeners[key]


def late_rows_dropped(query: StreamingQuery, spark: SparkSession | None = None) -> int:
    """Rows the watermark dropped as too late for their window (the only place late data is lost), over the whole run."""
    spark = spark or SparkSession.active()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return late_rows(spark).dropped.get(str(query.id), 0)


def read_sink(spark: SparkSession, path: str, fmt: str = "parquet", table: str | None = None) -> DataFrame:
    """Read a sink folder back (the date, run and batch_id of the folders are columns).

    With ``table`` the declared schema is used and a folder that no batch has
    made yet is an empty table.
    """
    return read_files(spark, path, fmt, table)


def expired_partitions(partitions: DataFrame, part_col: str, as_of, keep: str) -> DataFrame:
    """Date partitions entirely older than the retention cut (candidates for a folder drop)."""
    from ..functions import cutoff

    return partitions.filter(F.col(part_col) < F.to_date(cutoff(as_of, keep)))
