"""Registered queries: every operator run over the driver's ``events`` table.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame built from the
whole ``events`` table (through the reading adapter), so its work grows with
the data. Output conventions, shared with :mod:`junctionflow.plans.oracle`:

* timestamps are returned as TIMESTAMP_NTZ (zone-free, comparable anywhere);
* exact means (sum/count of doubles) are snapped to 6 decimals, which removes
  last-bit differences caused by summation order without changing any value
  the reports show; rounded columns use the same decimal-snapped rounding.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params
from ..functions import round_half_up
from ..operators import (
    readings_for_windows_since,
    alert_counts,
    alert_hour_map,
    alert_lines,
    alert_overlay,
    alert_tally,
    append_history,
    chart_volume,
    congestion_avg,
    congestion_by_hour,
    congestion_series,
    congestion_windows,
    critical_alerts,
    daily_peak_rows,
    day_rollup,
    distinct_readings,
    dense_hour_grid,
    dense_peak_hour,
    first_n_alerts,
    hourly_report,
    hourly_series,
    hourly_traffic,
    junction_count,
    latest_alerts,
    peak_hour,
    peak_lines,
    police_decision,
    police_plan,
    profile_summary,
    raw_events,
    retain,
    rollup_alerts,
    rollup_congestion,
    rollup_congestion_all,
    rollup_hourly,
    sensor_profile_check,
    table_row_counts,
    top_congestion_windows,
    window_lines,
)
from ..session import scratch_path
from ..sources import events as ev
from ..sources.parse import parse
from ..streaming.first_alerts import first_alerts_stream, rocksdb_state
from ..streaming.pipeline import await_all, speed_layer_frames, start_tables
from ..sources.footers import newest_days, stored_row_counts, top_days
from ..sources.tables import partition_days, read_days, read_range, read_table, table_path
from ..streaming.progress import ProgressTable, query_totals, read_progress
from ..streaming.sinks import delta_writer, read_deltas, read_sink, start, table_writer
from .colocated import colocated_decision, store_hours
from .corrections import correct_windows
from .nightly import nightly_frames
from .report import deployment_report_lines, hourly_csv_rows

# --- fixed values: the replay instant of the test data ---------------------
AS_OF = "2024-01-31 00:00:00"
REPORT_DATE = "2024-01-31"
PREVIOUS_AS_OF = "2024-01-30 00:00:00"
PREVIOUS_REPORT_DATE = "2024-01-30"
GENERATED = "2024-01-31 00:00:00"
# Instants at which part of the stored rows is older than the retention periods.
RAW_RETENTION_AS_OF = "2024-04-15 00:00:00"
AGGREGATE_RETENTION_AS_OF = "2026-01-15 00:00:00"
# Ranges of our own for `events` (speed lo/hi, count lo/hi); `error` has none.
PROFILE = [
    ("click", 0, 40, 0, 50),
    ("view", 25, 75, 10, 90),
    ("purchase", 5, 95, 40, 100),
    ("signup", 50, 100, 0, 60),
]
# Alerts per sensor in the report of first alerts.
FIRST_ALERTS = 5
# How far behind the newest alert the stream of first alerts waits for late ones.
FIRST_ALERTS_DELAY = "4 days"
# Thresholds that no junction reaches: a night without any deployment.
QUIET_RULE = params.PoliceRule(index_gt=1e12, alerts_ge=10**12, speed_lt=-1.0)
# A partial earlier run saved tonight's rows of sensors peaking before noon.
PARTIAL_RUN_BEFORE_HOUR = 12
# ---------------------------------------------------------------------------

Query = Callable[[SparkSession, str], DataFrame]


def r6(c) -> F.Column:
    return round_half_up(c, 6)


def ntz(df: DataFrame) -> DataFrame:
    """Cast TIMESTAMP columns to TIMESTAMP_NTZ (session-zone wall clock)."""
    cols = [
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


class EventTables:
    """The three stored tables, derived from ``events`` the way the stream fills them."""

    def __init__(self, spark: SparkSession, sf_dir: str, sensor: str = "event_type"):
        self.spark = spark
        self.sf_dir = sf_dir
        self.sensor = sensor

    # Built on first use only: every DataFrame call is analysed eagerly, so a
    # query should not pay for tables it never reads.
    @cached_property
    def events(self) -> DataFrame:
        return ev.load_events(self.spark, self.sf_dir)

    @cached_property
    def readings(self) -> DataFrame:
        return ev.readings(self.events, self.sensor)

    @cached_property
    def traffic_events(self) -> DataFrame:
        return raw_events(self.readings)

    @cached_property
    def critical_traffic(self) -> DataFrame:
        return critical_alerts(self.readings, at=F.col("event_time"))

    @cached_property
    def congestion_index(self) -> DataFrame:
        return congestion_windows(self.readings, watermark=None)

    # nightly building blocks
    def hourly_24h(self, as_of=AS_OF) -> DataFrame:
        return hourly_traffic(self.traffic_events, as_of)

    def hourly_all(self) -> DataFrame:
        return hourly_report(hourly_traffic(self.traffic_events, lookback=None))

    def alerts_by_hour(self) -> DataFrame:
        return alert_counts(self.critical_traffic, lookback=None, by_hour=True)

    def congestion_hourly(self) -> DataFrame:
        return congestion_avg(self.congestion_index, lookback=None, by_hour=True)

    def windows_since(self, as_of=AS_OF, lookback: str = params.LOOKBACK) -> DataFrame:
        """Windows starting inside the range, computed from only the readings they contain."""
        return congestion_windows(readings_for_windows_since(self.readings, as_of, lookback), watermark=None)

    def decisions(self, variant: str = "rule", as_of=AS_OF, rule=params.PoliceRule()) -> DataFrame:
        peaks = peak_hour(self.hourly_24h(as_of))
        alerts = alert_counts(self.critical_traffic, as_of)
        if variant == "rule":
            cong = congestion_avg(self.windows_since(as_of), as_of, params.LOOKBACK)
        else:
            cong = congestion_avg(self.congestion_index, lookback=None)
        return police_decision(peaks, alerts, cong, rule=rule, variant=variant)


def _decision_out(d: DataFrame) -> DataFrame:
    return d.select(
        "sensor_id",
        "peak_hour",
        "peak_vehicles",
        r6("avg_speed").alias("avg_speed"),
        "alert_count",
        r6("avg_congestion").alias("avg_congestion"),
        "needs_police",
    )


def _history_out(d: DataFrame) -> DataFrame:
    return d.select(
        "report_date", "sensor_id", "peak_hour", "peak_vehicles", r6("avg_congestion").alias("avg_congestion"), "needs_police"
    )


# ----------------------------------------------------------------- sources


def q_parse_readings(spark, sf_dir):
    accepted, _ = parse(ev.payloads(ev.load_events(spark, sf_dir)))
    return ntz(accepted.select("sensor_id", "timestamp", "vehicle_count", "avg_speed", "event_time"))


def q_payload_peek(spark, sf_dir):
    """First five messages by offset, in wire form.

    The payload is a 1:1 projection of an event (offset = event_id), so the
    top-5 is taken on the raw columns first and only those five rows are
    serialised to JSON, instead of every row of the table.
    """
    from ..sources.streams import peek

    return ev.payloads(peek(spark, ev.load_events(spark, sf_dir), n=5, order_by="event_id"))


# ------------------------------------------------------- stateless operators


def q_raw_events(spark, sf_dir):
    return ntz(EventTables(spark, sf_dir).traffic_events)


def q_critical_alerts(spark, sf_dir):
    return ntz(EventTables(spark, sf_dir).critical_traffic)


def q_congestion_windows(spark, sf_dir):
    return ntz(EventTables(spark, sf_dir).congestion_index)


# --------------------------------------------------------------- aggregates


def q_hourly_traffic_24h(spark, sf_dir):
    h = EventTables(spark, sf_dir).hourly_24h()
    return h.select("sensor_id", "hour", "total_vehicles", r6("avg_speed").alias("avg_speed"), "reading_count")


def q_hourly_report_24h(spark, sf_dir):
    return hourly_report(EventTables(spark, sf_dir).hourly_24h()).drop("readings")


def q_hourly_all_time(spark, sf_dir):
    return EventTables(spark, sf_dir).hourly_all()


def q_alert_counts_24h(spark, sf_dir):
    return alert_counts(EventTables(spark, sf_dir).critical_traffic, AS_OF)


def q_alert_counts_by_hour(spark, sf_dir):
    return EventTables(spark, sf_dir).alerts_by_hour()


def q_congestion_avg_24h(spark, sf_dir):
    c = congestion_avg(EventTables(spark, sf_dir).windows_since(AS_OF), AS_OF)
    return c.select("sensor_id", r6("avg_congestion").alias("avg_congestion"))


def q_congestion_avg_all(spark, sf_dir):
    c = congestion_avg(EventTables(spark, sf_dir).congestion_index, lookback=None)
    return c.select("sensor_id", r6("avg_congestion").alias("avg_congestion"))


def q_congestion_by_hour(spark, sf_dir):
    by_hour = EventTables(spark, sf_dir).congestion_hourly().withColumn("avg_idx", r6("avg_idx"))
    return congestion_by_hour(by_hour)


# ------------------------------------------------ peak, decision, history


def q_peak_hour(spark, sf_dir):
    p = peak_hour(EventTables(spark, sf_dir).hourly_24h())
    return p.select("sensor_id", "peak_hour", "peak_vehicles", r6("avg_speed").alias("avg_speed"), "reading_count")


def q_police_decision(spark, sf_dir):
    return _decision_out(EventTables(spark, sf_dir).decisions("rule"))


def q_police_decision_all(spark, sf_dir):
    return _decision_out(EventTables(spark, sf_dir).decisions("all"))


def q_police_decision_users(spark, sf_dir):
    """Same rule with every user as a sensor: many junctions, both flag values."""
    return _decision_out(EventTables(spark, sf_dir, sensor="user_id").decisions("rule"))


def q_police_plan(spark, sf_dir):
    return police_plan(EventTables(spark, sf_dir).decisions("rule"))


def q_police_plan_users(spark, sf_dir):
    return police_plan(EventTables(spark, sf_dir, sensor="user_id").decisions("rule"))


def q_daily_peak_rows(spark, sf_dir):
    return _history_out(daily_peak_rows(EventTables(spark, sf_dir).decisions("rule"), REPORT_DATE))


def q_daily_peak_idempotent(spark, sf_dir):
    t = EventTables(spark, sf_dir)
    # Each night is derived once and written, as the nightly job does; tonight's rows are read three times below.
    base = scratch_path(spark, "daily_peak_idempotent")
    nights = daily_peak_rows(t.decisions("rule", AS_OF), REPORT_DATE).unionByName(
        daily_peak_rows(t.decisions("rule", PREVIOUS_AS_OF), PREVIOUS_REPORT_DATE)
    )
    nights.write.parquet(base)
    nights = spark.read.schema(nights.schema).parquet(base)
    tonight = nights.filter(F.col("report_date") == F.lit(REPORT_DATE).cast("date"))
    previous = nights.filter(F.col("report_date") == F.lit(PREVIOUS_REPORT_DATE).cast("date"))
    history = previous.unionByName(tonight.filter(F.col("peak_hour") < PARTIAL_RUN_BEFORE_HOUR))
    return _history_out(append_history(tonight, history, mode="idempotent", report_date=REPORT_DATE))


# ------------------------------------------------------------------ reports


def q_hourly_csv_rows(spark, sf_dir):
    return hourly_csv_rows(hourly_report(EventTables(spark, sf_dir).hourly_24h()), REPORT_DATE)


def q_deployment_report_lines(spark, sf_dir):
    return deployment_report_lines(EventTables(spark, sf_dir).decisions("rule"), GENERATED, "rule")


def q_deployment_report_all(spark, sf_dir):
    return deployment_report_lines(EventTables(spark, sf_dir).decisions("all"), GENERATED, "all")


def q_deployment_report_users(spark, sf_dir):
    """Flagged and unflagged junctions in one report."""
    return deployment_report_lines(EventTables(spark, sf_dir, sensor="user_id").decisions("rule"), GENERATED, "rule")


def q_deployment_report_quiet(spark, sf_dir):
    """A night on which no junction is flagged: the fallback line."""
    return deployment_report_lines(EventTables(spark, sf_dir).decisions("rule", rule=QUIET_RULE), GENERATED, "rule")


def q_alert_lines(spark, sf_dir):
    return ntz(alert_lines(EventTables(spark, sf_dir).critical_traffic))


def q_window_lines(spark, sf_dir):
    return ntz(window_lines(EventTables(spark, sf_dir).congestion_index))


def q_peak_lines(spark, sf_dir):
    return peak_lines(EventTables(spark, sf_dir).decisions("all"), style="summary")


def q_peak_log_lines(spark, sf_dir):
    return peak_lines(EventTables(spark, sf_dir).decisions("rule"), style="log")


def q_peak_log_lines_users(spark, sf_dir):
    return peak_lines(EventTables(spark, sf_dir, sensor="user_id").decisions("rule"), style="log")


def q_nightly_from_tables(spark, sf_dir):
    """The decision from stored tables: the sinks' folders, read back over the night's date folders."""
    base = scratch_path(spark, "nightly_from_tables")
    t = EventTables(spark, sf_dir)
    for name in ("traffic_events", "critical_traffic", "congestion_index"):
        table_writer(table_path(base, name), name)(getattr(t, name), 0)
    s = {name: read_range(spark, name, base, AS_OF) for name in ("traffic_events", "critical_traffic", "congestion_index")}
    n = nightly_frames(s["traffic_events"], s["critical_traffic"], s["congestion_index"], AS_OF, REPORT_DATE)
    return _decision_out(n.decisions)


# ------------------------------------------------------------ chart frames


def _rollup(spark, sf_dir, sensor: str = "event_type") -> DataFrame:
    """The rollup of all days, written and read back."""
    t = EventTables(spark, sf_dir, sensor)
    base = scratch_path(spark, "rollup")
    day_rollup(t.traffic_events, t.critical_traffic, t.congestion_index).write.parquet(table_path(base, "night_rollup"))
    return read_table(spark, "night_rollup", base)


def q_hourly_all_time_rollup(spark, sf_dir):
    return hourly_report(rollup_hourly(_rollup(spark, sf_dir)))


def q_chart_volume_rollup(spark, sf_dir):
    r = _rollup(spark, sf_dir, sensor="junction")
    return chart_volume(hourly_report(rollup_hourly(r)), rollup_alerts(r))


def q_congestion_by_hour_rollup(spark, sf_dir):
    by_hour = rollup_congestion(_rollup(spark, sf_dir)).withColumn("avg_idx", r6("avg_idx"))
    return congestion_by_hour(by_hour)


def q_dense_hour_grid(spark, sf_dir):
    return dense_hour_grid(EventTables(spark, sf_dir).hourly_all())


def q_dense_peak_hour(spark, sf_dir):
    return dense_peak_hour(EventTables(spark, sf_dir).hourly_all())


def q_alert_overlay(spark, sf_dir):
    t = EventTables(spark, sf_dir)
    return alert_overlay(t.alerts_by_hour(), t.hourly_all())


def q_chart_volume(spark, sf_dir):
    t = EventTables(spark, sf_dir)
    return chart_volume(t.hourly_all(), t.alerts_by_hour())


def q_hourly_series(spark, sf_dir):
    return hourly_series(EventTables(spark, sf_dir).hourly_all())


def q_congestion_series(spark, sf_dir):
    by_hour = EventTables(spark, sf_dir).congestion_hourly().withColumn("avg_idx", r6("avg_idx"))
    return congestion_series(by_hour)


def q_alert_hour_map(spark, sf_dir):
    return alert_hour_map(EventTables(spark, sf_dir).alerts_by_hour())


# -------------------------------------------------------------- monitoring


def q_table_row_counts(spark, sf_dir):
    t = EventTables(spark, sf_dir)
    return table_row_counts(
        {"traffic_events": t.traffic_events, "critical_traffic": t.critical_traffic, "congestion_index": t.congestion_index}
    )


def q_junction_count(spark, sf_dir):
    return junction_count(EventTables(spark, sf_dir).hourly_24h())


def q_alert_tally(spark, sf_dir):
    return alert_tally(EventTables(spark, sf_dir).readings)


def q_latest_alerts(spark, sf_dir):
    return ntz(latest_alerts(EventTables(spark, sf_dir).critical_traffic, n=5))


def q_top_congestion_windows(spark, sf_dir):
    return ntz(top_congestion_windows(EventTables(spark, sf_dir).congestion_index, n=4))


def q_retention_raw(spark, sf_dir):
    return ntz(retain(EventTables(spark, sf_dir).traffic_events, "event_timestamp", RAW_RETENTION_AS_OF, params.RAW_RETENTION))


def q_retention_aggregates(spark, sf_dir):
    return ntz(retain(EventTables(spark, sf_dir).congestion_index, "window_start", AGGREGATE_RETENTION_AS_OF, params.AGGREGATE_RETENTION))


def q_sensor_profile_check(spark, sf_dir):
    from ..operators import default_profile

    profile = default_profile(spark, PROFILE)
    checked = sensor_profile_check(EventTables(spark, sf_dir).readings, profile)
    return profile_summary(checked)


def q_first_n_alerts(spark, sf_dir):
    return ntz(first_n_alerts(EventTables(spark, sf_dir).critical_traffic, n=FIRST_ALERTS))


# --------------------------------------------------------------- streaming


def _stream_tables(spark: SparkSession, sf_dir: str, tables: list[str], name: str) -> dict[str, DataFrame]:
    """Run the speed layer over ``events`` as a file stream (availableNow) and read the sinks back."""
    base = scratch_path(spark, name)
    readings = ev.readings(ev.stream_events(spark, sf_dir))
    frames = speed_layer_frames(readings, alerted_at=F.col("event_time"))
    frames = {k: v for k, v in frames.items() if k in tables}
    suffix = "_" + base.rsplit("/", 1)[-1]
    queries = start_tables(frames, f"{base}/tables", f"{base}/checkpoints", available_now=True, name_suffix=suffix)
    for q in queries.values():
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"stream {q.name} failed: {q.exception()}")
    out = {}
    for table in tables:
        df = read_sink(spark, f"{base}/tables/{table}", table=table)
        out[table] = ntz(df.drop("run", "batch_id", "event_date", "alert_date", "window_date", "created_at"))
    return out


def q_alert_tally_stream(spark, sf_dir):
    """Running per-sensor tally as a stateful stream in update mode, read back as its latest state."""
    from ..operators import sensor_tally

    base = scratch_path(spark, "alert_tally_stream")
    readings = ev.readings(ev.stream_events(spark, sf_dir))
    q = start(
        sensor_tally(readings),
        delta_writer(f"{base}/tally", ["sensor_id"]),
        name="alert_tally_" + base.rsplit("/", 1)[-1],
        checkpoint=f"{base}/checkpoint",
        available_now=True,
        mode="update",
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream {q.name} failed: {q.exception()}")
    return read_deltas(spark, f"{base}/tally", str(q.id), ["sensor_id"])


def q_raw_stream(spark, sf_dir):
    return _stream_tables(spark, sf_dir, ["traffic_events"], "raw_stream")["traffic_events"]


def q_critical_stream(spark, sf_dir):
    return _stream_tables(spark, sf_dir, ["critical_traffic"], "critical_stream")["critical_traffic"]


def q_congestion_stream(spark, sf_dir):
    return _stream_tables(spark, sf_dir, ["congestion_index"], "congestion_stream")["congestion_index"]


def _shuffled_stream(spark: SparkSession, sf_dir: str, name: str, copies: int = 1) -> tuple[str, DataFrame]:
    """(scratch folder, stream of ``events`` from several files): each file holds some days, and a tenth of the rows comes three days late."""
    base = scratch_path(spark, name)
    sent = F.col("ts") + F.when(F.col("event_id") % 10 == 0, F.expr("INTERVAL 3 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS"))
    rows = ev.load_events(spark, sf_dir).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    rows.repartitionByRange(6, sent, "copy").drop("copy").write.parquet(f"{base}/in/events.parquet")
    return base, ev.stream_events(spark, f"{base}/in", max_files_per_trigger=1)


def q_congestion_corrected(spark, sf_dir):
    """Windows of a stream with very late readings, after the stored days are corrected."""
    base, events = _shuffled_stream(spark, sf_dir, "congestion_corrected")
    frames = speed_layer_frames(ev.readings(events), alerted_at=F.col("event_time"))
    frames = {k: frames[k] for k in ("traffic_events", "congestion_index")}
    queries = start_tables(frames, f"{base}/tables", f"{base}/checkpoints", available_now=True, name_suffix="_" + base.rsplit("/", 1)[-1])
    await_all(queries)
    correct_windows(spark, f"{base}/tables", AS_OF, settle="0 days")
    return ntz(read_table(spark, "congestion_index", f"{base}/tables").drop("run", "batch_id", "window_date", "created_at"))


def q_raw_stream_distinct(spark, sf_dir):
    """Raw readings of a source that delivers every file twice, each stored once."""
    base = scratch_path(spark, "raw_stream_distinct")
    events = ev.load_events(spark, sf_dir)
    for _ in range(2):
        events.write.mode("append").parquet(f"{base}/in/events.parquet")
    raw = raw_events(distinct_readings(ev.readings(ev.stream_events(spark, f"{base}/in"))))
    await_all(start_tables({"traffic_events": raw}, f"{base}/tables", f"{base}/checkpoints", available_now=True, name_suffix="_" + base.rsplit("/", 1)[-1]))
    return ntz(read_table(spark, "traffic_events", f"{base}/tables").drop("run", "batch_id", "event_date"))


def q_batch_counts_stream(spark, sf_dir):
    """Rows and late rows of a stream of several micro-batches, from the durable progress table."""
    base, events = _shuffled_stream(spark, sf_dir, "batch_counts_stream")
    listener = ProgressTable(spark, f"{base}/progress", every=3)
    spark.streams.addListener(listener)
    try:
        await_all(start_tables({"traffic_events": raw_events(ev.readings(events))}, f"{base}/tables", f"{base}/checkpoints", available_now=True, name_suffix="_" + base.rsplit("/", 1)[-1]))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    totals = query_totals(read_progress(spark, f"{base}/progress"))
    return totals.select(F.regexp_replace("query", "_[0-9a-f]+$", "").alias("tbl"), F.col("rows").alias("row_count"), "late_rows")


def _stored(spark: SparkSession, sf_dir: str, name: str, tables: tuple[str, ...]) -> str:
    """A scratch folder with these tables, stored as the streams store them."""
    base, t = scratch_path(spark, name), EventTables(spark, sf_dir)
    for table in tables:
        table_writer(table_path(base, table), table)(getattr(t, table), 0)
    return base


def q_stored_row_counts(spark, sf_dir):
    """Row counts of the stored tables from their file footers."""
    names = ("traffic_events", "critical_traffic", "congestion_index")
    return stored_row_counts(spark, _stored(spark, sf_dir, "stored_row_counts", names), names)


def q_latest_alerts_stored(spark, sf_dir):
    """The newest alerts from only the newest date folders that hold enough of them."""
    base = _stored(spark, sf_dir, "latest_alerts_stored", ("critical_traffic",))
    days = newest_days(spark, base, "critical_traffic", partition_days(spark, table_path(base, "critical_traffic"), "alert_date"), 5)
    alerts = read_days(spark, "critical_traffic", base, days)
    return ntz(latest_alerts(alerts, n=5))


def q_top_congestion_windows_stored(spark, sf_dir):
    """The worst windows from only the date folders whose maxima can reach them."""
    base = _stored(spark, sf_dir, "top_congestion_windows_stored", ("congestion_index",))
    return ntz(top_congestion_windows(top_days(spark, base, "congestion_index", "congestion_idx", 4), n=4))


def q_police_decision_colocated(spark, sf_dir):
    """The decision from hourly sums bucketed by sensor: no exchange below or between its joins."""
    base, t = scratch_path(spark, "police_decision_colocated"), EventTables(spark, sf_dir)
    prefix = "hours_" + base.rsplit("/", 1)[-1]
    store_hours(spark, {n: getattr(t, n) for n in ("traffic_events", "critical_traffic", "congestion_index")}, prefix, base, buckets=8)
    return _decision_out(colocated_decision(spark, prefix, AS_OF))


def q_first_n_alerts_stream(spark, sf_dir):
    """Each sensor's first alerts from a stream in three batches, in which a tenth of the readings comes three days late."""
    base = scratch_path(spark, "first_n_alerts_stream")
    sent = F.col("ts") + F.when(F.col("event_id") % 10 == 0, F.expr("INTERVAL 3 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS"))
    rows = ev.load_events(spark, sf_dir).withColumn("sent", F.unix_timestamp(sent.cast("timestamp")))
    cuts = [None, *rows.approxQuantile("sent", [1 / 3, 2 / 3], 0.01), None]
    for lo, hi in zip(cuts[:-1], cuts[1:]):  # one after the other: a file source takes the older files first
        part = rows if lo is None else rows.filter(F.col("sent") > lo)
        part = part if hi is None else part.filter(F.col("sent") <= hi)
        part.drop("sent").coalesce(1).write.mode("append").parquet(f"{base}/in/events.parquet")
    readings = ev.readings(ev.stream_events(spark, f"{base}/in", max_files_per_trigger=1))
    first = first_alerts_stream(critical_alerts(readings, at=F.col("event_time")), FIRST_ALERTS, FIRST_ALERTS_DELAY)
    name = "first_alerts_" + base.rsplit("/", 1)[-1]
    with rocksdb_state(spark):
        q = start(first, table_writer(f"{base}/first_alerts", "first_alerts"), name, f"{base}/checkpoint", available_now=True)
        await_all({"first_alerts": q})
    return ntz(read_sink(spark, f"{base}/first_alerts").drop("run", "batch_id"))


def q_congestion_avg_all_rollup(spark, sf_dir):
    """The all-history mean index from the rollup's sums, without reading a window."""
    means = rollup_congestion_all(_rollup(spark, sf_dir))
    return means.select("sensor_id", r6("avg_congestion").alias("avg_congestion"))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}

# The flagship: the nightly police decision.
FLAGSHIP = "police_decision"
