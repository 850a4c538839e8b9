"""The batch layer as one job: peak hours, police decision, reports, history.

The original chains three scheduler tasks that pass Python dicts between them
and runs the hourly grouping twice; here the hourly aggregate is computed once
(it is at most sensors x 24 rows) and every output is derived from it.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import uuid
from collections import defaultdict
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params
from ..operators import (
    alert_counts,
    congestion_avg,
    daily_peak_rows,
    day_rollup,
    hourly_report,
    hourly_traffic,
    night_rollup,
    peak_hour,
    peak_lines,
    police_decision,
    police_plan,
    rows_to_append,
)
from ..sources.files import write_one_file
from ..sources.jdbc import store_missing, store_once
from ..sources.tables import PARTITION_COLUMN, partition_days, path_exists, range_start_day, read_days, table_path
from .report import deployment_report_lines, hourly_csv_rows, write_csv, write_report_text

#: Tables that are rolled up by day.
ROLLED = ("traffic_events", "critical_traffic", "congestion_index")


@dataclass
class Nightly:
    hourly: DataFrame
    decisions: DataFrame
    plan: DataFrame
    summary: DataFrame
    rollup: DataFrame
    history_rows: DataFrame
    csv_rows: DataFrame
    report_lines: DataFrame


def nightly_frames(
    traffic_events: DataFrame,
    critical_traffic: DataFrame,
    congestion_index: DataFrame,
    as_of,
    report_date,
    variant: str = "rule",
    rule: params.PoliceRule = params.PoliceRule(),
    lookback: str = params.LOOKBACK,
    generated: str | _dt.datetime | None = None,
    title: str | None = None,
) -> Nightly:
    """Lazy frames of one night. ``variant="all"`` is the manual report
    (every junction flagged, congestion over all history)."""
    hourly = hourly_traffic(traffic_events, as_of, lookback)
    peaks = peak_hour(hourly)
    alerts = alert_counts(critical_traffic, as_of, lookback)
    cong = congestion_avg(congestion_index, as_of, lookback if variant == "rule" else None)
    decisions = police_decision(peaks, alerts, cong, rule=rule, variant=variant)
    kwargs = {"title": title} if title else {}
    return Nightly(
        hourly=hourly,
        decisions=decisions,
        plan=police_plan(decisions),
        summary=peak_lines(decisions, style="log" if variant == "rule" else "summary"),
        rollup=night_rollup(traffic_events, critical_traffic, congestion_index, as_of, lookback),
        history_rows=daily_peak_rows(decisions, report_date),
        csv_rows=hourly_csv_rows(hourly_report(hourly), report_date),
        report_lines=deployment_report_lines(
            decisions, generated if generated is not None else str(as_of), variant, **kwargs
        ),
    )


def _write_rollup(rollup: DataFrame, out: str) -> None:
    (
        rollup.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("report_date")
        .parquet(table_path(out, "night_rollup"))
    )


def update_rollup(spark: SparkSession, tables: str, out: str, as_of, keep: str = params.RAW_RETENTION) -> list[str]:
    """Roll up every day that ended by ``as_of`` and whose stored files are not those of its last rollup; returns the days.

    Each such day is computed from all its rows and replaced, so rows that come
    late (windows wait for their watermark), skipped nights and a drifting
    ``as_of`` are made up for by the next run. The files are listed before they
    are read: a batch stored in between makes its day differ again. Days that
    retention may have dropped keep their rollup.
    """
    known = f"{table_path(out, 'night_rollup')}_files"
    rolled = {r.day: r.files for r in spark.read.parquet(known).collect()} if path_exists(spark, known) else {}
    end = range_start_day(spark, as_of, "0 days")
    first = range_start_day(spark, max([end, *rolled]), keep)
    found: dict[str, list[str]] = defaultdict(list)
    for name in ROLLED:
        part = PARTITION_COLUMN[name]
        days = [d for d in partition_days(spark, table_path(tables, name), part) if first <= d < end]
        for f in read_days(spark, name, tables, days).inputFiles():
            found[f.rpartition(f"/{part}=")[2].partition("/")[0]].append(f"{name}/{f.rpartition(f'/{part}=')[2]}")
    files = {d: hashlib.sha256("\n".join(sorted(f)).encode()).hexdigest() for d, f in found.items()}
    days = sorted(d for d in files if rolled.get(d) != files[d])
    if days:
        _write_rollup(day_rollup(*(read_days(spark, name, tables, days) for name in ROLLED)), out)
        spark.createDataFrame(sorted((rolled | files).items()), "day string, files string").coalesce(1).write.mode("overwrite").parquet(known)
    return days


def run_nightly(
    traffic_events: DataFrame,
    critical_traffic: DataFrame,
    congestion_index: DataFrame,
    out: str,
    as_of,
    report_date,
    history: DataFrame | None = None,
    history_mode: str = "append",
    variant: str = "rule",
    jdbc: dict | None = None,
    tables: str | None = None,
    **kwargs,
) -> Nightly | None:
    """Write the CSV, the text report, the police list, the peak listing, the rollup and the history rows under ``out``.

    The police list (``police_plan_<day>.csv``: sensor, peak hour, vehicles, time
    to deploy by) and the peak listing (``peak_summary_<day>.txt``) are what the
    original hands to its next task and prints. With ``tables``, the folder of
    the stream tables, the rollup takes every closed day with new files
    (:func:`update_rollup`). Without it, it takes the closed days since the one
    of ``as_of - lookback`` from the frames; over ``jdbc``, where no files tell
    which days have new rows, all closed days that retention keeps. A day that
    is rolled up again replaces itself.

    Returns None (and writes nothing but the rollup of ``tables``) when no
    junction had traffic, as the original skips report and save on an empty result.
    """
    if tables is not None:
        update_rollup(traffic_events.sparkSession, tables, out, as_of)
    n = nightly_frames(traffic_events, critical_traffic, congestion_index, as_of, report_date, variant, **kwargs)
    # Both are small (sensors x 24 and sensors rows) and read by several outputs
    # below; keep them once instead of re-scanning the night for each output.
    # A lost cached block is recomputed from lineage.
    n.hourly.persist(StorageLevel.MEMORY_AND_DISK)
    n.decisions.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if n.decisions.isEmpty():
            return None
        day = str(report_date)
        write_csv(n.csv_rows, f"{out}/traffic_report_{day}.csv")
        write_report_text(n.report_lines, f"{out}/police_deployment_{day}.txt")
        write_csv(n.plan, f"{out}/police_plan_{day}.csv", ["sensor_id"])
        write_one_file(n.summary, [F.col("peak_vehicles").desc(), "sensor_id"], f"{out}/peak_summary_{day}.txt")
        if jdbc is not None:
            _write_rollup(night_rollup(traffic_events, critical_traffic, congestion_index, as_of, params.RAW_RETENTION), out)
        elif tables is None:
            _write_rollup(n.rollup, out)
        rows = n.history_rows
        if history is not None:
            rows = rows_to_append(rows, history, history_mode, report_date)
        rows = rows.withColumn("created_at", F.current_timestamp())
        if jdbc is not None:
            if history_mode == "idempotent":
                store_missing(rows, jdbc["url"], "daily_peak_report", ["report_date", "sensor_id"], jdbc.get("props"))
            else:  # each attempt adds its rows, whole or not at all
                store_once(rows, jdbc["url"], "daily_peak_report", f"night-{uuid.uuid4().hex}", 0, jdbc.get("props"))
        elif history is not None and history_mode == "idempotent":
            # The day's folder is replaced by what it holds and the new rows: two nights that run at once leave one of both, not both.
            held = read_days(rows.sparkSession, "daily_peak_report", out, [day]).select(*rows.columns)
            whole = held.unionByName(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            whole.partitionBy("report_date").parquet(f"{out}/daily_peak_report")
        else:
            rows.write.mode("append").partitionBy("report_date").parquet(f"{out}/daily_peak_report")
        return n
    finally:
        n.decisions.unpersist()
        n.hourly.unpersist()
