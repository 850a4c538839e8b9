"""Peak hour, police decision, deployment plan and the history table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import params
from ..functions import date_literal, hour_label

VARIANTS = ("rule", "all")


def peak_hour(hourly: DataFrame) -> DataFrame:
    """Busiest hour per sensor; ties go to the lowest hour.

    ``row_number() = 1`` lets Spark insert a partial WindowGroupLimit before the
    shuffle, so each task forwards one candidate row per sensor.
    """
    w = Window.partitionBy("sensor_id").orderBy(F.col("total_vehicles").desc(), F.col("hour").asc())
    return (
        hourly.withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") == 1)
        .select(
            "sensor_id",
            F.col("hour").alias("peak_hour"),
            F.col("total_vehicles").alias("peak_vehicles"),
            "avg_speed",
            "reading_count",
        )
    )


def police_decision(
    peaks: DataFrame,
    alert_counts: DataFrame,
    congestion: DataFrame,
    rule: params.PoliceRule = params.PoliceRule(),
    variant: str = "rule",
) -> DataFrame:
    """Peaks left-joined with alert counts (default 0) and mean index (default 0.0).

    ``variant="rule"``: ``avg_congestion > index_gt OR alert_count >= alerts_ge OR
    avg_speed < speed_lt`` with the peak hour's mean speed. ``variant="all"``
    flags every junction (the manual report). Hourly traffic drives the join:
    a sensor with alerts or windows but no readings does not appear.

    All three inputs are aggregates keyed by ``sensor_id``; their shuffles are
    hash-partitioned on that key already, so the joins add no exchange, and AQE
    turns them into broadcasts when the measured sides are small.
    """
    if variant not in VARIANTS:
        raise ValueError(f"variant must be one of {VARIANTS}")
    joined = (
        peaks.join(alert_counts.select("sensor_id", "alert_count"), "sensor_id", "left")
        .join(congestion.select("sensor_id", "avg_congestion"), "sensor_id", "left")
        .withColumn("alert_count", F.coalesce(F.col("alert_count"), F.lit(0).cast("bigint")))
        .withColumn("avg_congestion", F.coalesce(F.col("avg_congestion"), F.lit(0.0)))
    )
    if variant == "all":
        flag = F.lit(True)
    else:
        flag = (
            (F.col("avg_congestion") > F.lit(float(rule.index_gt)))
            | (F.col("alert_count") >= F.lit(int(rule.alerts_ge)))
            | (F.col("avg_speed") < F.lit(float(rule.speed_lt)))
        )
    return joined.select(
        "sensor_id",
        "peak_hour",
        "peak_vehicles",
        "avg_speed",
        "alert_count",
        "avg_congestion",
        flag.alias("needs_police"),
    )


def police_plan(decisions: DataFrame) -> DataFrame:
    """Flagged junctions with the time police should be there by."""
    return decisions.filter(F.col("needs_police")).select(
        "sensor_id",
        "peak_hour",
        "peak_vehicles",
        hour_label("peak_hour").alias("deploy_by"),
    )


def daily_peak_rows(decisions: DataFrame, report_date) -> DataFrame:
    """Rows for ``daily_peak_report`` for one night."""
    return decisions.select(
        date_literal(report_date).alias("report_date"),
        "sensor_id",
        "peak_hour",
        "peak_vehicles",
        "avg_congestion",
        "needs_police",
    )


def rows_to_append(rows: DataFrame, history: DataFrame, mode: str = "append", report_date=None) -> DataFrame:
    """The rows a history insert would add.

    ``append`` adds everything (re-running a night duplicates it, as the
    original's conflict clause never fires). ``idempotent`` adds only rows whose
    (report_date, sensor_id) is not yet present. With ``report_date`` the history
    side is cut to that date first, which prunes a date-partitioned table to one
    folder before the anti-join.
    """
    if mode == "append":
        return rows
    if mode != "idempotent":
        raise ValueError("mode must be 'append' or 'idempotent'")
    keys = history.select("report_date", "sensor_id")
    if report_date is not None:
        keys = keys.filter(F.col("report_date") == date_literal(report_date))
    return rows.join(keys, ["report_date", "sensor_id"], "left_anti")


def append_history(rows: DataFrame, history: DataFrame, mode: str = "append", report_date=None) -> DataFrame:
    """History contents after the insert (history UNION ALL the added rows)."""
    added = rows_to_append(rows, history, mode, report_date)
    return history.select(*rows.columns).unionByName(added)
