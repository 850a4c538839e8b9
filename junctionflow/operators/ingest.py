"""Stateless per-reading operators shared by the stream and its batch twin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params
from ..functions import ts_literal


def raw_events(readings: DataFrame) -> DataFrame:
    """Rows for ``traffic_events``: every parsed reading, ``event_time`` renamed."""
    return readings.select(
        "sensor_id",
        F.col("event_time").alias("event_timestamp"),
        "vehicle_count",
        "avg_speed",
        "ingested_at",
    )


def alert_message(max_speed: float) -> str:
    if max_speed == params.CRITICAL_SPEED:
        return params.ALERT_MESSAGE
    return f"CRITICAL: avg_speed below {max_speed:g} km/h"


def critical_filter(max_speed: float = params.CRITICAL_SPEED) -> Column:
    """Strict ``avg_speed < max_speed``; a NULL speed is no alert."""
    return F.col("avg_speed") < F.lit(float(max_speed))


def critical_alerts(
    readings: DataFrame,
    max_speed: float = params.CRITICAL_SPEED,
    at: Column | str | None = None,
) -> DataFrame:
    """Rows for ``critical_traffic``.

    ``at`` sets ``alerted_at``: None = processing time (live), a Column (e.g.
    ``F.col('event_time')``) or a timestamp literal for repeatable runs.
    """
    alerted_at = at if isinstance(at, Column) else ts_literal(at)
    return readings.filter(critical_filter(max_speed)).select(
        "sensor_id",
        F.col("event_time").alias("event_timestamp"),
        "vehicle_count",
        "avg_speed",
        F.lit(alert_message(max_speed)).alias("alert_message"),
        alerted_at.alias("alerted_at"),
    )


#: What makes two readings one: a sensor that sends again, or a topic that delivers twice.
SAME_READING = ("sensor_id", "event_time", "vehicle_count", "avg_speed")


def distinct_readings(readings: DataFrame, watermark: str = params.WATERMARK) -> DataFrame:
    """Readings without repeats that come within ``watermark`` of event time of the first one.

    On a stream the state holds one key a reading for as long as the watermark
    needs to pass it by ``watermark``, whatever the stream's length. A repeat
    after that time counts as new; a batch frame drops all repeats.
    """
    if not readings.isStreaming:
        return readings.dropDuplicates(list(SAME_READING))
    return readings.withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(list(SAME_READING))
