"""Decode reading payloads (the JSON ``value`` of a topic message).

``parse`` works the same on a streaming and a batch frame. Under Spark 4 ANSI
mode a bad timestamp would raise in ``to_timestamp``; ``try_to_timestamp``
turns it into NULL instead, and ``from_json`` stays permissive (junk -> all
NULL, wrong-typed field -> NULL field). Rows without a sensor are dropped as in
the original; rows with a sensor but a missing time, count or speed go to a
quarantine frame instead of failing the table load later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema

REQUIRED = ("event_time", "vehicle_count", "avg_speed")


def decode(
    payload: DataFrame, value_col: str = "value", ingested_at: Column | None = None, source_zone: str | None = None
) -> DataFrame:
    """``value`` (binary or string) -> reading columns + ``event_time`` + ``ingested_at``.

    The parsed struct is emitted through ``inline(array(...))``. A plain
    ``select(from_json(...).alias("d")).select("d.*")`` lets the optimizer push
    every later filter below the parse and prune ``from_json`` per field, so each
    message would be parsed once per referenced field (five times here). A
    generator is a boundary filters are not pushed through: one parse per message.

    A time text without an offset is read in the session time zone, or in
    ``source_zone`` where the sensors' clocks run in another one; a text with an
    offset names its instant itself.
    """
    when = F.try_to_timestamp(F.col("timestamp"))
    if source_zone is not None:
        naive = F.expr("try_cast(timestamp AS timestamp_ntz)")
        shifted = F.convert_timezone(F.lit(source_zone), F.current_timezone(), naive).cast("timestamp")
        has_offset = F.col("timestamp").rlike(r"(Z|[+-]\d{2}(:?\d{2})?|\[[^\]]+\])\s*$") & F.col("timestamp").rlike(r"[T ]\d{2}:")
        when = F.when(has_offset, when).otherwise(shifted)
    d = F.from_json(F.col(value_col).cast("string"), schema.READING)
    return (
        payload.select(F.inline(F.array(d)))
        .withColumn("event_time", when)
        .withColumn("ingested_at", ingested_at if ingested_at is not None else F.current_timestamp())
        .filter(F.col("sensor_id").isNotNull())
    )


def _complete() -> Column:
    ok = F.lit(True)
    for c in REQUIRED:
        ok = ok & F.col(c).isNotNull()
    return ok


def quarantine_reason() -> Column:
    """First missing required field, as text."""
    return (
        F.when(F.col("event_time").isNull(), F.lit("bad or missing timestamp"))
        .when(F.col("vehicle_count").isNull(), F.lit("bad or missing vehicle_count"))
        .when(F.col("avg_speed").isNull(), F.lit("bad or missing avg_speed"))
    )


def split(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(accepted, quarantined)`` rows of an already decoded frame."""
    accepted = decoded.filter(_complete())
    quarantined = decoded.filter(~_complete()).withColumn("reason", quarantine_reason())
    return accepted, quarantined


def parse(
    payload: DataFrame, value_col: str = "value", ingested_at: Column | None = None, source_zone: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Return ``(accepted, quarantined)``; both keep the decoded columns."""
    return split(decode(payload, value_col, ingested_at, source_zone))
