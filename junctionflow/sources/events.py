"""Adapter from the generic ``events`` table to sensor readings.

Mapping (fixed for comparability with the SQL oracle):
  sensor_id     <- event_type  (or user_id as text: many sensors, for scale; or
                    event_type behind the label prefix, for the chart labels)
  event_time    <- ts, cast from TIMESTAMP_NTZ to TIMESTAMP (a watermark needs TIMESTAMP)
  vehicle_count <- props.k as INT
  avg_speed     <- value
  ingested_at   <- event_time (live code uses the ingest clock)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params, schema
from .tables import is_folder

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def events_path(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/events.parquet"


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan with the declared schema (no footer sampling to infer one)."""
    return spark.read.schema(schema.EVENTS).parquet(events_path(sf_dir))


def sensor_column(sensor: str = "event_type"):
    if sensor == "user_id":
        return F.col("user_id").cast("string")
    if sensor == "junction":
        return F.concat(F.lit(params.LABEL_PREFIX), F.col("event_type"))
    return F.col(sensor)


def readings(events: DataFrame, sensor: str = "event_type") -> DataFrame:
    """Parsed-stream shape: sensor_id, event_time, vehicle_count, avg_speed, ingested_at."""
    event_time = F.col("ts").cast("timestamp")
    return events.select(
        sensor_column(sensor).alias("sensor_id"),
        event_time.alias("event_time"),
        F.get_json_object("props", "$.k").try_cast("int").alias("vehicle_count"),
        F.col("value").alias("avg_speed"),
        event_time.alias("ingested_at"),
    )


def payloads(events: DataFrame, sensor: str = "event_type") -> DataFrame:
    """Wire form: one JSON ``value`` per event plus its ``offset`` (event_id)."""
    body = F.struct(
        sensor_column(sensor).alias("sensor_id"),
        F.date_format("ts", ISO_MICROS).alias("timestamp"),
        F.get_json_object("props", "$.k").try_cast("int").alias("vehicle_count"),
        F.col("value").alias("avg_speed"),
    )
    return events.select(F.col("event_id").alias("offset"), F.to_json(body).alias("value"))


def stream_events(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The ``events`` table as a streaming source (declared schema, no inference).

    A table stored as a folder is streamed from that folder, part file by part
    file; a table stored as one file from its parent folder, by its name.
    """
    reader = spark.readStream.schema(schema.EVENTS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    path = events_path(sf_dir)
    if is_folder(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
