"""Declared schemas. Nothing in the engine infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

# Wire form of one reading (JSON). avg_speed is parsed as DOUBLE rather than
# FLOAT so 34.2 stays 34.2 instead of widening to 34.20000076293945.
READING = T.StructType(
    [
        T.StructField("sensor_id", T.StringType(), True),
        T.StructField("timestamp", T.StringType(), True),
        T.StructField("vehicle_count", T.IntegerType(), True),
        T.StructField("avg_speed", T.DoubleType(), True),
    ]
)

# Rejected messages: what could be decoded, and why they were rejected.
QUARANTINE = T.StructType(
    [
        *READING.fields,
        T.StructField("event_time", T.TimestampType(), True),
        T.StructField("ingested_at", T.TimestampType(), True),
        T.StructField("reason", T.StringType(), True),
        T.StructField("rejected_at", T.TimestampType(), True),
    ]
)

TRAFFIC_EVENTS = T.StructType(
    [
        T.StructField("sensor_id", T.StringType(), False),
        T.StructField("event_timestamp", T.TimestampType(), False),
        T.StructField("vehicle_count", T.IntegerType(), False),
        T.StructField("avg_speed", T.DoubleType(), False),
        T.StructField("ingested_at", T.TimestampType(), True),
    ]
)

CRITICAL_TRAFFIC = T.StructType(
    [
        T.StructField("sensor_id", T.StringType(), False),
        T.StructField("event_timestamp", T.TimestampType(), False),
        T.StructField("vehicle_count", T.IntegerType(), False),
        T.StructField("avg_speed", T.DoubleType(), False),
        T.StructField("alert_message", T.StringType(), True),
        T.StructField("alerted_at", T.TimestampType(), True),
    ]
)

CONGESTION_INDEX = T.StructType(
    [
        T.StructField("sensor_id", T.StringType(), False),
        T.StructField("window_start", T.TimestampType(), False),
        T.StructField("window_end", T.TimestampType(), False),
        T.StructField("total_vehicles", T.LongType(), False),
        T.StructField("avg_speed", T.DoubleType(), True),
        T.StructField("congestion_idx", T.DoubleType(), True),
    ]
)

DAILY_PEAK_REPORT = T.StructType(
    [
        T.StructField("report_date", T.DateType(), False),
        T.StructField("sensor_id", T.StringType(), False),
        T.StructField("peak_hour", T.IntegerType(), False),
        T.StructField("peak_vehicles", T.LongType(), False),
        T.StructField("avg_congestion", T.DoubleType(), False),
        T.StructField("needs_police", T.BooleanType(), True),
    ]
)

# Set when a row is stored (tables without an ingest or alert time of their own).
CREATED_AT = T.StructField("created_at", T.TimestampType(), True)

# What the history charts fold: one row a (night, sensor, hour).
NIGHT_ROLLUP = T.StructType(
    [
        T.StructField("report_date", T.DateType(), False),
        T.StructField("sensor_id", T.StringType(), True),
        T.StructField("hour", T.IntegerType(), True),
        T.StructField("vehicles", T.LongType(), True),
        T.StructField("speed_sum", T.DoubleType(), True),
        T.StructField("readings", T.LongType(), True),
        T.StructField("alerts", T.LongType(), True),
        T.StructField("idx_sum", T.DoubleType(), True),
        T.StructField("idx_windows", T.LongType(), True),
    ]
)

SENSOR_PROFILE = T.StructType(
    [
        T.StructField("sensor_id", T.StringType(), False),
        T.StructField("speed_lo", T.IntegerType(), False),
        T.StructField("speed_hi", T.IntegerType(), False),
        T.StructField("count_lo", T.IntegerType(), False),
        T.StructField("count_hi", T.IntegerType(), False),
    ]
)

# Driver-generated `events` table (the test input the adapter maps onto readings).
EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType(), True),
        T.StructField("ts", T.TimestampNTZType(), True),
        T.StructField("user_id", T.LongType(), True),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("value", T.DoubleType(), True),
        T.StructField("props", T.StringType(), True),
    ]
)
