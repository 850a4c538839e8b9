"""Structured Streaming: sinks, query start-up and the speed-layer pipeline."""

from .pipeline import Triggers, await_all, run_pipeline, speed_layer_frames, start_tables, stateless_outputs
from .sinks import (
    expired_partitions,
    fan_out_writer,
    late_rows_dropped,
    read_sink,
    read_state,
    start,
    state_writer,
    table_writer,
    with_partition_date,
)

__all__ = [
    "Triggers",
    "await_all",
    "expired_partitions",
    "fan_out_writer",
    "late_rows_dropped",
    "read_sink",
    "read_state",
    "run_pipeline",
    "speed_layer_frames",
    "start",
    "start_tables",
    "state_writer",
    "stateless_outputs",
    "table_writer",
    "with_partition_date",
]
