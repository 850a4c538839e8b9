"""Sources: topic/file streams, stored tables, the payload decoder and the events adapter."""

from .events import load_events, payloads, readings, stream_events
from .jdbc import store_missing, store_once
from .parse import decode, parse, split
from .streams import kafka_source, peek, text_source
from .tables import jdbc_table, partition_days, range_start_day, read_range, read_table, table_path, write_jdbc

__all__ = [
    "decode",
    "jdbc_table",
    "kafka_source",
    "load_events",
    "parse",
    "payloads",
    "peek",
    "read_table",
    "partition_days",
    "range_start_day",
    "read_range",
    "readings",
    "split",
    "store_missing",
    "store_once",
    "stream_events",
    "table_path",
    "text_source",
    "write_jdbc",
]
