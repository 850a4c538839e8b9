"""The speed layer: one decoded stream feeding the raw, alert, window and quarantine tables.

All transforms are the batch operators; only the sink and trigger differ. By
default the stateless tables share one query (one read and one decode of each
message per micro-batch) and the stateful window table has its own; the
original's layout of one query per table is ``fan_out=False``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import params
from ..operators import alert_lines, congestion_windows, critical_alerts, raw_events, window_lines
from ..sources.parse import decode, parse, split
from ..sources.tables import table_path
from .sinks import fan_out_writer, start, table_writer


# Formatted lines that a stream can write next to these tables.
LINES = {"critical_traffic": alert_lines, "congestion_index": window_lines}


@dataclass
class Triggers:
    raw: str = params.TRIGGER_RAW
    alerts: str = params.TRIGGER_ALERTS
    windows: str = params.TRIGGER_WINDOWS


def shorter(spark: SparkSession, a: str, b: str) -> str:
    """The shorter of two trigger intervals, in Spark's own interval syntax."""
    row = spark.range(1).selectExpr(f"INTERVAL '{a}' <= INTERVAL '{b}' AS first").first()
    return a if row["first"] else b


def speed_layer_frames(
    readings: DataFrame,
    max_speed: float = params.CRITICAL_SPEED,
    window: str = params.WINDOW_SIZE,
    watermark: str = params.WATERMARK,
    alerted_at=None,
) -> dict[str, DataFrame]:
    """The three table frames derived from parsed readings (stream or batch)."""
    return {
        "traffic_events": raw_events(readings),
        "critical_traffic": critical_alerts(readings, max_speed=max_speed, at=alerted_at),
        "congestion_index": congestion_windows(readings, window=window, watermark=watermark),
    }


def start_tables(
    frames: dict[str, DataFrame],
    out_base: str,
    checkpoint_base: str,
    triggers: Triggers = Triggers(),
    available_now: bool = False,
    jdbc: dict | None = None,
    on_batch=None,
    name_suffix: str = "",
    with_lines: bool = False,
) -> dict[str, StreamingQuery]:
    """Start one query per table frame; each has its own checkpoint folder.

    Query names must be unique among active queries of a session; pass
    ``name_suffix`` when several pipelines run side by side.
    """
    trig = {"traffic_events": triggers.raw, "critical_traffic": triggers.alerts, "congestion_index": triggers.windows}
    queries = {}
    for table, df in frames.items():
        fn = table_writer(
            table_path(out_base, table),
            table,
            jdbc=dict(jdbc, table=table) if jdbc else None,
            on_batch=on_batch,
            lines=LINES.get(table) if with_lines else None,
        )
        queries[table] = start(
            df,
            fn,
            name=table + name_suffix,
            checkpoint=f"{checkpoint_base.rstrip('/')}/{table}",
            trigger=trig.get(table),
            available_now=available_now,
        )
    return queries


def stateless_outputs(
    out_base: str,
    max_speed: float = params.CRITICAL_SPEED,
    quarantine: bool = True,
    jdbc: dict | None = None,
    on_batch=None,
    with_lines: bool = False,
) -> dict:
    """Raw, alert (and quarantine) rows of one decoded micro-batch, with their writers.

    Processing-time columns all take the batch's ``ingested_at`` (the micro-batch
    timestamp, kept in the offset log), so a replayed batch rewrites the same values.
    """

    def writer(table: str, use_jdbc: bool = True):
        return table_writer(
            table_path(out_base, table),
            table,
            jdbc=dict(jdbc, table=table) if (jdbc and use_jdbc) else None,
            on_batch=on_batch,
            lines=LINES.get(table) if with_lines else None,
        )

    def accepted(batch: DataFrame) -> DataFrame:
        return split(batch)[0]

    outputs = {
        "traffic_events": (lambda b: raw_events(accepted(b)), writer("traffic_events")),
        "critical_traffic": (
            lambda b: critical_alerts(accepted(b), max_speed=max_speed, at=F.col("ingested_at")),
            writer("critical_traffic"),
        ),
    }
    if quarantine:
        outputs["quarantine"] = (
            lambda b: split(b)[1].withColumn("rejected_at", F.col("ingested_at")),
            writer("quarantine", use_jdbc=False),
        )
    return outputs


def run_pipeline(
    spark: SparkSession,
    payload: DataFrame,
    out_base: str,
    checkpoint_base: str,
    triggers: Triggers = Triggers(),
    available_now: bool = False,
    quarantine: bool = True,
    jdbc: dict | None = None,
    wait: bool = False,
    fan_out: bool = True,
    with_lines: bool = False,
    source_zone: str | None = None,
) -> dict[str, StreamingQuery]:
    """Decode ``payload`` (a stream with a ``value`` column) and start the queries.

    ``fan_out=True``: query ``stateless`` writes raw readings, alerts and the
    quarantine from one read of the topic (at the shorter of the raw and the alert
    trigger); query ``congestion_index`` keeps the windows. ``fan_out=False``: one
    query per table with its own trigger, as the original runs them (the topic is
    then read and decoded once per query).

    ``source_zone``: see :func:`..sources.parse.decode`.
    ``with_lines`` also writes alert and window lines as text (``<table>_lines``).
    With ``wait`` the call blocks until any query ends (and re-raises its error),
    or, for ``available_now`` runs, until all of them have drained their input.
    """
    cp = checkpoint_base.rstrip("/")
    if fan_out:
        decoded = decode(payload, source_zone=source_zone)
        queries = {
            "stateless": start(
                decoded,
                fan_out_writer(stateless_outputs(out_base, quarantine=quarantine, jdbc=jdbc, with_lines=with_lines)),
                name="stateless",
                checkpoint=f"{cp}/stateless",
                trigger=shorter(spark, triggers.raw, triggers.alerts),
                available_now=available_now,
            )
        }
        windows = {"congestion_index": congestion_windows(split(decoded)[0])}
        queries.update(start_tables(windows, out_base, checkpoint_base, triggers, available_now, jdbc=jdbc, with_lines=with_lines))
    else:
        accepted, rejected = parse(payload, source_zone=source_zone)
        queries = start_tables(
            speed_layer_frames(accepted), out_base, checkpoint_base, triggers, available_now, jdbc=jdbc, with_lines=with_lines
        )
        if quarantine:
            queries["quarantine"] = start(
                rejected.withColumn("rejected_at", F.current_timestamp()),
                table_writer(table_path(out_base, "quarantine"), "quarantine"),
                name="quarantine",
                checkpoint=f"{cp}/quarantine",
                trigger=triggers.raw,
                available_now=available_now,
            )
    if wait:
        if available_now:
            await_all(queries)  # bounded run: every query drains its input, then stops
        else:
            spark.streams.awaitAnyTermination()  # live: return (or raise) when any query ends
    return queries


def await_all(queries: dict[str, StreamingQuery]) -> None:
    """Block until every query stops; raise the first failure."""
    for q in queries.values():
        q.awaitTermination()
    for q in queries.values():
        if q.exception() is not None:
            raise RuntimeError(f"query {q.name} failed: {q.exception()}")
