"""Command line: ``python -m junctionflow.cli {stream,nightly,charts,housekeeping} ...``.

One process per job; the schedule (e.g. nightly at 00:00 with one retry) belongs
to whatever scheduler runs the command.
"""

from __future__ import annotations

import argparse

from . import params
from .session import cluster_conf, get_spark
from .functions import now_text
from .sources import jdbc_table, kafka_source, read_range, read_table, text_source
from .streaming import Triggers, run_pipeline

TABLES = ("traffic_events", "critical_traffic", "congestion_index")


def _spark(args):
    conf = (
        cluster_conf(
            args.executors,
            args.cores,
            state_partitions=args.state_partitions,
            batch_partitions=args.batch_partitions,
        )
        if args.executors
        else None
    )
    return get_spark(master=args.master, conf=conf)


def _jdbc(args) -> dict | None:
    return {"url": args.jdbc_url, "props": dict(p.split("=", 1) for p in args.jdbc_prop)} if args.jdbc_url else None


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="junctionflow")
    p.add_argument("--master")
    p.add_argument("--executors", type=int, default=0, help="size settings for this many executors")
    p.add_argument("--cores", type=int, default=8, help="cores per executor")
    p.add_argument("--state-partitions", type=int, help="shuffle width of the window state (fixed at its first checkpoint)")
    p.add_argument("--batch-partitions", type=int, help="initial batch shuffle width before AQE coalesces")
    sub = p.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("stream", help="speed layer: topic (or JSON folder) -> three tables")
    s.add_argument("--servers")
    s.add_argument("--topic", default="traffic-raw")
    s.add_argument("--json-dir", help="read JSON-lines files instead of Kafka")
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--available-now", action="store_true")
    s.add_argument(
        "--max-offsets-per-trigger",
        type=int,
        help="cap one micro-batch (e.g. the backlog after a restart) at this many topic messages (Kafka only)",
    )
    s.add_argument("--source-zone", help="time zone of sensor times without an offset (default: the session's)")
    s.add_argument("--lines", action="store_true", help="also write alert and window lines as text")
    s.add_argument(
        "--separate-queries",
        action="store_true",
        help="one query per table with its own trigger (reads the topic once per query)",
    )

    n = sub.add_parser("nightly", help="peak hours, police decision, reports, history")
    n.add_argument("--tables", help="folder holding the three stream tables (not with --jdbc-url)")
    for each in (s, n):
        each.add_argument("--jdbc-url", help="keep the tables in a database instead of folders")
        each.add_argument("--jdbc-prop", action="append", default=[], metavar="KEY=VALUE", help="connection property, e.g. user=...")
    n.add_argument("--out", required=True)
    n.add_argument("--as-of", help="end of the night (default: now)")
    n.add_argument("--report-date", help="default: date of --as-of")
    n.add_argument("--variant", choices=["rule", "all"], default="rule")
    n.add_argument(
        "--history-mode",
        choices=["append", "idempotent"],
        default="idempotent",
        help="idempotent: a re-run or retried night adds no duplicate rows; append: the original's behaviour",
    )

    c = sub.add_parser("charts", help="chart-ready frames over all history")
    where = c.add_mutually_exclusive_group(required=True)
    where.add_argument("--rollup", help="the nightly's --out: fold its night_rollup, reading no readings")
    where.add_argument("--tables", help="scan the stream tables instead (history from before the first nightly)")
    c.add_argument("--out", required=True)

    h = sub.add_parser("housekeeping", help="correct the windows of closed days, drop expired date folders, merge the batch folders of closed days")
    h.add_argument("--tables", required=True)
    h.add_argument("--as-of", help="default: now")

    args = p.parse_args(argv)
    spark = _spark(args)

    if args.cmd == "stream":
        source = (
            text_source(spark, args.json_dir)
            if args.json_dir
            else kafka_source(spark, args.servers, args.topic, max_offsets_per_trigger=args.max_offsets_per_trigger)
        )
        run_pipeline(
            spark, source, args.out, args.checkpoint, Triggers(),
            available_now=args.available_now, wait=True, fan_out=not args.separate_queries, with_lines=args.lines, jdbc=_jdbc(args),
            source_zone=args.source_zone,
        )
        return 0

    if args.cmd == "nightly":
        from .plans import run_nightly

        as_of = args.as_of or now_text(spark)
        report_date = args.report_date or as_of[:10]
        # Only the date folders of the night's range are listed and read; the
        # manual variant averages congestion over all history.
        jdbc = _jdbc(args)
        if jdbc:
            t = {name: jdbc_table(spark, jdbc["url"], name, jdbc["props"]) for name in TABLES}
        else:
            t = {name: read_range(spark, name, args.tables, as_of, params.LOOKBACK) for name in TABLES}
            if args.variant == "all":
                t["congestion_index"] = read_table(spark, "congestion_index", args.tables)
        history = None
        if args.history_mode == "idempotent":
            # An absent table is the first night; any other failure to read it rises.
            if jdbc:
                history = jdbc_table(spark, jdbc["url"], "daily_peak_report", jdbc["props"])
            else:
                history = read_table(spark, "daily_peak_report", args.out)
        run_nightly(
            t["traffic_events"], t["critical_traffic"], t["congestion_index"], args.out, as_of, report_date,
            history=history, history_mode=args.history_mode, variant=args.variant,
            lookback=params.LOOKBACK, jdbc=jdbc, tables=None if jdbc else args.tables,
        )
        return 0

    if args.cmd == "housekeeping":
        from .plans.corrections import close_days
        from .plans.housekeeping import compact_closed_days, drop_expired

        as_of = args.as_of or now_text(spark)
        close_days(spark, args.tables, as_of)
        for name in TABLES:
            keep = params.RAW_RETENTION if name == "traffic_events" else params.AGGREGATE_RETENTION
            drop_expired(spark, args.tables, name, as_of, keep)
            compact_closed_days(spark, args.tables, name, as_of)
        return 0

    from .plans.charts import chart_frames, chart_frames_from_rollup, write_charts

    if args.rollup:
        frames = chart_frames_from_rollup(read_table(spark, "night_rollup", args.rollup))
    else:
        t = {name: read_table(spark, name, args.tables) for name in TABLES}
        frames = chart_frames(t["traffic_events"], t["critical_traffic"], t["congestion_index"])
    write_charts(frames, args.out)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
