"""Nightly report outputs: hourly CSV rows and the deployment text report.

The text report is a DataFrame of lines carrying sort keys
``(section, sort_key, sensor_id, line_no)``; writing it sorts on those keys (a
distributed range sort), so no step numbers lines globally in one task and no
line passes through the driver.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, hour_label, thousands
from ..sources.files import write_one_file

# --- fixed values: report layout ------------------------------------------
RULE_WIDTH = 60
SUMMARY_HEADING = "PEAK TRAFFIC SUMMARY"
PLAN_HEADING = "POLICE DEPLOYMENT PLAN FOR TOMORROW"
STATUS_YES = "POLICE DEPLOYMENT RECOMMENDED"
STATUS_NO = "No intervention needed"
NO_PLAN = "No police deployment needed tomorrow"
ARROW = {"rule": "→", "all": "->"}
JUNCTION_LABEL = "Junction  : "
PEAK_LINE = "Peak Hour : %02d:00 - %02d:00"
VEHICLES_LABEL = "Vehicles  : "
SPEED_LABEL = "Avg Speed : "
SPEED_UNIT = " km/h"
ALERTS_LINE = "Alerts    : %d critical alerts"
STATUS_LABEL = "Status    : "
DEPLOY_LINE = "  {arrow} Deploy to %s by %02d:00"
GENERATED_LABEL = "  Generated: "
CSV_HEADER = ["sensor_id", "hour", "total_vehicles", "avg_speed_kmh", "report_date"]
# ---------------------------------------------------------------------------
DEFAULT_TITLE = "NIGHTLY TRAFFIC REPORT"

REPORT_KEYS = ["section", "sort_key", "sensor_id", "line_no"]

SECTION_HEADER, SECTION_BLOCKS, SECTION_PLAN_HEAD, SECTION_PLAN, SECTION_FALLBACK, SECTION_FOOTER = range(6)


def hourly_csv_rows(hourly_report: DataFrame, report_date) -> DataFrame:
    """CSV rows: sensor_id, 'HH:00', total_vehicles, avg_speed_kmh (1 decimal), report_date text."""
    return hourly_report.select(
        "sensor_id",
        hour_label("hour").alias("hour"),
        "total_vehicles",
        F.col("avg_speed").alias("avg_speed_kmh"),
        F.lit(str(report_date)).alias("report_date"),
    )


def csv_line(columns: list[str]) -> Column:
    """The columns as one CSV line; a quote inside a field is doubled."""
    return F.to_csv(F.struct(*columns), {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})


def write_csv(rows: DataFrame, path: str, keys: list[str | Column] | None = None, line_end: str = "\n") -> None:
    """One CSV file with one header, sorted by ``keys`` (default: sensor_id, hour)."""
    keys = keys or ["sensor_id", "hour"]
    columns = rows.columns
    head = ",".join(columns) + line_end
    write_one_file(rows.withColumn("line", csv_line(columns)), keys, path, head, line_end)


def _fixed_lines(decisions: DataFrame, section: int, lines: list[str]) -> DataFrame:
    spark = decisions.sparkSession
    arr = F.array(*[F.lit(s) for s in lines])
    return spark.range(1).select(
        F.lit(section).alias("section"),
        F.lit(0).cast("bigint").alias("sort_key"),
        F.lit("").alias("sensor_id"),
        F.posexplode(arr).alias("line_no", "line"),
    )


def _line(section: int, sort_key: Column, line_no: int, text: Column) -> Column:
    return F.struct(
        F.lit(section).alias("section"),
        sort_key.cast("bigint").alias("sort_key"),
        F.lit(line_no).alias("line_no"),
        text.alias("line"),
    )


def _sensor_lines(decisions: DataFrame, variant: str) -> DataFrame:
    """Each junction's summary block and (if flagged) its plan line, in one pass over the decisions."""
    vehicles: Column = thousands("peak_vehicles") if variant == "all" else F.col("peak_vehicles").cast("string")
    by_vehicles = -F.col("peak_vehicles")
    texts = [
        F.concat(F.lit(JUNCTION_LABEL), F.col("sensor_id")),
        F.format_string(PEAK_LINE, F.col("peak_hour"), F.col("peak_hour") + 1),
        F.concat(F.lit(VEHICLES_LABEL), vehicles),
        F.concat(F.lit(SPEED_LABEL), fixed("avg_speed", 1), F.lit(SPEED_UNIT)),
        F.format_string(ALERTS_LINE, F.col("alert_count")),
        F.concat(
            F.lit(STATUS_LABEL),
            F.when(F.col("needs_police"), F.lit(STATUS_YES)).otherwise(F.lit(STATUS_NO)),
        ),
        F.lit("-" * RULE_WIDTH),
    ]
    block = [_line(SECTION_BLOCKS, by_vehicles, i, t) for i, t in enumerate(texts)]
    # The rule variant lists flagged junctions in sensor order, the manual one by vehicles descending.
    plan_key = by_vehicles if variant == "all" else F.lit(0)
    plan_text = F.format_string(DEPLOY_LINE.format(arrow=ARROW[variant]), F.col("sensor_id"), F.col("peak_hour"))
    plan = F.when(F.col("needs_police"), _line(SECTION_PLAN, plan_key, 0, plan_text))
    lines = F.array_compact(F.array(*block, plan))  # the plan entry is NULL (dropped) when not flagged
    return decisions.select("sensor_id", F.inline(lines)).select(*REPORT_KEYS, "line")


def _fallback(decisions: DataFrame, variant: str) -> DataFrame:
    """One line when junctions were analysed but none is flagged (a single global count, no collect)."""
    return (
        decisions.agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("needs_police")).alias("flagged"),
        )
        .filter((F.col("n") > 0) & (F.col("flagged") == 0))
        .select(
            F.lit(SECTION_FALLBACK).alias("section"),
            F.lit(0).cast("bigint").alias("sort_key"),
            F.lit("").alias("sensor_id"),
            F.lit(0).alias("line_no"),
            F.lit(f"  {ARROW[variant]} {NO_PLAN}").alias("line"),
        )
    )


def deployment_report_lines(
    decisions: DataFrame,
    generated: str | _dt.datetime,
    variant: str = "rule",
    title: str = DEFAULT_TITLE,
) -> DataFrame:
    """Lines of the police deployment report with their sort keys.

    ``rule``: computed flag, plain vehicle numbers, ``→``, plan in sensor order,
    fallback line when nobody is flagged. ``all``: the manual report (thousands
    separators, ``->``, plan by vehicles descending).
    """
    if isinstance(generated, _dt.datetime):
        generated = generated.strftime("%Y-%m-%d %H:%M:%S")
    header = ["=" * RULE_WIDTH, f"  {title}", f"{GENERATED_LABEL}{generated}", "=" * RULE_WIDTH, "", SUMMARY_HEADING, "-" * RULE_WIDTH]
    parts = [
        _fixed_lines(decisions, SECTION_HEADER, header),
        _sensor_lines(decisions, variant),
        _fixed_lines(decisions, SECTION_PLAN_HEAD, ["", PLAN_HEADING, "=" * RULE_WIDTH]),
        _fixed_lines(decisions, SECTION_FOOTER, ["", "=" * RULE_WIDTH]),
    ]
    if variant == "rule":
        parts.append(_fallback(decisions, variant))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*REPORT_KEYS, "line")


def ordered_lines(lines: DataFrame) -> DataFrame:
    return lines.orderBy(*REPORT_KEYS)


def write_report_text(lines: DataFrame, path: str) -> None:
    """Report lines in report order, as one text file."""
    write_one_file(lines, REPORT_KEYS, path)
