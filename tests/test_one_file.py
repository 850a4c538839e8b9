"""Reports as single files, byte for byte."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from junctionflow.operators import daily_peak_rows
from junctionflow.plans import deployment_report_lines, hourly_csv_rows, run_nightly, write_csv, write_report_text
from junctionflow.plans import nightly
from junctionflow.plans.catalog import AS_OF, EventTables
from junctionflow.sources import files
from junctionflow.sources.tables import read_table

from .conftest import SF_SMALL
from .test_golden import ALERTS, EXPECTED_BODY, HOURLY, _decisions, _hourly


def content(path):
    assert os.path.isfile(path)
    with open(path, newline="", encoding="utf-8") as f:
        return f.read()


def expected_csv(end="\n"):
    lines = ["sensor_id,hour,total_vehicles,avg_speed_kmh,report_date"]
    for line in sorted(HOURLY.strip().splitlines(), key=lambda x: (x.split(",")[0], int(x.split(",")[1]))):
        s, h, v, speed = line.split(",")
        lines.append(f"{s},{int(h):02d}:00,{v},{float(speed)},2026-05-10")
    return end.join(lines) + end


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_is_one_file_with_one_header(spark, tmp_dir, end):
    rows = hourly_csv_rows(_hourly(spark).repartition(5), "2026-05-10")
    path = f"{tmp_dir}/traffic_report_2026-05-10.csv"
    write_csv(rows, path, line_end=end)
    assert content(path) == expected_csv(end)
    write_csv(rows, path, line_end=end)  # a night that runs again replaces it
    assert content(path) == expected_csv(end)
    assert os.listdir(tmp_dir).count("traffic_report_2026-05-10.csv") == 1 and not [f for f in os.listdir(tmp_dir) if f.startswith("_")]


def test_report_is_one_file(spark, tmp_dir):
    path = f"{tmp_dir}/police_deployment_2026-05-10.txt"
    write_report_text(deployment_report_lines(_decisions(spark), "2026-05-10 05:02:06.630105", variant="all"), path)
    text = content(path)
    assert text.split("\n", 5)[5] == EXPECTED_BODY + "\n" and text.count("Generated") == 1 and len(ALERTS) == 4


def test_many_parts_are_joined_in_order(spark, tmp_dir):
    rows = spark.range(20_000).select(F.format_string("S%05d", 19_999 - F.col("id")).alias("sensor_id"), F.lit("00:00").alias("hour"), F.col("id").alias("total_vehicles"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        write_csv(rows.repartition(7), f"{tmp_dir}/t.csv")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = content(f"{tmp_dir}/t.csv").split("\n")
    assert lines[0] == "sensor_id,hour,total_vehicles" and lines[-1] == ""
    assert lines[1:-1] == [f"S{k:05d},00:00,{19_999 - k}" for k in range(20_000)]


def test_fields_with_quotes_commas_and_no_rows(spark, tmp_dir):
    import csv

    odd = ['a,b', 'say "x"', " spaced ", "plain"]
    rows = spark.createDataFrame([(s, "00:00", 1) for s in odd], "sensor_id string, hour string, total_vehicles int")
    write_csv(rows, f"{tmp_dir}/odd.csv")
    with open(f"{tmp_dir}/odd.csv", newline="") as f:
        assert sorted(r[0] for r in csv.reader(f)) == sorted(["sensor_id", *odd])
    write_csv(rows.limit(0), f"{tmp_dir}/none.csv")
    assert content(f"{tmp_dir}/none.csv") == "sensor_id,hour,total_vehicles\n"


def test_a_folder_of_an_earlier_version_is_replaced(spark, tmp_dir):
    rows = hourly_csv_rows(_hourly(spark), "2026-05-10")
    rows.write.csv(f"{tmp_dir}/t.csv")
    write_csv(rows, f"{tmp_dir}/t.csv")
    assert content(f"{tmp_dir}/t.csv") == expected_csv()


def test_a_store_that_joins_files_itself(spark, tmp_dir, monkeypatch):
    """Where the store takes the join, no byte is copied here; an error of the store is not hidden."""
    asked = []
    monkeypatch.setattr(files, "_concat", lambda spark, fs, made, parts: asked.append(len(parts)) or True)
    write_csv(hourly_csv_rows(_hourly(spark), "2026-05-10"), f"{tmp_dir}/t.csv")
    assert asked and content(f"{tmp_dir}/t.csv") == "sensor_id,hour,total_vehicles,avg_speed_kmh,report_date\n"


def test_night_writes_single_files(spark, tmp_dir):
    t = EventTables(spark, SF_SMALL)
    out = f"{tmp_dir}/night"
    run_nightly(t.traffic_events, t.critical_traffic, t.congestion_index, out, AS_OF, "2024-01-31")
    for name, head in (("traffic_report_2024-01-31.csv", "sensor_id,hour,"), ("police_plan_2024-01-31.csv", "sensor_id,"), ("police_deployment_2024-01-31.txt", "====")):
        assert content(f"{out}/{name}").startswith(head)
    assert len(content(f"{out}/peak_summary_2024-01-31.txt").splitlines()) == 5


def test_two_nights_at_once_leave_each_junction_once(spark, tmp_dir, monkeypatch):
    """Both read the history before either wrote: the second replaces the day instead of adding to it."""
    t = EventTables(spark, SF_SMALL)
    out = f"{tmp_dir}/night"
    empty = read_table(spark, "daily_peak_report", out)

    def night():
        run_nightly(t.traffic_events, t.critical_traffic, t.congestion_index, out, AS_OF, "2024-01-31", history=empty, history_mode="idempotent")

    night()
    held = nightly.read_days
    monkeypatch.setattr(nightly, "read_days", lambda spark, name, *a: empty if name == "daily_peak_report" else held(spark, name, *a))
    night()
    got = read_table(spark, "daily_peak_report", out)
    assert got.count() == got.select("sensor_id").distinct().count() == 5
    assert daily_peak_rows(t.decisions("rule"), "2024-01-31").count() == 5
