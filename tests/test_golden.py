"""Golden night: published hourly rows in, published deployment report out.

The hourly rows (speed already rounded to 1 decimal) and the per-junction
alert counts are fixed values of one sample night; the manual report variant
(`all`) must reproduce the report body line for line.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from junctionflow.operators import peak_hour, police_decision
from junctionflow.plans import ordered_lines
from junctionflow.plans.report import deployment_report_lines, hourly_csv_rows

# --- fixed values: sample night (sensor_id, hour, total_vehicles, avg_speed) ---
HOURLY = """
Junction_Kollupitiya,0,43458,39.3
Junction_Kollupitiya,1,38526,39.8
Junction_Kollupitiya,9,79658,40.0
Junction_Kollupitiya,16,37986,39.6
Junction_Kollupitiya,17,134072,40.2
Junction_Kollupitiya,18,123786,39.8
Junction_Kollupitiya,19,134240,40.0
Junction_Kollupitiya,20,17002,39.8
Junction_Maharagama,0,64161,29.5
Junction_Maharagama,1,58411,29.9
Junction_Maharagama,9,124065,29.9
Junction_Maharagama,16,58573,30.0
Junction_Maharagama,17,204938,29.8
Junction_Maharagama,18,189605,29.9
Junction_Maharagama,19,205377,29.8
Junction_Maharagama,20,25816,30.5
Junction_Nugegoda,0,56457,29.6
Junction_Nugegoda,1,51971,29.9
Junction_Nugegoda,9,108078,30.4
Junction_Nugegoda,16,51945,30.8
Junction_Nugegoda,17,183168,29.7
Junction_Nugegoda,18,169045,30.1
Junction_Nugegoda,19,181933,29.6
Junction_Nugegoda,20,23339,29.7
Junction_Pettah,0,49330,34.7
Junction_Pettah,1,43459,35.1
Junction_Pettah,9,94356,35.2
Junction_Pettah,16,44774,35.0
Junction_Pettah,17,157701,35.1
Junction_Pettah,18,147508,35.1
Junction_Pettah,19,159680,34.9
Junction_Pettah,20,21075,35.3
"""
ALERTS = {"Junction_Maharagama": 9, "Junction_Nugegoda": 9, "Junction_Pettah": 11, "Junction_Kollupitiya": 9}
EXPECTED_BODY = """PEAK TRAFFIC SUMMARY
------------------------------------------------------------
Junction  : Junction_Maharagama
Peak Hour : 19:00 - 20:00
Vehicles  : 205,377
Avg Speed : 29.8 km/h
Alerts    : 9 critical alerts
Status    : POLICE DEPLOYMENT RECOMMENDED
------------------------------------------------------------
Junction  : Junction_Nugegoda
Peak Hour : 17:00 - 18:00
Vehicles  : 183,168
Avg Speed : 29.7 km/h
Alerts    : 9 critical alerts
Status    : POLICE DEPLOYMENT RECOMMENDED
------------------------------------------------------------
Junction  : Junction_Pettah
Peak Hour : 19:00 - 20:00
Vehicles  : 159,680
Avg Speed : 34.9 km/h
Alerts    : 11 critical alerts
Status    : POLICE DEPLOYMENT RECOMMENDED
------------------------------------------------------------
Junction  : Junction_Kollupitiya
Peak Hour : 19:00 - 20:00
Vehicles  : 134,240
Avg Speed : 40.0 km/h
Alerts    : 9 critical alerts
Status    : POLICE DEPLOYMENT RECOMMENDED
------------------------------------------------------------

POLICE DEPLOYMENT PLAN FOR TOMORROW
============================================================
  -> Deploy to Junction_Maharagama by 19:00
  -> Deploy to Junction_Nugegoda by 17:00
  -> Deploy to Junction_Pettah by 19:00
  -> Deploy to Junction_Kollupitiya by 19:00

============================================================"""
# ---------------------------------------------------------------------------


def _hourly(spark):
    rows = []
    for line in HOURLY.strip().splitlines():
        s, h, v, sp = line.split(",")
        rows.append((s, int(h), int(v), float(sp), 0))
    return spark.createDataFrame(rows, "sensor_id string, hour int, total_vehicles bigint, avg_speed double, reading_count bigint")


def _decisions(spark):
    alerts = spark.createDataFrame(list(ALERTS.items()), "sensor_id string, alert_count bigint")
    cong = spark.createDataFrame([], "sensor_id string, avg_congestion double")
    return police_decision(peak_hour(_hourly(spark)), alerts, cong, variant="all")


def test_golden_report_body(spark):
    lines = deployment_report_lines(_decisions(spark), "2026-05-10 05:02:06.630105", variant="all")
    got = [r.line for r in ordered_lines(lines).collect()]
    assert got[2] == "  Generated: 2026-05-10 05:02:06.630105"
    assert got[5:] == EXPECTED_BODY.split("\n")


def test_golden_csv_rows(spark):
    csv = hourly_csv_rows(_hourly(spark), "2026-05-10").orderBy("sensor_id", "hour")
    got = [",".join(str(x) for x in r) for r in csv.collect()]
    assert got[0] == "Junction_Kollupitiya,00:00,43458,39.3,2026-05-10"
    assert got[15] == "Junction_Maharagama,20:00,25816,30.5,2026-05-10"
    assert len(got) == 32


def test_rule_variant_layout(spark):
    d = _decisions(spark).withColumn("needs_police", F.col("sensor_id") != "Junction_Pettah")
    got = [r.line for r in ordered_lines(deployment_report_lines(d, "x", variant="rule")).collect()]
    plan = [x for x in got if "Deploy to" in x]
    # rule variant: arrow, sensor order, only flagged junctions
    assert plan == [
        "  → Deploy to Junction_Kollupitiya by 19:00",
        "  → Deploy to Junction_Maharagama by 19:00",
        "  → Deploy to Junction_Nugegoda by 17:00",
    ]
    assert "Vehicles  : 205377" in got
    assert "Status    : No intervention needed" in got
