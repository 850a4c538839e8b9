"""Plan shape of every registered batch query, and shuffle volume under a hot sensor.

These lock in the properties the design relies on at scale:

* nothing in a plan runs Python per row, and no join is a cartesian or nested loop;
* every shuffle carries pre-aggregated rows (a partial aggregate, a partial
  ``WindowGroupLimit`` or an already grouped frame), never raw readings;
* nothing broadcast is a raw table scan (only aggregates or the profile);
* scans read only the needed columns and the trailing-range filter reaches the scan;
* with one sensor holding half of all rows, the rows a shuffle writes are bounded by
  (map tasks x groups), not by the hot sensor's row count.
"""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from junctionflow.plans.catalog import QUERIES
from junctionflow.operators import alert_counts, critical_alerts, first_n_alerts, hourly_traffic, raw_events
from junctionflow.sources import events as ev

from .conftest import SF_ORACLE

BATCH = sorted(n for n in QUERIES if not n.endswith("_stream"))
# Shuffled raw rows are this join's point (the profile is of any size); AQE splits its hot partition, see below.
RAW_JOIN = {"sensor_profile_check"}
# These read back tables that they wrote themselves: one row a sensor and night.
# Read back tables that they made themselves (the last one returns every column of it).
OWN_TABLES = {"daily_peak_idempotent", "nightly_from_tables", "congestion_corrected"}
# Columns that come from folder names, not from files.
FOLDERS = {"run", "batch_id", "event_date", "alert_date", "window_date", "report_date"}

# Nodes that only reshape rows between an exchange and the operator that feeds it.
PASS_THROUGH = {"Sort", "Project", "Filter", "InputAdapter", "ColumnarToRow"}
AGGREGATES = {"HashAggregate", "ObjectHashAggregate", "SortAggregate"}
FORBIDDEN = {
    "BatchEvalPython",
    "ArrowEvalPython",
    "FlatMapGroupsInPandas",
    "MapInPandas",
    "PythonMapInArrow",
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
}
# Queries whose nightly range must be pushed into the parquet scan.
RANGE_PUSHED = [
    "alert_counts_24h",
    "congestion_avg_24h",
    "hourly_traffic_24h",
    "hourly_report_24h",
    "hourly_csv_rows",
    "peak_hour",
    "police_decision",
    "junction_count",
    "retention_raw",
]


def _nodes(plan):
    out = [plan]
    if plan.nodeName().endswith("QueryStage"):  # executed AQE stage: its plan hangs off .plan()
        return out + _nodes(plan.plan())
    children = plan.children()
    for i in range(children.size()):
        out.extend(_nodes(children.apply(i)))
    return out


def _stage(plan):
    """Nodes of ``plan`` that run in the same stage (down to, not through, exchanges)."""
    out = [plan]
    children = plan.children()
    for i in range(children.size()):
        child = children.apply(i)
        if child.nodeName() not in ("Exchange", "BroadcastExchange"):
            out.extend(_stage(child))
    return out


def _initial_plan(df):
    plan = df._jdf.queryExecution().executedPlan()
    return plan.initialPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan


def _feeder(exchange):
    node = exchange.children().apply(0)
    while node.nodeName() in PASS_THROUGH or node.nodeName().startswith("WholeStageCodegen"):
        node = node.children().apply(0)
    return node


def _is_partial(node) -> bool:
    text = node.simpleString(200)
    return "partial_" in text or "merge_" in text or text.rstrip().endswith("Partial") or "functions=[]" in text


@pytest.fixture(scope="module")
def plans(spark):
    return {name: _initial_plan(entry.queries()[name](spark, SF_ORACLE)) for name in BATCH}


@pytest.mark.parametrize("name", BATCH)
def test_no_python_or_cartesian_operators(plans, name):
    found = {n.nodeName() for n in _nodes(plans[name])} & FORBIDDEN
    assert not found, found


@pytest.mark.parametrize("name", BATCH)
def test_every_shuffle_carries_pre_aggregated_rows(plans, name):
    for node in _nodes(plans[name]):
        if node.nodeName() != "Exchange" or name in RAW_JOIN:
            continue
        feeder = _feeder(node)
        kind = feeder.nodeName()
        assert kind in AGGREGATES or (kind == "WindowGroupLimit" and _is_partial(feeder)), (
            f"{name}: shuffle fed by {feeder.simpleString(120)}"
        )
        if kind in AGGREGATES and not _is_partial(feeder):
            # A final aggregate may feed a second shuffle only if its own input was shuffled.
            scans = [n for n in _stage(feeder) if n.nodeName().startswith("Scan")]
            assert not scans, f"{name}: raw rows reach a final aggregate"


@pytest.mark.parametrize("name", BATCH)
def test_no_raw_table_is_broadcast(plans, name):
    for node in _nodes(plans[name]):
        if node.nodeName() == "BroadcastExchange" and name not in OWN_TABLES:
            scans = [n for n in _stage(_feeder(node)) if n.nodeName().startswith("Scan parquet")]
            assert not scans, f"{name}: broadcasts rows of a stored table that no aggregate bounds"


@pytest.mark.parametrize("name", BATCH)
def test_scans_prune_columns(plans, name):
    for node in _nodes(plans[name]):
        if node.nodeName().startswith("Scan parquet"):
            cols = {a.name() for a in _seq(node.output())} - FOLDERS
            assert len(cols) < 6 or name in OWN_TABLES, f"{name} reads every column: {sorted(cols)}"


@pytest.mark.parametrize("name", RANGE_PUSHED)
def test_trailing_range_reaches_the_scan(plans, name):
    scans = [n.simpleString(2000) for n in _nodes(plans[name]) if n.nodeName().startswith("Scan parquet")]
    assert scans and all("GreaterThanOrEqual(ts," in s for s in scans), scans


def _seq(scala_seq):
    return [scala_seq.apply(i) for i in range(scala_seq.size())]


# ------------------------------------------------------------- hot sensor


def _shuffle_records(df) -> list[int]:
    """Run ``df`` through its own query execution; rows written by each shuffle."""
    df.collect()  # results are small (groups x a few columns); this keeps the same QueryExecution
    final = df._jdf.queryExecution().executedPlan().executedPlan()
    written = []
    for node in _nodes(final):
        if node.nodeName() == "Exchange":
            metrics = node.metrics()
            if metrics.contains("shuffleRecordsWritten"):
                written.append(int(metrics.apply("shuffleRecordsWritten").value()))
    return written


@pytest.fixture(scope="module")
def hot_readings(spark, tmp_path_factory):
    """sf0.01 events plus a copy of all of them under one sensor: that sensor holds half the rows.

    Written as several files so the scan has several map tasks.
    """
    events = ev.load_events(spark, SF_ORACLE)
    hot = events.unionByName(events.withColumn("event_type", F.lit("hot")))
    path = str(tmp_path_factory.mktemp("hot") / "events.parquet")
    hot.repartition(8).write.parquet(path)
    readings = ev.readings(spark.read.schema(events.schema).parquet(path))
    return readings, spark.read.parquet(path).rdd.getNumPartitions(), hot.count()


def test_hot_sensor_hourly_shuffle_is_bounded_by_groups(spark, hot_readings):
    readings, tasks, n_rows = hot_readings
    hourly = hourly_traffic(raw_events(readings), lookback=None)
    groups = hourly.count()
    written = _shuffle_records(hourly)
    assert written, "expected a shuffle"
    assert sum(written) <= tasks * groups < n_rows / 10, (written, tasks, groups)
    hot = hourly.filter(F.col("sensor_id") == "hot").agg(F.sum("reading_count")).first()[0]
    assert hot * 2 == n_rows  # nothing dropped: the hot sensor's readings are all counted


def test_hot_sensor_top_n_ships_at_most_n_per_task(spark, hot_readings):
    readings, tasks, _ = hot_readings
    alerts = critical_alerts(readings, at=F.col("event_time"))
    capped = first_n_alerts(alerts, n=3)
    sensors = alerts.select("sensor_id").distinct().count()
    written = _shuffle_records(capped)
    assert written and sum(written) <= tasks * sensors * 3, (written, tasks, sensors)
    counts = dict(alert_counts(alerts, lookback=None).collect())
    got = dict(capped.groupBy("sensor_id").count().collect())
    assert got == {s: min(3, c) for s, c in counts.items()}


def test_hot_sensor_profile_join_is_split_not_dropped(spark, hot_readings):
    """No broadcast hint; with broadcasts off, AQE splits the hot partition.

    The per-sensor aggregate right after the join would normally stop AQE from
    splitting (the split needs one more shuffle); the session default
    ``forceOptimizeSkewedJoin`` makes it split anyway.
    """
    from junctionflow.operators import default_profile, sensor_profile_check
    from junctionflow.plans.catalog import PROFILE

    readings, _, n_rows = hot_readings
    profile = default_profile(spark, PROFILE + [("hot", 10, 50, 20, 80)])
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"
        checked = sensor_profile_check(readings, profile).groupBy("sensor_id").agg(
            F.count(F.lit(1)).alias("n"), F.count_if("speed_ok").alias("speed_ok")
        )
        got = {r.sensor_id: r.n for r in checked.collect()}
        plan = checked._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in plan
    assert got["hot"] * 2 == n_rows and sum(got.values()) == n_rows
