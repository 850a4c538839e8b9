"""Hourly sums bucketed by sensor: the decision without an exchange, days that replace themselves."""

from __future__ import annotations

import uuid

import pytest

from junctionflow.plans.catalog import AS_OF, EventTables, _decision_out
from junctionflow.plans.colocated import SUMS, colocated_decision, store_hours
from junctionflow.params import PoliceRule

from .conftest import SF_SMALL, rows


def stored(spark, base, tables, buckets=4):
    prefix = "t" + uuid.uuid4().hex[:8]
    store_hours(spark, tables, prefix, base, buckets)
    return prefix


@pytest.fixture(scope="module")
def users(spark, tmp_path_factory):
    t = EventTables(spark, SF_SMALL, sensor="user_id")
    tables = {n: getattr(t, n) for n in SUMS}
    return t, tables, stored(spark, str(tmp_path_factory.mktemp("hours")), tables)


@pytest.mark.parametrize("as_of", [AS_OF, "2024-01-17 13:00:00"])
def test_decision_equals_the_one_from_readings(spark, users, as_of):
    t, _, prefix = users
    rule = PoliceRule(index_gt=1.0, alerts_ge=2, speed_lt=20.0)
    want = rows(_decision_out(t.decisions("rule", as_of, rule)))
    assert rows(_decision_out(colocated_decision(spark, prefix, as_of, rule=rule))) == want
    assert len(want) > 3


def test_no_exchange_below_the_joins(spark, users):
    decision = colocated_decision(spark, users[2], AS_OF)
    decision.collect()
    plan = decision._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "BroadcastHashJoin" not in plan
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan and "Bucketed: false" not in plan
    assert plan.count("PartitionFilters: [isnotnull(event_date") == plan.count("FileScan")


def test_a_day_that_is_stored_again_replaces_itself(spark, users, tmp_dir):
    _, tables, _ = users
    prefix = stored(spark, tmp_dir, tables)
    before = rows(colocated_decision(spark, prefix, AS_OF))
    others = {n: spark.table(f"{prefix}_{n}").filter("event_date < '2024-01-30'").count() for n in SUMS}
    last = {n: df.filter(f"{SUMS[n][0]} >= '2024-01-30'") for n, df in tables.items()}
    store_hours(spark, last, prefix, tmp_dir, 4)
    assert rows(colocated_decision(spark, prefix, AS_OF)) == before
    assert others == {n: spark.table(f"{prefix}_{n}").filter("event_date < '2024-01-30'").count() for n in SUMS}


def test_a_hot_sensor_is_a_row_an_hour(spark, users, tmp_dir):
    _, tables, _ = users
    hot = tables["traffic_events"].withColumn("sensor_id", tables["traffic_events"].sensor_id.substr(1, 0))
    prefix = stored(spark, tmp_dir, {**tables, "traffic_events": hot})
    table = spark.table(f"{prefix}_traffic_events")
    per_day = table.groupBy("event_date").count().agg({"count": "max"}).first()[0]
    assert per_day <= 24 and table.agg({"readings": "sum"}).first()[0] == hot.count()


def test_empty_tables_and_part_hours(spark, users, tmp_dir):
    _, tables, prefix = users
    none = stored(spark, tmp_dir, {n: df.limit(0) for n, df in tables.items()})
    assert rows(colocated_decision(spark, none, AS_OF)) == []
    with pytest.raises(ValueError, match="whole hours"):
        colocated_decision(spark, prefix, "2024-01-17 13:00:01")
