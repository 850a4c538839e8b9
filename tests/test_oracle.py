"""Every registered query against its DuckDB twin (row count, columns, exact values)."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from junctionflow.plans.catalog import QUERIES
from tools.oracle_check import digest

from .conftest import SF_SMALL

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events",):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql_twin(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cols = df.columns
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert len(srows) == len(drows)
    os_, od = sorted(range(len(cols)), key=lambda i: cols[i]), sorted(range(len(dcols)), key=lambda i: dcols[i])
    hs, _ = digest([tuple(r[i] for i in os_) for r in srows])
    hd, _ = digest([tuple(r[i] for i in od) for r in drows])
    assert hs == hd


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["sensor_id", "peak_hour", "peak_vehicles", "avg_speed", "alert_count", "avg_congestion", "needs_police"]


def test_oracle_tool_is_importable():
    assert os.path.exists(os.path.join(os.path.dirname(__file__), "..", "tools", "oracle_check.py"))
