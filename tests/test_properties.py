"""Property: the stream equals its batch twin for any split of time-ordered input into files."""

from __future__ import annotations

import datetime as dt
import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from junctionflow.operators import congestion_windows, critical_alerts
from junctionflow.sources import parse, text_source
from junctionflow.sources.events import load_events, payloads
from junctionflow.streaming import await_all, read_sink, run_pipeline

from .conftest import SF_SMALL

COLS = ["sensor_id", "window_start", "window_end", "total_vehicles", "avg_speed", "congestion_idx"]


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(min_value=1, max_value=999), min_size=0, max_size=3, unique=True))
def test_stream_equals_batch_for_any_split(spark, cuts):
    import tempfile

    tmp = tempfile.mkdtemp(prefix="jf-prop-")
    events = load_events(spark, SF_SMALL)
    lines = [r.value for r in payloads(events).orderBy("offset").select("value").collect()]  # 1,000-row fixture
    bounds = [0, *sorted(cuts), len(lines)]
    os.makedirs(f"{tmp}/src")
    for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
        path = f"{tmp}/src/part-{i:03d}.json"
        with open(path, "w") as f:
            f.write("\n".join(lines[a:b]) + ("\n" if b > a else ""))
        os.utime(path, (1_700_000_000 + i * 10,) * 2)
    reader = spark.readStream.format("text").option("maxFilesPerTrigger", "1").load(f"{tmp}/src")
    await_all(run_pipeline(spark, reader, f"{tmp}/t", f"{tmp}/cp", available_now=True, quarantine=False))

    accepted, _ = parse(payloads(events))
    assert read_sink(spark, f"{tmp}/t/traffic_events").count() == events.count()
    assert read_sink(spark, f"{tmp}/t/critical_traffic").count() == critical_alerts(accepted).count()
    max_t = accepted.agg(F.max("event_time")).first()[0]
    expected = congestion_windows(accepted, watermark=None).filter(
        F.col("window_end") <= F.lit(max_t - dt.timedelta(minutes=10))
    )
    got = read_sink(spark, f"{tmp}/t/congestion_index").select(COLS)
    assert got.exceptAll(expected.select(COLS)).count() == 0
    assert expected.select(COLS).exceptAll(got).count() == 0
    _ = text_source  # same reader the pipeline uses in production
