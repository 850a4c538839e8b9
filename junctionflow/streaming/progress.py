"""A durable table of what each micro-batch did.

A listener turns every progress report into one row (rows read, rows the
watermark dropped, event-time lag) and writes some of them at a time as a small
file of JSON lines, named by query and batches. A replayed batch reports again
under the same number; a reader takes the newest report of each batch.
"""

from __future__ import annotations

import json
from collections import defaultdict
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..sources.tables import file_system, path_exists

PROGRESS = (
    "query string, id string, run string, batch_id long, at timestamp, rows long, late_rows long, "
    "max_event_time timestamp, watermark timestamp, lag_seconds double"
)


def _time(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text.replace("Z", "+00:00")) if text else None


def report_row(p) -> dict:
    """One row of a progress report."""
    event = dict(p.eventTime or {})
    newest, at = event.get("max"), p.timestamp
    lag = (_time(at) - _time(newest)).total_seconds() if newest else None
    late = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
    return {
        "query": p.name, "id": str(p.id), "run": str(p.runId), "batch_id": p.batchId, "at": at, "rows": p.numInputRows,
        "late_rows": late, "max_event_time": newest, "watermark": event.get("watermark"), "lag_seconds": lag,
    }


class ProgressTable(StreamingQueryListener):
    """Writes the progress of the session's queries under ``path``; rows wait for ``every`` batches of their query, or its end.

    ``every=1`` loses no report when the driver dies; more make fewer files.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 20):
        self.spark, self.path, self.every = spark, path, every
        self.held: dict[str, list[dict]] = defaultdict(list)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = report_row(event.progress)
        self.held[row["id"]].append(row)
        if len(self.held[row["id"]]) >= self.every:
            self.flush(row["id"])

    def onQueryTerminated(self, event) -> None:
        self.flush(str(event.id))

    def flush(self, query_id: str) -> None:
        rows = self.held.pop(query_id, [])
        if not rows:
            return
        name = f"{rows[0]['run']}-{rows[0]['batch_id']}-{rows[-1]['batch_id']}-{rows[-1]['at'].replace(':', '')}.json"
        fs, p = file_system(self.spark, f"{self.path}/{query_id}/{name}")
        out = fs.create(p, True)
        try:
            out.write(bytearray("".join(json.dumps(r) + "\n" for r in rows).encode()))
        finally:
            out.close()


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """PROGRESS rows: the newest report of each batch of each query."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], PROGRESS)
    rows = spark.read.schema(PROGRESS).option("recursiveFileLookup", "true").json(path)
    columns = [c for c in rows.columns if c not in ("id", "batch_id")]
    newest = rows.groupBy("id", "batch_id").agg(F.max_by(F.struct(*columns), "at").alias("r"))
    return newest.select("id", "batch_id", "r.*").select(*rows.columns)


def query_totals(progress: DataFrame) -> DataFrame:
    """(query, batches with rows, rows, late_rows, max_lag_seconds) of each query."""
    return progress.groupBy("query").agg(
        F.count_if(F.col("rows") > 0).alias("batches"),
        F.sum("rows").alias("rows"),
        F.sum("late_rows").alias("late_rows"),
        F.max("lag_seconds").alias("max_lag_seconds"),
    )
