"""Counts and maxima of stored tables from their file footers.

Parquet files keep the number of their rows and the least and greatest value of
each column. Spark's second parquet reader answers COUNT, MIN and MAX (also by
partition column) from these alone. That reader and its aggregate push-down are
session settings, so they are set in a sibling session, and the caller's stays
as it is.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import PARTITION_COLUMN, path_exists, read_days, stored_schema, table_path


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose parquet scans answer aggregates from footers."""
    s = spark.newSession()
    others = [x for x in s.conf.get("spark.sql.sources.useV1SourceList").split(",") if x.strip() != "parquet"]
    s.conf.set("spark.sql.sources.useV1SourceList", ",".join(others))
    s.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    s.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return s


def _table(session: SparkSession, name: str, base: str) -> DataFrame:
    path = table_path(base, name)
    if not path_exists(session, path):
        return session.createDataFrame([], stored_schema(name))
    return session.read.schema(stored_schema(name)).parquet(path)


def stored_row_counts(spark: SparkSession, base: str, names: Iterable[str]) -> DataFrame:
    """(tbl, row_count) of stored tables; no row group is opened."""
    session, out = footer_session(spark), None
    for name in names:
        part = _table(session, name, base).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("tbl"), "row_count")
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no tables given")
    return out


def by_folder(table: DataFrame, name: str, value) -> DataFrame:
    """The aggregate ``value`` (named "v") of each batch folder: grouped by all partition columns, which is what footers can answer."""
    return table.groupBy(PARTITION_COLUMN[name], "run", "batch_id").agg(value.alias("v"))


def day_maxima(spark: SparkSession, base: str, name: str, column: str) -> list[tuple[str, float | None]]:
    """(day, greatest value of the column) of each date folder of a table, from footers: one row a day."""
    part = PARTITION_COLUMN[name]
    table = _table(footer_session(spark), name, base)
    rows = by_folder(table, name, F.max(column)).groupBy(part).agg(F.max("v").alias("most")).collect()
    return sorted((str(r[part]), r.most) for r in rows)


def newest_days(spark: SparkSession, base: str, name: str, days: list[str], n: int) -> list[str]:
    """The fewest of the newest days that hold n rows together (all, if they hold fewer), by counts from footers."""
    part = PARTITION_COLUMN[name]
    folders = by_folder(_table(footer_session(spark), name, base), name, F.count(F.lit(1)))
    counts = {str(r[part]): r.n for r in folders.groupBy(part).agg(F.sum("v").alias("n")).collect()}  # one row a day
    taken, held = [], 0
    for d in sorted(days, reverse=True):
        if held >= n:
            break
        taken.append(d)
        held += counts.get(d, 0)
    return taken


def top_days(spark: SparkSession, base: str, name: str, column: str, n: int) -> DataFrame:
    """Rows of the days that can hold the n greatest values of the column.

    Days are read from the greatest maximum down, twice as many each time, until
    the n-th value read is above the maximum of every day that was not.
    """
    maxima = sorted(((m, d) for d, m in day_maxima(spark, base, name, column) if m is not None), reverse=True)
    take = 1
    while True:
        rows = read_days(spark, name, base, [d for _, d in maxima[:take]])
        if take >= len(maxima):
            return rows
        best = [r[0] for r in rows.filter(F.col(column).isNotNull()).orderBy(F.col(column).desc()).select(column).limit(n).collect()]  # n values
        if len(best) == n and best[-1] > maxima[take][0]:
            return rows
        take *= 2
