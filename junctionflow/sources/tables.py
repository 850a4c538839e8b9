"""Batch scans of the stored tables (parquet folders, catalog tables or JDBC)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params, schema
from ..functions import cutoff, ts_literal

# Partition column each stored table is written with (see streaming.sinks).
PARTITION_COLUMN = {
    "traffic_events": "event_date",
    "critical_traffic": "alert_date",
    "congestion_index": "window_date",
    "daily_peak_report": "report_date",
    "night_rollup": "report_date",
}


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


#: Tables whose rows get the time they are stored.
STAMPED = ("congestion_index", "daily_peak_report")
STREAM_TABLES = ("traffic_events", "critical_traffic", "congestion_index", "quarantine")

TABLE_SCHEMA = {
    "traffic_events": schema.TRAFFIC_EVENTS,
    "critical_traffic": schema.CRITICAL_TRAFFIC,
    "congestion_index": schema.CONGESTION_INDEX,
    "quarantine": schema.QUARANTINE,
    "daily_peak_report": schema.DAILY_PEAK_REPORT,
    "night_rollup": schema.NIGHT_ROLLUP,
}


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of a path, whatever store it names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def stored_schema(name: str) -> T.StructType:
    """Declared columns of a stored table and those of its folders."""
    part = PARTITION_COLUMN.get(name)
    own = TABLE_SCHEMA[name].fields + ([schema.CREATED_AT] if name in STAMPED else [])
    fields = [f for f in own if f.name != part] + ([T.StructField(part, T.DateType())] if part else [])
    if name in STREAM_TABLES:
        fields += [T.StructField("run", T.StringType()), T.StructField("batch_id", T.IntegerType())]
    return T.StructType(fields)


def read_files(spark: SparkSession, path: str, fmt: str = "parquet", name: str | None = None) -> DataFrame:
    """Scan a folder; a known table's schema is declared, and its absent folder is an empty table."""
    reader = spark.read.format(fmt)
    if name not in TABLE_SCHEMA:
        return reader.load(path)
    if not path_exists(spark, path):
        return spark.createDataFrame([], stored_schema(name))
    return reader.schema(stored_schema(name)).load(path)


def read_table(spark: SparkSession, name: str, base: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Scan ``name`` under ``base`` (a folder of ``fmt`` files), or from the catalog when ``base`` is None."""
    if base is None:
        return spark.read.table(name)
    return read_files(spark, table_path(base, name), fmt, name)


def range_start_day(spark: SparkSession, as_of, lookback: str) -> str:
    """First day (``yyyy-MM-dd``, session time zone) of ``as_of - lookback``.

    One constant expression evaluated by Spark, so it uses the same zone and
    interval syntax as the row filter of the range.
    """
    return spark.range(1).select(F.date_format(F.to_date(cutoff(as_of, lookback)), "yyyy-MM-dd")).first()[0]


def partition_days(spark: SparkSession, root: str, part: str) -> list[str]:
    """Values of the top-level date partition folders of a table (one directory listing)."""
    fs, path = file_system(spark, root)
    if not fs.exists(path):
        return []
    prefix = part + "="
    names = [st.getPath().getName() for st in fs.listStatus(path) if st.isDirectory()]
    return sorted(n[len(prefix):] for n in names if n.startswith(prefix))


def read_range(
    spark: SparkSession,
    name: str,
    base: str,
    as_of,
    lookback: str = params.LOOKBACK,
    fmt: str = "parquet",
) -> DataFrame:
    """Scan only the date folders a trailing range can touch.

    Stream tables are laid out ``<date>=D/run=R/batch_id=N``. Reading the table
    root makes Spark list every batch folder of every day before it prunes
    partitions (a 5 s trigger leaves 17,280 folders a day until the day is
    compacted). Here the root's date folders are
    listed once (one level) and only days from the range's first day on are
    handed to the reader (with ``basePath``, so the date stays a column). The
    range keeps the nightly's lower-bound-only meaning: later days are read too.
    Without a metastore this is the pruning a catalog table gets from its
    partition list.
    """
    first = range_start_day(spark, as_of, lookback)
    days = partition_days(spark, table_path(base, name), PARTITION_COLUMN[name])
    return read_days(spark, name, base, [d for d in days if d >= first], fmt)


def read_days(spark: SparkSession, name: str, base: str, days: list[str], fmt: str = "parquet") -> DataFrame:
    """Scan those of the days' date folders that there are."""
    root = table_path(base, name)
    part = PARTITION_COLUMN[name]
    there = sorted(set(days) & set(partition_days(spark, root, part)))
    if not there:
        return spark.createDataFrame([], stored_schema(name))
    reader = spark.read.format(fmt).schema(stored_schema(name)).option("basePath", root)
    return reader.load([f"{root}/{part}={d}" for d in there])


def jdbc_table(
    spark: SparkSession,
    url: str,
    name: str,
    props: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """JDBC scan; give a numeric ``partition_column`` and bounds to read in parallel.

    Filters on the result are pushed into the remote query by Spark's JDBC source.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", name)
    for k, v in (props or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions or 8))
        )
    return reader.load()


def write_jdbc(df: DataFrame, url: str, name: str, props: dict[str, str] | None = None, mode: str = "append") -> None:
    """JDBC append writer (one connection per task, batched inserts)."""
    writer = df.write.format("jdbc").option("url", url).option("dbtable", name).mode(mode)
    for k, v in (props or {}).items():
        writer = writer.option(k, v)
    writer.save()
