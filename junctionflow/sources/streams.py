"""Message sources: a Kafka topic, or a folder of JSON-lines files for tests.

Both yield a frame with a ``value`` column, so :func:`junctionflow.sources.parse.parse`
runs unchanged over either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_source(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
    extra: dict[str, str] | None = None,
) -> DataFrame:
    """Streaming read of one topic (needs the spark-sql-kafka package on the classpath)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if max_offsets_per_trigger:
        # Bounds one micro-batch so a backlog cannot produce an unbounded batch.
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in (extra or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def text_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of JSON-lines files; one line = one message ``value``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def peek(
    spark: SparkSession,
    source: str | DataFrame,
    n: int = 5,
    order_by: str | None = None,
    kafka: dict[str, str] | None = None,
) -> DataFrame:
    """Bounded look at the first ``n`` messages of a topic, folder or frame.

    The limit is the feature here (the console-consumer ``--max-messages``).
    On a topic the limit comes first: each partition task stops reading after
    ``n`` records, so a peek costs a few polls however large the topic is; only
    those ``n`` rows are then ordered by (partition, offset) for display. On a
    folder or frame, ``order_by`` makes it a deterministic top-n (each task keeps
    its ``n`` smallest rows, so only ``n`` rows per task are shuffled).
    """
    if kafka is not None and not isinstance(source, DataFrame):
        topic = (
            spark.read.format("kafka")
            .options(**kafka)
            .option("subscribe", source)
            .option("startingOffsets", "earliest")
            .load()
        )
        return topic.limit(n).orderBy("partition", "offset")
    df = source if isinstance(source, DataFrame) else spark.read.text(source)
    if order_by:
        df = df.orderBy(F.col(order_by))
    return df.limit(n)
