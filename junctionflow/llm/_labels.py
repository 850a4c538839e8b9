"""Labelled rows for classifiers: a bounded, repeatable sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import written


def checksum_is(modulus: int, remainder: int) -> Column:
    """crc32 of the id as text, modulo; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, column: str, modulus: int, remainder: int, most: int, unlabelled: int = 0
) -> DataFrame:
    """(text, y) of at most ``most`` labelled ids whose checksum is not the held-out one, chosen by a hash of the id.

    An id that is labelled more than once counts as 1 if any of its labels is;
    null labels and null ids are left out; an id on several rows gives one, with
    its least text, so that there are at most ``most`` rows. Up to ``unlabelled``
    ids without a label, of the same checksums, come with a null y.
    """
    training = F.col("doc_id").isNotNull() & ~checksum_is(modulus, remainder)
    known = labels.filter(training & F.col(column).isNotNull()).groupBy("doc_id").agg(F.max(F.col(column).cast("int")).alias("y"))
    by_hash = F.xxhash64("doc_id"), "doc_id"
    ids = known.orderBy(*by_hash).limit(most)
    if unlabelled:
        rest = docs.filter(training).select(F.col("doc_id").cast(known.schema["doc_id"].dataType).alias("doc_id")).distinct()
        rest = rest.join(known, "doc_id", "left_anti").orderBy(*by_hash).limit(unlabelled)
        ids = ids.unionByName(rest.withColumn("y", F.lit(None).cast("int")))
    ids = ids.select(F.col("doc_id").alias("__id"), "y")
    ids = written(ids, "sample-ids")  # at most ``most + unlabelled`` rows, hence the broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("__id"))
    # Aggregated partly before the shuffle: a task sends one text an id, however many rows have it.
    return written(rows.groupBy("__id", "y").agg(F.min("text").alias("text")).select("text", "y"), "sample")
