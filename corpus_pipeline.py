"""From raw documents to a training mix, in five stages.

Every stage takes all documents that the one before kept and returns the columns
of ``documents``; only the last returns the mix: one row a document with the
words that are taken of it. ``n_chars`` follows the text where a stage cuts it.

A stage's result is written before the next stage is called, so each stage first
drops what the one before has left: its tables in the shared folder, its
broadcasts, and its shuffles.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from junctionflow.llm import decontam, linededup, mixing, ngram_join, toxicity
from junctionflow.llm._store import Scratch, discard, load, written

#: The first stage learns a classifier, which SQL cannot express.
ORACLE_SQL = None


def _recounted(docs: DataFrame) -> DataFrame:
    """n_chars, where the table has it, as the length of the text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


_left = Scratch()


def _stage(fn):
    """A stage that drops what the stage before it has left, and records what it leaves itself."""

    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _left.release(spark)
        with _left:
            return fn(spark, docs, sf_dir)

    return run_stage


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, load(spark, sf_dir, "labels"))


@_stage
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(linededup.drop_repeated_lines(docs))


@_stage
def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each_group(docs)


@_stage
def cut_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(decontam.decontaminated(docs, load(spark, sf_dir, "benchmark")))


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", cut_benchmark_passages),
    ("mixing sources to target weights", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again, and only the last one stays in the shared folder."""
    docs, before = load(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage-{k + 1}")
        if before is not None:
            discard(before)
        before = docs
    _left.release(spark)
    return docs
