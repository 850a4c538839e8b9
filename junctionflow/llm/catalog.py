"""Registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, chat, decontam, linededup, lm, mixing, negatives, ngram_join, quality, substring, toxicity, units, whitening
from ._store import load
from .twins import SQL

Query = Callable[[SparkSession, str], DataFrame]


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(load(spark, sf_dir, "documents"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(load(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(load(spark, sf_dir, "documents")).select(
        "doc_id",
        F.col("__n_lines").alias("n_lines"),
        F.col("__n_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op5_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(load(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op7_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(load(spark, sf_dir, "embeddings"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.dedup_substrings(load(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op9_line_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = units.dedup_units(load(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.size("removed").cast("long").alias("n_removed"),
        F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("removed_chars"),
        F.array_join(F.transform("removed", lambda s: F.concat_ws("-", s["start"], s["end"])), ",").alias("removed"),
        "n_units",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(load(spark, sf_dir, "embeddings"), label=moved)


def op12_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.with_quoting(spark, load(spark, sf_dir, "conversations"))
    return chat.digests(chat.format_conversations(chat.events_of_turns(turns)))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(load(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_mix_sources": op2_mix_sources,
    "op3_toxicity": op3_toxicity,
    "op4_line_dedup": op4_line_dedup,
    "op5_lattice_lm": op5_lattice_lm,
    "op6_decontamination": op6_decontamination,
    "op7_multi_index": op7_multi_index,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_line_hashing": op9_line_hashing,
    "op10_quality": op10_quality,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_chat_formatting": op12_chat_formatting,
    "op13_whitening": op13_whitening,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {k: SQL[k] for k in QUERIES if k in SQL}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
