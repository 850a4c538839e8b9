"""The pipeline's stages against SQL twins of their operators, each over its own input."""

from __future__ import annotations

import hashlib
import os

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from junctionflow.llm import catalog, decontam, toxicity, twins
from junctionflow.llm._store import load, written
from junctionflow.session import scratch_path

from .conftest import duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The input of each stage and the last result."""
    docs, out = load(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        out.append(docs)
        docs = written(stage(spark, docs, SF), "test-stage")
    return [*out, docs]


def rows(df):
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


def test_columns_stay(stages):
    for df in stages[:-1]:
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert df.filter(F.col("n_chars") != F.length("text")).count() == 0


def test_toxic_documents_go(spark, stages):
    scored = toxicity.score_documents(stages[0], load(spark, SF, "labels"))
    clean = {r.doc_id for r in scored.filter("predicted = 0").collect()}
    assert {r.doc_id for r in stages[1].collect()} == clean
    assert 0 < len(clean) < stages[0].count()


def test_repeated_lines_go(stages):
    want = {r[0]: r[1] for r in duck(f"SELECT doc_id AS a, kept_sha256 AS b FROM ({twins.LINES})", docs=rows(stages[1]))}
    assert {i: hashlib.sha256(t.encode()).hexdigest() for i, t, _ in rows(stages[2])} == want


def test_one_document_of_each_group_stays(stages):
    want = duck(f"SELECT doc_id FROM ({twins.GROUPS}) WHERE doc_id = component_id", docs=rows(stages[2]))
    assert sorted(r[0] for r in rows(stages[3])) == [i for (i,) in sorted(want)]


def test_benchmark_passages_go(spark, stages):
    items = load(spark, SF, "benchmark")
    before = {r.doc_id: r for r in decontam.contamination(stages[3], items).collect()}
    after = {r.doc_id: r for r in decontam.contamination(stages[4], items).collect()}
    assert all(not r.contaminated for r in after.values())
    for i, r in before.items():
        if not r.contaminated:
            assert after[i].n_words == r.n_words
        elif i in after:
            assert after[i].n_words == r.n_words - r.n_hit
        else:
            assert r.n_hit > 0.5 * r.n_words
    assert any(r.contaminated for r in before.values())


def test_mix(stages):
    got = sorted((r.doc_id, r["size"], r.source_size, r.target, r.taken) for r in stages[5].collect())
    want = duck(f"SELECT doc_id AS a, size AS b, source_size AS c, target AS d, taken AS e FROM ({twins.MIX})", docs=rows(stages[4]))
    assert got == sorted(want)


def left_over(spark):
    top = scratch_path(spark, "llm", unique=False).removeprefix("file:")
    return {x for _, _, files in os.walk(top) for x in files if x.endswith(".parquet")}


def test_run_is_the_stages_in_turn(spark, stages):
    """The same rows, and of all tables made on the way only the result's files stay in the shared folder."""
    assert catalog.QUERIES["pipeline"] is corpus_pipeline.run
    before = left_over(spark)
    result = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, result.collect())) == sorted(map(tuple, stages[5].collect()))
    assert left_over(spark) - before == {os.path.basename(f) for f in result.inputFiles()}


def test_every_operator_has_its_query():
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in catalog.QUERIES)] == []
    assert set(catalog.ORACLE) <= set(catalog.QUERIES)
