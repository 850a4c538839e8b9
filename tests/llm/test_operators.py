"""Each operator against its SQL twin or brute force, on edge cases and on an empty table."""

from __future__ import annotations

import itertools
import math
import os
import pickle
import random
import tempfile
import time
import tracemalloc
import uuid
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from junctionflow.llm import _sketch, _store, ann, decontam, linededup, lm, mixing, ngram_join, quality, substring, toxicity, twins, units
from junctionflow.llm._components import components
from junctionflow.llm._labels import labelled_sample
from junctionflow.llm._deepshallow import deep_shallow_order

from .conftest import duck, frame, plain, prose

LOG2 = 20


# 1. n-gram Jaccard join


def test_groups_match_sql(docs, edges):
    got = ngram_join.similar_groups(docs, log2=LOG2)
    assert plain(got) == duck(twins.GROUPS, docs=edges)


def test_groups_with_a_full_sketch(docs, edges):
    """A sketch without room proves nothing unique, and the result is the same."""
    assert plain(ngram_join.similar_groups(docs, log2=10)) == duck(twins.GROUPS, docs=edges)


@pytest.mark.parametrize("probes", [1, 2])
def test_levels_of_many_hashes_unpack_a_part_at_a_time(probes):
    rng, log2 = np.random.default_rng(3), 26
    slots = np.where(rng.random((_sketch.RANGES, 1 << (log2 - 8))) < 0.02, 27, 0).astype(np.uint8)
    parts = {r: zstandard.ZstdCompressor(level=1).compress(slots[r].tobytes()) for r in range(_sketch.RANGES) if r != 7}
    levels = _sketch.Levels(parts, log2, probes)
    h = rng.integers(0, 1 << 64, 20_000, dtype=np.uint64)
    tracemalloc.start()
    got = levels.of_many(h)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < slots.size // 4 and levels.packed is None
    assert set(got) == ({0, 1, 2, 3} if probes == 1 else set(got)) and np.array_equal(got, levels.of(h))
    assert len(levels.of_many(h[:0])) == 0


def test_groups_through_chains_and_hubs(spark):
    """Near copies that drift apart: links between neighbours only, found in the second round too."""
    rng = random.Random(3)
    words = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(60):
        rows.append((k, " ".join(words), "s"))
        words[rng.randrange(200)] = f"x{k}"
        words[rng.randrange(200)] = f"y{k}"
    rng.shuffle(rows)
    assert plain(ngram_join.similar_groups(frame(spark, rows), log2=LOG2)) == duck(twins.GROUPS, docs=rows)


def test_a_sketch_is_filled_by_shared_shingles_only(spark):
    """22,400 shingles in 1,024 slots: texts of their own are still proven unique and not indexed, near copies are."""
    rng = random.Random(11)
    texts = [[f"w{rng.randrange(10**6)}" for _ in range(60)] for _ in range(400)]
    rows = [(k, " ".join(t), "s") for k, t in enumerate(texts)] + [(1000, " ".join([*texts[7][:-1], "other"]), "s")]
    sets = ngram_join._sets(frame(spark, rows), ngram_join.WIDTH, ngram_join.PERCENT, 10)
    assert {7, 1000} <= (indexed := {r.doc_id for r in sets.filter("grams is not null").collect()}) and len(indexed) < 40
    assert plain(ngram_join.similar_groups(frame(spark, rows), log2=10)) == duck(twins.GROUPS, docs=rows)


def test_levels_of_shared_hashes(spark):
    rng = np.random.default_rng(4)
    times = dict(zip(rng.integers(0, 1 << 63, 600, dtype=np.int64).tolist(), [1] * 400 + [2, 3, 4, 14, 15, 40] * 33 + [9, 9]))
    hashes = spark.createDataFrame([(h,) for h, n in times.items() for _ in range(n)], "h long").repartition(7)
    levels = _sketch.shared_levels(hashes, lambda b: iter([np.asarray(b.column(0)).view(np.uint64)]), log2=26)
    got = levels.of_many(np.array(list(times), np.int64).view(np.uint64)).tolist()
    assert got == [0 if n < 2 else 1 if n < 4 else 2 if n < 15 else 3 for n in times.values()]


def test_cell_gaps_of_any_density():
    rng = np.random.default_rng(5)
    for n, top in ((1, 1 << 27), (3, 5), (5000, 1 << 27), (200_000, 1 << 27), (200_000, 1 << 10)):
        slots = np.sort(rng.integers(0, top, n, dtype=np.uint32))
        wide, payload = _sketch._cell_gaps(slots)
        assert len(payload) <= 4 * n and np.array_equal(_sketch._cell_slots(wide, payload), slots)


@pytest.mark.parametrize("meet", [1, 7, 1 << 18])
def test_pairs_of_rows_are_those_of_two_loops(monkeypatch, meet):
    monkeypatch.setattr(ngram_join, "MEET", meet)
    rng = np.random.default_rng(6)
    k = 300
    n = rng.integers(20, 30, k)
    free, l1, l2 = rng.integers(0, 4, k), rng.integers(0, 9, k), rng.integers(0, 4, k)
    counts = rng.integers(0, 2, (k, ngram_join.BUCKETS)).astype(np.int16)
    cols = {
        "gram": np.sort(rng.integers(0, 12, k)), "chunk": np.zeros(k, np.int32), "n": n, "free": free, "l1": l1, "l2": l2, "pos": free + rng.integers(0, 4, k),
        "part": [bytes([p]) for p in rng.integers(0, 4, k)], "counts": counts.tolist(), "own": rng.random(k) < 0.8, "prev": rng.integers(0, 12, k),
    }
    cols["is_main"] = np.array([p == b"\x01" for p in cols["part"]])
    rows = pa.table({**cols, "part": pa.array(cols["part"], pa.binary()), "counts": pa.array(cols["counts"], pa.list_(pa.int16()))})
    want = set()
    for x, y in itertools.product(range(k), repeat=2):
        if not cols["own"][x] or cols["is_main"][x] or cols["gram"][x] != cols["gram"][y] or cols["part"][x] == cols["part"][y]:
            continue
        if cols["prev"][x] == cols["prev"][y] and min((cols["pos"] - free)[[x, y]]) > 0:
            continue
        need = -(-75 * (n[x] + n[y]) // 175)
        levels = min(l1[x], l1[y]) + min(l2[x], l2[y]) + min((n - free - l1 - l2)[x], (n - free - l1 - l2)[y])
        here, shared = min((n - cols["pos"])[x], (n - cols["pos"])[y]), np.minimum(counts[x], counts[y]).sum()
        if 100 * min(n[x], n[y]) >= 75 * max(n[x], n[y]) and min(here, levels, shared) >= need:
            want.add((x, y))
    got = [(x, y) for a, b in ngram_join._met(rows, 75) for x, y in zip(a.tolist(), b.tolist())]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 10


def test_a_hot_shingle_is_met_in_parts(spark, monkeypatch):
    """Many variants of one text that are no copies of the first: each meets all others, whatever the size of the parts."""
    rng = random.Random(8)
    origin = [f"o{k}" for k in range(80)]
    rows = []
    for k in range(60):
        words = list(origin)
        for at in rng.sample(range(80), 3):
            words[at] = f"v{k % 25}x{at}"
        rows.append((k, " ".join(words), "s"))
    want = duck(twins.GROUPS, docs=rows)
    for chunk in (1, 16, 8192):
        monkeypatch.setattr(ngram_join, "CHUNK", chunk)
        assert plain(ngram_join.similar_groups(frame(spark, rows), log2=LOG2)) == want


def test_one_of_each_group(docs, no_docs):
    kept = ngram_join.one_of_each_group(docs, log2=LOG2)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert 7 not in ids and 9 not in ids and 5 not in ids and {0, 1, 2, 3, 4, 6, 12, 13} <= set(ids)
    assert ngram_join.similar_groups(no_docs, log2=LOG2).count() == 0


def test_components_of_random_links(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 440)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: root(x) for x in linked}


# 2. mixing


def test_mix_matches_sql(docs, edges):
    assert plain(mixing.plan_mix(docs).drop("source")) == duck(f"SELECT * EXCLUDE (source) FROM ({twins.MIX})", docs=edges)


def test_mix_takes_its_budget(docs, no_docs):
    rows = mixing.plan_mix(docs).collect()
    for s in {r.source for r in rows}:
        own = [r for r in rows if r.source == s]
        assert sum(r["size"] for r in own) == own[0].source_size
        assert sum(r.taken for r in own) == math.floor(own[0].target)
    assert all(0 <= r.taken <= 2 * r["size"] for r in rows)
    assert abs(sum({r.source: r.target for r in rows}.values()) - 1.5 * sum(r["size"] for r in rows)) < 1e-6
    assert mixing.plan_mix(no_docs).count() == 0


def test_mixture_holds_the_words(spark, edges):
    rows = [r for r in edges if r[0] is not None and r[0] != 7]
    got = mixing.mixture(frame(spark, rows))
    want = {r.doc_id: r.taken for r in mixing.plan_mix(frame(spark, rows)).collect()}
    words = Counter()
    for r in got.collect():
        words[r.doc_id] += len(r.text.encode().split())
    assert words == Counter({k: v for k, v in want.items() if v})


# 3. toxicity


def score_cases(spark, df):
    rows = [(None, "loser idiot", "s"), (1, None, "s"), (2, "", "s"), (3, "a" * 100_000, "s"), (3, "a" * 100_000, "s")]
    return df(frame(spark, rows)).collect()


@pytest.fixture(scope="module")
def labelled(spark):
    d = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")


def test_toxicity_held_out(labelled):
    docs, labels = labelled
    got = toxicity.score_documents(docs, labels)
    rows = got.join(labels, "doc_id").filter("held_out and quality = 1").collect()
    clean, toxic = [r.predicted for r in rows if r.toxic == 0], [r.predicted for r in rows if r.toxic == 1]
    assert len(clean) > 30 and len(toxic) > 3
    assert np.mean(clean) <= 0.05 and np.mean(toxic) >= 0.7
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got.collect())


def test_toxicity_held_out_of_any_quality(labelled):
    docs, labels = labelled
    rows = toxicity.score_documents(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    clean, toxic = ([r.predicted for r in rows if r.toxic == t] for t in (0, 1))
    assert len([r for r in rows if r.quality == 0 and r.toxic == 0]) >= 10 and len(toxic) > 3
    assert np.mean(clean) <= 0.05 and np.mean(toxic) >= 0.6


def test_toxicity_edges(spark, labelled, no_docs):
    docs, labels = labelled
    rows = score_cases(spark, lambda d: toxicity.score_documents(d.unionByName(docs.select("doc_id", "text", "source").limit(0), allowMissingColumns=True), labels))
    assert len(rows) == 5 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    none = labels.limit(0)
    assert {r.score for r in toxicity.score_documents(docs, none).collect()} == {0.0}
    assert toxicity.score_documents(no_docs, labels).count() == 0


def test_label_model_trusts_agreement():
    rng = np.random.default_rng(1)
    y = rng.random(2000) < 0.3
    votes = np.array([np.where(rng.random(2000) < acc, y, ~y) for acc in (0.9, 0.85, 0.8, 0.55)]).T.astype(float)
    noisy = np.where(rng.random(2000) < 0.01, ~y, y)
    post = toxicity.label_model(votes, noisy)
    assert np.mean((post > 0.5) == y) >= 0.985


def test_given_labels_only_start_the_label_model():
    """Labels turned over on a tenth of the rows: without a say of their own, the posterior follows the voters."""
    rng = np.random.default_rng(2)
    y = rng.random(3000) < 0.3
    votes = np.array([np.where(rng.random(3000) < acc, y, ~y) for acc in (0.93, 0.9, 0.9, 0.88, 0.9, 0.6)]).T.astype(float)
    wrong = np.where(rng.random(3000) < 0.1, ~y, y)
    post = toxicity.label_model(votes, wrong, noise=None)
    assert np.mean((post > 0.5) == y) >= 0.97 and np.mean((post > 0.5) != wrong) >= 0.08
    known = np.arange(3000) < 400  # the rest has no label
    some = toxicity.label_model(votes, wrong & known, noise=None, known=known)
    assert np.mean((some > 0.5) == y) >= 0.97


def test_the_fit_holds_no_doubles_of_its_matrix():
    rng = np.random.default_rng(4)
    x, target = rng.random((9000, 200)) < 0.1, rng.random(9000)
    tracemalloc.start()
    weights, bias = toxicity.logistic(x, target, rounds=3)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 2 * x.size * 4  # the matrix of single floats, and less than that again
    w, b = toxicity.logistic(np.repeat(x, 2, axis=0), np.repeat(target, 2), rounds=3)
    assert np.allclose(weights, w, atol=1e-6) and abs(bias - b) < 1e-6


def test_freed_memory_of_the_jvm_goes_back(spark, monkeypatch):
    said = _store.trim_jvm(spark)
    assert said is None or "trim" in said.lower()
    calls = []
    monkeypatch.setattr(_store, "trim_jvm", calls.append)
    _store.tidy(spark)
    assert calls == [spark]


def test_rows_without_a_label_are_sampled_too(spark):
    rows = [(k, f"text {k}", "s") for k in range(40)] + [(7, "a 7", "s"), (None, "x", "s")]
    labels = spark.createDataFrame([(k, k % 2) for k in range(10)] + [(10, None)], "doc_id long, toxic int")
    got = labelled_sample(frame(spark, rows), labels, "toxic", 1, 1, 100, unlabelled=100)
    assert sorted(((r.text, r.y) for r in got.collect()), key=repr) == sorted(
        [("a 7" if k == 7 else f"text {k}", k % 2 if k < 10 else None) for k in range(40)], key=repr
    )
    few = labelled_sample(frame(spark, rows), labels, "toxic", 1, 1, 3, unlabelled=5).collect()
    assert len(few) == 8 and sum(r.y is None for r in few) == 5
    assert labelled_sample(frame(spark, rows), labels.limit(0), "toxic", 1, 1, 3, unlabelled=5).count() == 5


# 4. line dedup


def as_op4(df):
    return df.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@pytest.mark.parametrize("log2", [LOG2, 10])
def test_lines_match_sql(docs, edges, log2):
    assert plain(as_op4(linededup.dedup_lines(docs, log2=log2))) == duck(twins.LINES, docs=edges)


def test_lines_keep_columns(docs, no_docs):
    assert linededup.drop_repeated_lines(docs, log2=LOG2).columns == docs.columns
    assert linededup.drop_repeated_lines(no_docs, log2=LOG2).count() == 0


# 5. language model


def test_lattice_sums_all_segmentations():
    lattice = lm.Lattice([b"a", b"ab", b"b", b"abc", "ö".encode()], np.r_[np.full(256, 0.001), [3.0, 2.0, 1.0, 1.0, 2.0]], 0.2)
    words = [b"a", b"abcab", "öab".encode(), b"ab", b"zz", b"cabcab"]

    def by_hand(w):
        total = 0.0
        for cuts in itertools.product((0, 1), repeat=len(w) - 1):
            edges = [0, *(k + 1 for k, c in enumerate(cuts) if c), len(w)]
            parts = [w[a:b] for a, b in zip(edges, edges[1:])]
            p = 1.0
            for x in parts:
                piece = math.exp(lattice.logs[256 + lattice.pieces.index(x)]) if x in lattice.pieces else 0.0
                p *= piece + (math.exp(lattice.logs[x[0]]) if len(x) == 1 else 0.0)
            total += p
        return math.log(total * 0.2)

    assert np.allclose(lattice.likelihoods(words), [by_hand(w) for w in words])


def test_expected_counts_add_up():
    lattice = lm.Lattice([b"ab", b"b"], np.r_[np.full(256, 0.01), [1.0, 1.0]], 0.2)
    e = lattice.expected([b"abab", b"b"])
    lengths = np.r_[np.ones(256), 2, 1]
    assert abs((e * lengths).sum() - 5) < 1e-9


@pytest.mark.parametrize("head", [3, 1000])
def test_lm_matches_brute_force(spark, docs, edges, head, no_docs):
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    rows = [(i, (t or "").encode().translate(low).split()) for i, t, _ in edges]
    out = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    c = Counter(itertools.chain.from_iterable([*w, "end"] for (_, w), o in zip(rows, out) if not o))
    n, v = sum(c.values()), len(c)
    want = sorted(
        ((i, o, len(w) + 1, sum(c[x] > 0 for x in [*w, "end"]), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in [*w, "end"]), 3)) for (i, w), o in zip(rows, out)),
        key=repr,
    )
    got = lm.score_documents(docs, head=head, rounds=1).collect()
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3)) for r in got), key=repr) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    if head == 3:
        assert lm.score_documents(no_docs).count() == 0


def test_long_words_are_swept_in_sections(monkeypatch):
    """Words swept alone, in sections shorter than a piece too, have the likelihood and the expected counts of the sweep by length."""
    rng = random.Random(6)
    lattice = lm.Lattice([b"a", b"ab", b"b", b"abcabc", b"cab"], np.r_[np.full(256, 0.001), [3.0, 2.0, 1.0, 1.0, 2.0]], 0.2)
    words = [bytes(rng.choice(b"abcx") for _ in range(n)) for n in (1, 64, 65, 65, 66, 200, 700)]
    monkeypatch.setattr(lm, "LONG", 10**9)
    whole, counts = lattice.likelihoods(words), lattice.expected(words)
    for long, section in ((65, 1 << 16), (1, 1 << 16), (1, 7), (1, 3)):
        monkeypatch.setattr(lm, "LONG", long)
        monkeypatch.setattr(lm, "SECTION", section)
        assert np.allclose(lattice.likelihoods(words), whole, rtol=1e-12) and np.allclose(lattice.expected(words), counts, rtol=1e-9)


def test_a_word_of_a_megabyte_takes_seconds(spark):
    rng = random.Random(7)
    word = "".join(rng.choice("etaoinshrdluABC0123456789+/") for _ in range(1 << 20))
    lattice = lm.first_lattice(lm.VOCABULARY)
    began = time.monotonic()
    assert lattice.likelihoods([word.lower().encode()])[0] < -1e6
    assert time.monotonic() - began < 30
    got = lm.score_documents(frame(spark, [(1, f"some words and {word}", "s"), (9, f"{word} again", "s")]), rounds=1).collect()
    assert all(r.score < r.base_score < 0 and math.isfinite(r.score) for r in got) and [r.n_tokens for r in got] == [5, 3]


@pytest.mark.parametrize("word_arcs", [True, False])
def test_document_marginal_by_hand(spark, word_arcs):
    """The score of a document is the sum over all segmentations of its whole text, end included."""
    rows = [(1, "the cat sat", "s"), (2, "the hat", "s"), (3, "a cathat", "s"), (4, None, "s"), (9, "Cat hats 9", "s"), (9, "the the", "s")]
    lattice = lm.first_lattice(lm.VOCABULARY)
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 7 == 2}
    split = [(i, (t or "").lower().split()) for i, t, _ in rows]
    c = Counter(w for i, ws in split if i not in held for w in [*ws, None])
    n, v = sum(c.values()), len(c)
    d = n + v + 2

    def lattice_sum(w):  # over all cuts of the word
        total = 0.0
        for cuts in itertools.product((0, 1), repeat=len(w) - 1):
            edges = [0, *(k + 1 for k, x in enumerate(cuts) if x), len(w)]
            p = math.exp(lattice.log_end)
            for x in (w[a:b] for a, b in zip(edges, edges[1:])):
                piece = math.exp(lattice.logs[256 + lattice.pieces.index(x)]) if x in lattice.pieces else 0.0
                p *= piece + (math.exp(lattice.logs[x[0]]) if len(x) == 1 else 0.0)
            total += p
        return total

    def score(ws):
        out = math.log10((c[None] + 1) / d)
        for w in ws:
            p = lattice_sum(w.encode())
            out += math.log10(c[w] / d + (v + 1) / d * p if word_arcs else (1 - (c[None] + 1) / d) * p)
        return out

    got = lm.score_documents(frame(spark, rows), rounds=0, head=2, word_arcs=word_arcs).collect()
    assert np.allclose(sorted(r.score for r in got), sorted(round(score(ws), 6) for _, ws in split), atol=2e-6)


# 6. decontamination

ITEMS = [(1, "The quick brown fox jumps over the lazy dog again and again"), (2, "short item"), (10, "Short, ITEM!"), (3, "x1"), (4, None), (5, " ,. "), (None, "a b c")]


def leak_docs():
    full = "the quick brown fox jumps over the lazy dog again and again"
    return [
        (1, f"before {full} after", "s"), (2, full.upper(), "s"), (3, "quick brown fox jumps over the lazy dog again and", "s"),
        (4, "a short-item here; short items", "s"), (5, "x1 x2 x1", "s"), (6, None, "s"), (7, "", "s"), (8, "nothing to see " * 4000, "s"),
        (9, "the quick brown fox jumps over the lazy dog again the quick brown fox jumps over the lazy dog again and again", "s"),
        (None, "short item", None), (2, full.upper(), "s"),
    ]


@pytest.mark.parametrize("block_words", [500_000, 4])
def test_decontamination_matches_sql(spark, block_words):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontam.contamination(frame(spark, leak_docs()), items, block_words=block_words)
    got = found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
    assert plain(got) == duck(twins.LEAKS, docs=leak_docs(), items=ITEMS)


def test_decontaminated_texts(spark, docs, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontam.decontaminated(frame(spark, leak_docs()), items)
    assert got.columns == docs.columns
    texts = {r.doc_id: r.text for r in got.collect()}
    assert 1 not in texts and 2 not in texts and texts[7] == "" and texts[6] is None
    assert texts[4] == "a   here; short items" and decontam.decontaminated(frame(spark, leak_docs()), items, max_coverage=1.0).count() == 11
    assert decontam.contamination(no_docs, items).count() == 0
    assert decontam.contamination(docs, items.limit(0)).filter("contaminated").count() == 0


def test_decontamination_takes_one_worker_a_task(spark, docs):
    cut = decontam.decontaminated(docs, spark.createDataFrame([("i", "one two three")], "item_id string, text string"))
    assert cut._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_long_items_are_cut_and_models_held_one_at_a_time(spark):
    """An item of many blocks' words: no automaton passes a block, each task holds one, and the result is that of one block."""
    rng = random.Random(11)
    words = [f"w{rng.randrange(400)}" for _ in range(1500)]
    items = spark.createDataFrame([(1, " ".join(words)), (2, "tail " + " ".join(words[40:60])), (None, "no name but ten words of a passage to be found")], "item_id long, text string")
    rows = [(k, "x " + " ".join(words[k * 25 : k * 25 + 9 + k % 4]) + " y", "s") for k in range(60)] + [(99, " ".join(words), "s")]
    rows += [(100, "here no name but ten words of a passage to be found and then some more words of this document", "s")]
    docs = frame(spark, rows)
    blocks, table = decontam.automata(items, block_words=200)
    models = [pickle.loads(bytes(r.model)) for r in table.collect()]
    assert blocks >= 15 and len(models) > 8 and max(len(m.next) for m in models) < 2 * 400
    assert plain(decontam.contamination(docs, items, block_words=200)) == plain(decontam.contamination(docs, items))
    for block_words in (200, 500_000):
        texts = {r.doc_id: r.text for r in decontam.decontaminated(docs, items, max_coverage=1.0, block_words=block_words).collect()}
        assert texts[100].split()[:2] == ["here", "and"] and texts[99].strip() == ""


# 7. nearest neighbours


def test_neighbours_edge_cases(spark):
    rng = np.random.default_rng(2)
    rows = [(k, rng.normal(size=6).tolist()) for k in range(150)]
    rows += [(200 + k, rows[3][1]) for k in range(30)] + [(100, rows[3][1]), (5, rows[5][1])]
    bad = [(300, None), (400, [0.0] * 6), (None, [1.0] * 6), (301, [float("nan")] * 6), (302, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (303, [1.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows + bad], "vec_id long, embedding array<double>, v string")
    got = {}
    for r in ann.nearest(df, recall=1.01).collect():  # no share short of 1 is enough: exact
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    least = {}
    for i, v in rows:
        b = np.array(v).tobytes()
        least[i] = min(b, least.get(i, b))
    x = {i: np.frombuffer(b) for i, b in least.items()}
    assert set(got) == {0, 100, 200}
    for q in got:
        order = sorted((float(np.sqrt(((x[i] - x[q]) ** 2).sum())), i) for i in x if i != q)[:10]
        assert sorted(got[q]) == [(n, i, pytest.approx(s)) for n, (s, i) in enumerate(order, 1)]
    few = ann.nearest(df.filter("vec_id in (0, 1, 2)")).collect()
    assert [(r.query_id, r["rank"]) for r in few] == [(0, 1), (0, 2)]
    assert ann.nearest(df.limit(0)).count() == 0 and ann.nearest(df.filter("vec_id = 0")).count() == 0


def test_neighbours_among_many_copies(spark):
    rng = np.random.default_rng(4)
    rows = [(k, [1.0] * 8 if k % 20 else rng.normal(size=8).tolist()) for k in range(1000)]
    got = {}
    for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == set(range(0, 1000, 100)) and all(len(set(ids)) == len(ids) == 10 for ids in got.values())


def test_neighbours_recall(spark):
    import pyarrow.parquet as pq

    path = "/root/testdata/sf0.1/embeddings.parquet"
    t = pq.read_table(path)
    ids, x = t["vec_id"].to_numpy(), np.array(t["embedding"].to_pylist(), float)
    got = {}
    for r in ann.nearest(spark.read.parquet(path)).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hit = 0
    for q in np.flatnonzero(ids % 100 == 0):
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        hit += len(got[ids[q]] & set(ids[np.argsort(d)[:10]].tolist()))
    assert hit >= 0.9 * 10 * len(got)


def test_nearest_of_vectors_far_from_the_origin(spark):
    """A common offset of 1e5 with a spread of 1e-3: the expanded square alone would be off by more than the distances."""
    rng = np.random.default_rng(8)
    x = 1e5 + rng.normal(size=(400, 8)) * 1e-3
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = plain(ann.nearest(df, recall=1.01).select("query_id", "rank", "vec_id"))
    want = []
    for q in range(0, 400, 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        near = sorted((i for i in range(400) if i != q), key=lambda i: (d[i], i))[:10]
        want += [(q, r, i) for r, i in enumerate(near, 1)]
    assert got == sorted(want, key=repr)


def test_items_of_null_id_mark_their_words(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    items = spark.createDataFrame([(None, passage)], "item_id long, text string")
    got = decontam.contamination(frame(spark, [(1, f"before {passage} after", "s"), (2, "clean", "s")]), items)
    assert sorted((r.doc_id, r.n_hit, list(r["items"]), r.contaminated) for r in got.collect()) == [(1, 11, [], True), (2, 0, [], False)]


# 8. substring dedup


def brute_spans(rows, length):
    """Removed bytes by document, by trying every window in order."""
    seen, out = set(), {}
    for i, t in sorted((r[:2] for r in rows if r[0] is not None), key=lambda r: r[0]):
        if i in out:
            continue  # a repeated row
        b = (t or "").encode()
        cover = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            if w in seen:
                cover[p : p + length] = b"\1" * length
            seen.add(w)
        out[i] = cover
    return out


@pytest.mark.parametrize("many,log2", [(4096, LOG2), (0, LOG2), (4096, 10)])
def test_substrings_match_brute_force(spark, many, log2, edges):
    rng = random.Random(9)
    pool = ["".join(rng.choice("abcö ") for _ in range(150)) for _ in range(6)]
    rows = list(edges)
    rows += [(100 + k, "".join(rng.choice(pool)[rng.randrange(60) : 150 - rng.randrange(40)] for _ in range(5)), "s") for k in range(40)]
    cover = brute_spans(rows, 100)
    got = substring.dedup_substrings(frame(spark, rows), many=many, log2=log2).collect()
    assert len(got) == len(rows)
    texts = {}
    for i, t, _ in rows:
        texts.setdefault(i, t)
    for r in got:
        if r.doc_id is None:
            assert r.spans == [] and len(r.kept) == r.n_bytes
            continue
        b, c = (texts[r.doc_id] or "").encode(), cover[r.doc_id]
        assert bytes(r.kept) == bytes(x for x, gone in zip(b, c) if not gone), r.doc_id
        assert sum(s["end"] - s["start"] for s in r.spans) == sum(c)


def test_substring_tables_go_when_they_are_read(spark, edges, monkeypatch):
    """Segments are gone before their bytes are fetched, and only spans stay for the last join."""
    root, there = tempfile.mkdtemp(prefix="jf-test-"), {}
    write = substring.written

    def written(df, name, rows=None):
        there[name] = {k for k in os.listdir(root) if os.listdir(f"{root}/{k}")}
        return write(df, name, rows)

    monkeypatch.setattr("junctionflow.llm._store.scratch_path", lambda _, *parts: f"{root}/{parts[-1]}/{uuid.uuid4().hex}")
    monkeypatch.setattr(substring, "written", written)
    docs = frame(spark, [(i, t, s) for i, t, s in edges])
    want = plain(substring.dedup_substrings(docs, log2=LOG2, many=2))
    assert there["segment-bytes"] <= {"segment-classes", "repeated-spans"}
    assert {k for k in os.listdir(root) if os.listdir(f"{root}/{k}")} == {"repeated-spans", "ordered-spans", "grouped-spans"}
    assert want == plain(substring.dedup_substrings(docs, log2=LOG2))


def test_substrings_of_nothing(no_docs):
    assert substring.dedup_substrings(no_docs, log2=LOG2).count() == 0


def test_deep_shallow_order():
    rng = random.Random(4)
    for _ in range(300):
        base = bytes(rng.choices(b"ab", k=60))
        s = [base[: rng.randint(0, 60)] + bytes(rng.choices(b"ab\x00\xff", k=rng.randint(0, 6))) for _ in range(rng.randint(1, 40))]
        assert [s[i] for i in deep_shallow_order(s)] == sorted(s)


# 9. line hashing


def removed_by_hand(rows, length=100):
    """Kept bytes of each row, as the contract says; rows of one id share their ranks."""
    first, texts = {}, [(i, (t or "").encode()) for i, t, _ in rows]
    for i, t in texts:
        for p in range(len(t) - length + 1) if i is not None else ():
            w = t[p : p + length]
            first[w] = min(first.get(w, (i, p)), (i, p))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - length + 1) if i is not None else ():
            if first[t[p : p + length]] < (i, p):
                gone[p : p + length] = True
        out.append((i, bytes(np.frombuffer(t, np.uint8)[~gone])))
    return sorted(out, key=repr)


def test_substrings_of_texts_that_share_an_id(spark):
    rng = random.Random(21)
    a, b, c = (prose(rng, 60) for _ in range(3))
    rows = [(1, a, "s"), (2, a, "s"), (2, b, "s"), (2, b, "s"), (3, c + a[10:180], "s"), (3, a[:150] + c, "s"), (4, b[20:] + c, "s"), (4, "x" + c, "s")]
    got = sorted(((r.doc_id, bytes(r.kept)) for r in substring.dedup_substrings(frame(spark, rows), log2=LOG2).collect()), key=repr)
    assert got == removed_by_hand(rows) and (2, b.encode()) in got
    few = substring.dedup_substrings(frame(spark, rows), log2=LOG2, many=1)
    assert sorted(((r.doc_id, bytes(r.kept)) for r in few.collect()), key=repr) == got


def test_substrings_of_a_text_longer_than_a_piece(spark):
    rng = np.random.default_rng(5)
    long = "".join(map(chr, rng.integers(97, 123, 1_300_000)))
    part = long[524_200:524_600]  # across the border of the first piece
    rows = [(1, long, "s"), (2, "head " + part + " tail", "s"), (3, long[:1000] + long, "s"), (4, long[700_000:1_250_000], "s")]
    got = {r.doc_id: bytes(r.kept).decode() for r in substring.dedup_substrings(frame(spark, rows), log2=LOG2).collect()}
    assert got == {1: long, 2: "head  tail", 3: "", 4: ""}


def digested(found):
    return found.select(
        "doc_id", F.size("removed").cast("long").alias("n_removed"),
        F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("removed_chars"),
        F.array_join(F.transform("removed", lambda s: F.concat_ws("-", s["start"], s["end"])), ",").alias("removed"),
        "n_units", F.sha2("kept", 256).alias("kept_sha256"),
    )


def test_units_match_sql(docs, edges, no_docs):
    assert plain(digested(units.dedup_units(docs))) == duck(twins.UNITS, docs=edges)
    assert units.dedup_units(no_docs).count() == 0


def test_short_lines_and_lines_without_spaces_are_units(spark):
    short, cjk = "Licensed under this license.", "\u4eca\u65e5\u306f\u826f\u3044\u5929\u6c17"
    rows = [(k, f"{short}\nown line {k}\n{cjk}\n\n", "s") for k in range(4)]
    got = {r.doc_id: r.kept for r in units.dedup_units(frame(spark, rows)).collect()}
    assert got == {0: rows[0][1], **{k: f"own line {k}\n\n" for k in (1, 2, 3)}}


def test_passages_are_found_wherever_they_stand(spark):
    """Passages of over 50 words as a line, as a paragraph of lines, and inside a longer line; clean texts stay."""
    rng = random.Random(11)

    def sentence(n):
        return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n)).capitalize() + "."

    passage = " ".join(sentence(12) for _ in range(5))
    lines = "\n".join(sentence(15) for _ in range(4))

    def text(middle):
        return f"{sentence(9)} {sentence(9)}{middle}{sentence(9)}\n{sentence(20)}"

    rows = [(k, text(f"\n{passage}\n"), "as a line") for k in range(3)] + [(10 + k, text(f"\n{lines}\n"), "as lines") for k in range(3)]
    rows += [(20 + k, text(f" {passage} "), "inside") for k in range(3)] + [(30 + k, text(" " + sentence(60) + " "), "clean") for k in range(20)]
    got = {r.doc_id: r for r in units.dedup_units(frame(spark, rows)).collect()}
    source = {i: s for i, _, s in rows}
    assert {i for i, r in got.items() if r.removed} == {1, 2, 11, 12, 20, 21, 22}
    for i, r in got.items():
        own = dict((k, t) for k, t, _ in rows)[i]
        assert (passage.split(". ")[2] in r.kept) == (passage.split(". ")[2] in own and i == 0) and (source[i] != "clean" or r.kept == own)
        gone = sum(s["end"] - s["start"] for s in r.removed)
        assert len(r.kept) >= len(own) - gone - own.count("\n") and gone in (0, len(passage), len(passage) + 1, len(lines) - 3)


def test_texts_that_share_an_id_are_cut_each_by_its_own_units(spark):
    a, b, own = "a line that many hold", "another line that many hold", "a line of this text alone"
    rows = [(1, f"{a}\n{b}", "s"), (2, f"{a}\nx", "s"), (2, f"{own}\ny", "s"), (2, f"{own}\ny", "s"), (3, f"{b}\n{own}", "s")]
    got = sorted((r.doc_id, r.kept) for r in units.dedup_units(frame(spark, rows)).collect())
    assert got == sorted([(1, f"{a}\n{b}"), (2, "x"), (2, f"{own}\ny"), (2, f"{own}\ny"), (3, "")])
    assert plain(digested(units.dedup_units(frame(spark, rows)))) == duck(twins.UNITS, docs=rows)


def test_lines_only(spark):
    rows = [(1, "One long sentence that stands in two texts of this set. And more.", "s"), (2, "One long sentence that stands in two texts of this set. But less.", "s")]
    assert [r.removed for r in units.dedup_units(frame(spark, rows), sentence=None).collect()] == [[], []]
    assert sorted(len(r.removed) for r in units.dedup_units(frame(spark, rows)).collect()) == [0, 1]


def test_paragraph_offsets(spark):
    para = "one two three four five six seven eight\nnine"
    rows = [(1, f"{para}\n\nother words that are not repeated anywhere at all", "s"), (2, f"head\n\n{para.upper()}\n\ntail", "s")]
    got = {r.doc_id: r for r in units.dedup_units(frame(spark, rows), separator="\n\n").collect()}
    assert got[1].removed == [] and got[2].kept == "head\n\ntail"
    s = got[2].removed[0]
    assert rows[1][1][s["start"] : s["end"]] == para.upper()


# 10. quality


def test_quality_held_out(labelled):
    docs, labels = labelled
    got = quality.score_documents(docs, labels)
    rows = got.join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.97
    assert {r.quality for r in rows} == {0, 1}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got.collect())


def test_labelled_sample_has_one_row_an_id(spark):
    rows = [(1, f"text {k}", "s") for k in range(300)] + [(k, f"other {k}", "s") for k in range(2, 30)] + [(30, None, "s"), (30, "b", "s"), (31, None, "s")]
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 32)], "doc_id long, toxic int")
    got = labelled_sample(frame(spark, rows), labels, "toxic", 1, 1, 31)
    assert plain(got) == sorted([("text 0", 1), *((f"other {k}", k % 2) for k in range(2, 30)), ("b", 0), (None, 1)], key=repr)
    assert labelled_sample(frame(spark, rows), labels, "toxic", 1, 1, 7).count() == 7


def test_quality_edges(spark, labelled, no_docs):
    docs, labels = labelled
    rows = score_cases(spark, lambda d: quality.score_documents(d, labels))
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in quality.score_documents(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.score_documents(no_docs, labels).count() == 0


