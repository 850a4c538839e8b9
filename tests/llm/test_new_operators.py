"""Chat formatting, hard negatives and whitening against SQL, brute force and exact round trips."""

from __future__ import annotations

import hashlib
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from junctionflow.llm import catalog, chat, negatives, twins, whitening

from .conftest import plain

NAN, INF = float("nan"), float("inf")


# 11. hard negatives


def vectors(seed=1, n=420, dim=12):
    """Random vectors with copies, equal scores, zero vectors and rows that take no part."""
    rng = np.random.default_rng(seed)
    rows = [(int(i), rng.normal(size=dim).round(2).tolist(), int(i * 7 % 3)) for i in range(1, n)]
    hub = rows[99][1]
    rows += [(1000 + i, hub, 1) for i in range(60)] + [(2000 + i, [v * 0.75 for v in hub], 2) for i in range(40)]
    rows += [(3000, [0.0] * dim, 1), (3050, [-v for v in hub], 1), (3100, [1.0, 2.0], 1), (3150, None, 1), (3200, [None] * dim, 1)]
    rows += [(3250, [NAN] * dim, 1), (3300, [INF] * dim, 1), (3350, hub, None), (None, hub, 1), (3400, [], 1), (3450, hub, 77)]
    rows += [rows[49], (100, hub, 2), (-50, hub, 0)]
    return rows


def vector_frame(spark, rows):
    return spark.createDataFrame([(*r, "?", "?") for r in rows], "vec_id long, embedding array<double>, label int, score string, x string").repartition(3)


def mined_by_hand(rows, dim=12, positives=5, count=3):
    kept = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or len(v) != dim or not all(c is not None and np.isfinite(c) for c in v):
            continue
        row = (label, [int(np.floor(256 * c)) for c in v])
        kept[i] = min(kept.get(i, row), row, key=lambda r: (r[0], np.array(r[1], float).tobytes()))
    out = []
    for a, (label, x) in kept.items():
        if a % 50:
            continue
        scores = {i: sum(p * q for p, q in zip(x, y)) for i, (_, y) in kept.items() if i != a}
        ranked = sorted(scores, key=lambda i: (-scores[i], i))
        for p in [i for i in ranked if kept[i][0] == label][:positives]:
            inside = [i for i in ranked if kept[i][0] != label and 50 * scores[p] <= 100 * scores[i] <= 95 * scores[p]]
            out += [(a, i, scores[i], p, scores[p], r) for r, i in enumerate(inside[:count], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [8192, 50])
def test_negatives_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "SAMPLE", 100)
    monkeypatch.setattr(negatives, "GROUP", 4)
    rows = vectors()
    got = plain(negatives.hard_negatives(vector_frame(spark, rows)))
    assert len(got) > 20 and got == mined_by_hand(rows)


def test_negatives_of_very_large_numbers(spark):
    """Scores beyond 2**53 stay exact."""
    rng = np.random.default_rng(4)
    rows = [(int(i), (rng.integers(1, 2**28, 6) / 256).tolist(), int(i) % 2) for i in range(0, 120)]
    rows[50] = (50, [5e5] * 6, 0)
    assert plain(negatives.hard_negatives(vector_frame(spark, rows))) == mined_by_hand(rows, dim=6)
    rows = [(i, [1e300, -1e300], i % 2) for i in range(60)]
    assert negatives.hard_negatives(vector_frame(spark, rows)).count() >= 0


def test_negatives_match_sql(spark):
    d = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{d}/embeddings.parquet'")
    df = catalog.op11_hard_negatives(spark, d)
    want = con.execute(f"SELECT {', '.join(sorted(df.columns))} FROM ({twins.SQL['op11_hard_negatives']})").fetchall()
    assert plain(df) == sorted(want, key=repr)


def test_no_negatives(spark):
    assert negatives.hard_negatives(vector_frame(spark, [])).columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert negatives.hard_negatives(vector_frame(spark, [])).count() == 0
    assert negatives.hard_negatives(vector_frame(spark, [(50, [1.0], 1), (51, [1.0], 2)])).count() == 0


def test_index_leaves_out_covered_dimensions():
    """A high threshold leaves most of the tail out, and no pair is lost."""
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(500, 32)) * 100 / np.arange(1, 33))
    index = negatives.Postings(x, np.arange(32))
    a = x[:40]
    for low in (-(10.0**6), 0.0, 4000.0, 20_000.0):
        who, rows, scores = index.reach(a, np.full(40, low))
        full = a @ x.T
        assert sorted(zip(who, rows, scores)) == sorted((i, j, full[i, j]) for i, j in zip(*np.nonzero(full >= low)))


# 12. chat formatting

CONTROL = ["\\", "#", "##", "###", "####", "### user: ", "</turn>", "</turn>\n", "<\\/turn>", "<", "\n", ":", "é\U0001f600", "\\\\", ""]


def texts(rng, n):
    return ["".join(rng.choice(CONTROL + ["word "]) for _ in range(rng.randrange(8))) for _ in range(n)]


def test_template_round_trip():
    rng = random.Random(1)
    for _ in range(300):
        turns = list(zip(rng.choices([*texts(rng, 3), "assistant", "user"], k=5), texts(rng, 5)))
        formatted, spans = chat.render(turns)
        assert list(chat.read_back(formatted)) == turns
        assert [chat.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
        assert formatted.count("</turn>") == formatted.count("### ") == 5


def log(seed=3, conversations=30, longest=60):
    """Events (conv_id, seq, message, kind, role, text) in no order."""
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(conversations)]:
        size = 3000 if conv == 5 else rng.randrange(longest)
        for seq in range(size):
            kind = rng.choice(["open", "delta", "delta", "delta", "edit", "regenerate", None, "seen"])
            role = rng.choice([None, "user", "assistant", "system"])
            rows.append((conv, seq, rng.choice([None, *range(max(1, size // 5))]), kind, role, rng.choice([None, *texts(rng, 3)])))
    rng.shuffle(rows)
    return rows


def folded_by_hand(rows):
    out = {}
    for conv, _, message, kind, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        m = out.setdefault(conv, {}).setdefault(message, [None, ""])
        m[0] = m[0] if m[0] is not None else role
        if kind in ("edit", "regenerate"):
            m[1] = ""
        if kind in ("edit", "delta"):
            m[1] += text or ""
    return {c: [(r or "", t) for r, t in ms.values()] for c, ms in out.items()}


def rebuilt(parts):
    got = {}
    for r in sorted(parts.collect(), key=lambda r: r.part):
        got.setdefault(r.conv_id, []).extend(chat.read_back(r.formatted))
        spans = [chat.unescape(r.formatted[s.start : s.end]) for s in r.loss]
        assert spans == [t for role, t in chat.read_back(r.formatted) if role == "assistant"]
    return got


@pytest.mark.parametrize("ranges", [1, 7])
def test_log_is_folded_in_pieces(spark, ranges):
    """Messages that go on over several ranges, edits and regenerations after a border, a conversation over many ranges."""
    rows = log()
    events = spark.createDataFrame([(*r, "?") for r in rows], "conv_id long, seq long, message long, kind string, role string, text string, place string").repartition(3)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = chat.format_conversations(events)
        want = folded_by_hand(rows)
        assert rebuilt(parts) == want
        got = {r.conv_id: r for r in chat.digests(parts).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert set(got) == set(want)
    for conv, turns in want.items():
        learned = "".join(t for r, t in turns if r == "assistant")
        assert got[conv].n_turns == len(turns) and got[conv].loss_chars == len(learned)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[conv].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
        assert got[conv].formatted_chars == len(chat.render(turns)[0])


def test_long_conversations_come_in_parts(spark, monkeypatch):
    rows = [(1, k, k, "delta", "assistant", "x" * 700_000) for k in range(4)] + [(0, 0, 0, "delta", "user", "y" * 3_000_000), (2, 0, 0, "delta", "user", "z")]
    events = spark.createDataFrame(rows, "conv_id long, seq long, message long, kind string, role string, text string").coalesce(1)
    parts = chat.format_conversations(events)
    assert rebuilt(parts) == folded_by_hand(rows)
    assert {r.conv_id: (r.n_turns, r.loss_chars) for r in chat.digests(parts).collect()} == {0: (1, 0), 1: (4, 2_800_000), 2: (1, 0)}


def test_turns_match_sql(spark):
    rng = random.Random(9)
    rows = [(c, rng.choice([None, 0, 1, 2, 3]), rng.choice([None, "user", "assistant", "a:b"]), rng.choice([None, *texts(rng, 4)])) for c in [None, *range(12)] for _ in range(rng.randrange(1, 9))]
    rows += rows[:5]
    turns = spark.createDataFrame([(*r, "?") for r in rows], "conv_id long, turn long, role string, text string, message string").repartition(3)
    got = chat.digests(chat.format_conversations(chat.events_of_turns(chat.with_quoting(spark, turns))))
    con = duckdb.connect()
    table = pa.table({n: pa.array([r[k] for r in rows], t) for k, (n, t) in enumerate([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])})
    con.register("turns", table)
    want = con.execute(f"SELECT {', '.join(sorted(got.columns))} FROM ({twins.CHATS.replace('{turns}', 'turns')})").fetchall()
    assert plain(got) == sorted(want, key=repr)
    assert rebuilt(chat.format_conversations(chat.events_of_turns(turns.limit(0)))) == {}


# 13. whitening


def whitened_by_hand(rows, most=16, copies=False):
    grid = [(i, tuple(int(np.floor(64 * c)) + 1_000_000 for c in v)) for i, v, *_ in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    dims = [len(x) for _, x in grid]
    dim = max(set(dims), key=lambda d: (dims.count(d), d))
    grid = [(i, x) for i, x in grid if len(x) == dim]
    fit = [x for _, x in grid] if copies else sorted({x for _, x in grid})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for x in fit])
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:most], u[:, ::-1][:, :most]
    out = {}
    for i, x in grid:
        z = np.array([(n * c - s) / n for c, s in zip(x, sums)]) @ u / np.sqrt(e)
        out.setdefault(i, []).append((n, sum((n * c - s) ** 2 for c, s in zip(x, sums)), z, e / np.trace(v)))
    return out


@pytest.mark.parametrize("weights", ["one", "copies"])
def test_whitening_matches_brute_force(spark, weights):
    rows = [(i, [c * (k + 1) for k, c in enumerate(v)] if v and len(v) == 12 and v[0] is not None else v, label) for i, v, label in vectors()]
    got = whitening.whiten(vector_frame(spark, rows), components=5, weights=weights).collect()
    want = whitened_by_hand(rows, 5, weights == "copies")
    assert sorted({r.vec_id for r in got}, key=repr) == sorted(want, key=repr)
    assert len(got) == 5 * sum(len(v) for v in want.values())
    signs = {}
    for r in got:
        close = [w for w in want[r.vec_id] if w[0] == r.n and w[1] == r.deviation and abs(abs(w[2][r.component - 1]) - abs(r.whitened)) < 1e-9]
        assert close and abs(close[0][3][r.component - 1] - r.explained) < 1e-12 and r.identity_error < 1e-9
        if abs(r.whitened) > 1e-6:
            signs.setdefault(r.component, set()).add(np.sign(r.whitened * close[0][2][r.component - 1]))
    assert all(len(s) == 1 for s in signs.values())


def test_whitening_edges(spark):
    empty = whitening.whiten(vector_frame(spark, []))
    assert empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and empty.count() == 0
    assert whitening.whiten(vector_frame(spark, [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)])).count() == 0
    assert whitening.whiten(vector_frame(spark, [(1, [], 1)])).count() == 0
    line = whitening.whiten(vector_frame(spark, [(i, [float(i), 2.0 * i, 1.0], 1) for i in range(9)])).collect()
    assert {r.component for r in line} == {1} and abs(line[0].explained - 1) < 1e-12  # the flat components are left out
    huge = whitening.whiten(vector_frame(spark, [(i, [1e300 * (-1) ** i, 1e13 + i], 1) for i in range(6)])).collect()
    assert {r.vec_id for r in huge} == set(range(6)) and all(r.deviation is None for r in huge)
