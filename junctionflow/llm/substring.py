"""Exact substring dedup: a sampled suffix array, sorted by deep-shallow sorting.

Every window of ``length`` bytes has one anchor, the position of the least hash
among its SEED-byte grams; equal windows have it at the same place. Neighbouring
windows of one anchor make a segment. A counting sketch of all anchors tells
which may occur twice; only their segments are shuffled, as digests:

1. Equal segments are grouped. All but the first occurrence are repeated whole.
2. Different segments around equal anchors can still share windows. Their first
   occurrences fetch their bytes, and per anchor the suffixes to the right of the
   anchor and the reversed texts to its left are ordered by deep-shallow sorting.
   A window that reaches o bytes to the left is given by the run of right
   suffixes with a common prefix of length - o and the run of left texts with a
   common prefix of o; the earliest window of each such pair of runs is kept.
3. Anchors with very many different segments skip the sort: their windows are
   grouped by digest with partial aggregates, so no anchor needs one task.

Removed spans of a document are then applied to its text in one join.

Cases: null texts are empty; texts under ``length`` bytes lose nothing; rows
without an id are neither compared nor cut; rows that share an id and a text are
one text, so that a span is cut from each of them; rows that share an id with
different texts are cut each by its own spans (strings that start at one place
in several of them all stay); very long texts are hashed and cut in regions; an
empty table gives an empty result; only doc_id and text are read, other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._bytes import MULT, PIECE, U64, column_bytes, doc_groups, mix, prefix_hash, range_hash
from ._deepshallow import common_prefix, deep_shallow_order
from ._sketch import broadcast, count_levels, using
from ._store import Scratch, discard, tidy, written

LENGTH, SEED = 100, 32
#: Slots of the sketch, as a power of 2.
LOG2 = 27
#: Different segments of one anchor from which on its windows are grouped instead of sorted.
MANY = 4096
#: Segments that a task orders together (always whole anchors).
TOGETHER = 20_000
SPAN = "doc_id long, lo int, hi int, off int, g long"
SEGMENT = "h long, g long, doc_id long, s int, off int, n int"
_INDEX = U64((1 << 22) - 1)


def _segments(buf: np.ndarray, cuts: np.ndarray, length: int) -> tuple[np.ndarray, ...] | None:
    """(document, first window, last window, anchor, anchor hash, digest) of each segment in a piece of text."""
    n = len(buf) - length + 1
    if n <= 0:
        return None
    prefix = prefix_hash(buf)
    at = np.arange(len(buf) - SEED + 1)
    x = range_hash(prefix, at, at + SEED)
    low = (x & ~_INDEX) | at.astype(U64)
    span, have = length - SEED + 1, 1
    while 2 * have <= span:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < span:
        low = np.minimum(low[: len(low) - (span - have)], low[span - have :])
    anchor = (low[:n] & _INDEX).astype(np.int64)
    inner = cuts[1:-1]
    bad = np.zeros(n + 1, np.int64)
    np.add.at(bad, np.clip(inner - length + 1, 0, n), 1)
    np.add.at(bad, np.clip(inner, 0, n), -1)
    p = np.flatnonzero(np.cumsum(bad[:-1]) == 0)
    if not len(p):
        return None
    a = anchor[p]
    new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (p[1:] != p[:-1] + 1)])
    first, last, a = p[new], p[np.r_[new[1:] - 1, len(p) - 1]], a[new]
    digest = _digest(range_hash(prefix, first, last + length), a - first)
    return np.searchsorted(cuts, first, "right") - 1, first, last, a, x[a], digest


def segments(col, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, first window, last window, anchor, anchor hash, digest) by document offsets, for runs of documents."""
    data, offsets = column_bytes(col)
    for lo, hi in doc_groups(offsets):
        base, size = int(offsets[lo]), int(offsets[hi] - offsets[lo])
        for at in range(0, max(size - length + 1, 1), PIECE) if size > PIECE else (0,):
            end = min(size, at + PIECE + length - 1) if size > PIECE else size
            cuts = offsets[lo : hi + 1] - base if size <= PIECE else np.array([0, end - at])
            found = _segments(data[base + at : base + end], cuts, length)
            if found:
                doc, first, last, a, h, g = found
                shift = at - cuts[doc]
                yield doc + lo, first + shift, last + shift, a + shift, h, g


def _digest(h: np.ndarray, off: np.ndarray) -> np.ndarray:
    """What tells a segment: the hash of its bytes and the place of its anchor."""
    return mix(h + np.asarray(off).astype(U64) * MULT[50])


def _spans_of(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """SPAN rows of windows of repeated segments: all but the first of each class.

    Both sides are stored tables, so that the join has a plain shuffle on both sides and a hot segment's partition can be split.
    """
    c = classes.filter("times > 1").select(F.col("h").alias("ch"), F.col("g").alias("cg"), "first")
    later = rows.join(c, (F.col("h") == F.col("ch")) & (F.col("g") == F.col("cg"))).filter(F.struct("doc_id", "s") > F.col("first"))
    return later.select("doc_id", F.col("s").alias("lo"), (F.col("s") + F.col("n")).alias("hi"), rows["off"], rows["g"])


def _fetched(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(h, doc_id, s, off, n, k, body): wanted segments with their bytes."""
    lists = wanted.groupBy(F.col("doc_id").alias("id")).agg(F.collect_list(F.struct("h", "g", "s", "off", "n", "k")).alias("wants"))
    rows = packed_texts(docs).join(lists, F.col("doc_id") == F.col("id")).select("doc_id", "body", "wants")
    schema = "h long, doc_id long, s int, off int, n int, k long, body binary"

    def cut(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for doc, body, wants in zip(*(batch.column(i) for i in range(3))):
                text = unpack.decompress(body.as_buffer())
                done = set()
                for w in wants.as_py():
                    # Rows that share an id repeat each other's wishes; the digest tells whether this text is meant.
                    part = text[w["s"] : w["s"] + w["n"] + length - 1]
                    if (w["s"], w["g"]) in done or len(part) < w["n"] + length - 1 or not _same(part, w["off"], w["g"]):
                        continue
                    done.add((w["s"], w["g"]))
                    for o, v in zip(out, (w["h"], doc.as_py(), w["s"], w["off"], w["n"], w["k"], part)):
                        o.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
            yield pa.record_batch([pa.array(o, t) for o, t in zip(out, kinds)], names=["h", "doc_id", "s", "off", "n", "k", "body"])

    return rows.mapInArrow(cut, schema).dropDuplicates(["h", "doc_id", "s", "off", "n"])


def _hash_of(part: bytes) -> np.ndarray:
    return range_hash(prefix_hash(np.frombuffer(part, np.uint8)), np.zeros(1, np.int64), np.array([len(part)]))


def _same(part: bytes, off: int, g: int) -> bool:
    """Whether these are the bytes of the segment with digest g."""
    return int(_digest(_hash_of(part), np.array([off])).view(np.int64)[0]) == g


def packed_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, body): texts compressed for the shuffle."""

    def pack(batches):
        c = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = (t.as_buffer() if t.is_valid else b"" for t in batch.column(1))
            yield pa.record_batch([batch.column(0), pa.array([c.compress(t) for t in texts], pa.binary())], names=["doc_id", "body"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(pack, "doc_id long, body binary")


def _runs(keys: np.ndarray, strings: list[bytes], starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of each string in deep-shallow order within its anchor, common prefix with the one before)."""
    place, lcp = np.empty(len(keys), np.int64), np.zeros(len(keys), np.int64)
    for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist()):
        group = strings[lo:hi]
        order = deep_shallow_order(group)
        for j, m in enumerate(order):
            place[lo + m] = lo + j
            lcp[lo + j] = common_prefix(group[order[j - 1]], group[m]) if j else -1
    return place, lcp


def shared_windows(h, doc, s, off, n, body, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, window) of every window that also starts earlier in another row of its anchor; rows sorted by h, whole anchors."""
    starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1], True])
    right = [b[o + SEED :] for b, o in zip(body, off.tolist())]
    left = [b[:o][::-1] for b, o in zip(body, off.tolist())]
    place_r, lcp_r = _runs(h, right, starts)
    place_l, lcp_l = _runs(h, left, starts)
    by_place = np.lexsort((s, doc))  # earliest first
    rank = np.empty(len(h), np.int64)
    rank[by_place] = np.arange(len(h))
    rows, windows = [], []
    for o in range(int(off.max()) + 1):
        members = np.flatnonzero((o <= off) & (o > off - n))
        if len(members) < 2:
            continue
        run_r = np.cumsum(lcp_r < length - SEED - o)[place_r[members]]
        run_l = np.cumsum(lcp_l < o)[place_l[members]]
        order = np.lexsort((rank[members], run_l, run_r))
        again = (np.diff(run_r[order], prepend=-1) == 0) & (np.diff(run_l[order], prepend=-1) == 0)
        late = members[order[again]]
        rows.append(late)
        windows.append(s[late] + off[late] - o)
    return (np.concatenate(rows), np.concatenate(windows)) if rows else (np.empty(0, np.int64),) * 2


def _as_spans(rows: np.ndarray, windows: np.ndarray, doc: np.ndarray, s: np.ndarray, body: list[bytes], length: int) -> pa.RecordBatch:
    order = np.lexsort((windows, rows))
    r, w = rows[order], windows[order]
    new = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (w[1:] != w[:-1] + 1)]) if len(r) else np.empty(0, np.int64)
    last = np.r_[new[1:] - 1, len(r) - 1] if len(r) else new
    own, lo, hi = r[new], w[new], w[last] + 1
    parts = (body[k][a - o : b - o + length - 1] for k, a, b, o in zip(own.tolist(), lo.tolist(), hi.tolist(), s[own].tolist()))
    marks = [int(_digest(_hash_of(p), np.zeros(1, np.int64)).view(np.int64)[0]) for p in parts]
    cols = [pa.array(doc[own], pa.int64()), pa.array(lo, pa.int32()), pa.array(hi, pa.int32()), pa.array([0] * len(own), pa.int32()), pa.array(marks, pa.int64())]
    return pa.record_batch(cols, names=["doc_id", "lo", "hi", "off", "g"])


def _sorted_spans(fetched: DataFrame, length: int) -> DataFrame:
    def order(batches):
        held: list[pa.RecordBatch] = []

        def run(table: pa.Table):
            h, doc, s, off, n = (table.column(i).to_numpy() for i in range(5))
            body = table.column(6).to_pylist()
            return _as_spans(*shared_windows(h, doc, s, off, n, body, length), doc, s, body, length)

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= TOGETHER:
                table = pa.Table.from_batches(held)
                h = table.column(0).to_numpy()
                whole = int(np.searchsorted(h, h[-1]))  # the last anchor may go on
                if whole:
                    yield run(table.slice(0, whole))
                held = table.slice(whole).combine_chunks().to_batches()
        if held and sum(b.num_rows for b in held):
            yield run(pa.Table.from_batches(held))

    rows = fetched.repartition("h").sortWithinPartitions("h")
    return rows.mapInArrow(order, SPAN)


def _grouped_spans(fetched: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many segments, by grouping window digests."""

    def explode(batches):
        for batch in batches:
            for _, doc, s, _, n, _, body in zip(*(batch.column(i).to_pylist() for i in range(7))):
                prefix = prefix_hash(np.frombuffer(body, np.uint8))
                at = np.arange(n)
                a = range_hash(prefix, at, at + length)
                b = mix(range_hash(prefix, at, at + length // 2) + MULT[51])
                w = _digest(a, np.zeros(n, np.int64))
                cols = a.view(np.int64), b.view(np.int64), np.full(n, doc), (s + at).astype(np.int32), w.view(np.int64)
                yield pa.record_batch([pa.array(c) for c in cols], names=["a", "b", "doc_id", "p", "w"])

    windows = written(fetched.mapInArrow(explode, "a long, b long, doc_id long, p int, w long"), "windows")
    first = windows.groupBy("a", "b").agg(F.min(F.struct("doc_id", "p")).alias("first"), F.count("*").alias("times")).filter("times > 1")
    f = written(first.toDF("fa", "fb", "first", "times"), "repeated-windows")
    late = windows.join(f, (F.col("a") == F.col("fa")) & (F.col("b") == F.col("fb"))).filter(F.struct("doc_id", "p") > F.col("first"))
    spans = written(late.select("doc_id", F.col("p").alias("lo"), (F.col("p") + 1).alias("hi"), F.lit(0).alias("off"), F.col("w").alias("g")), "grouped-spans")
    discard(windows, f)
    return spans


def repeated_spans(docs: DataFrame, length: int = LENGTH, log2: int = LOG2, many: int = MANY) -> DataFrame:
    """SPAN rows: starts lo <= p < hi of windows that also start earlier; not merged.

    ``g`` tells the bytes from lo to the end of the last window (with ``off``, see :func:`_digest`): rows may share an id.
    """
    slim = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with Scratch() as sketch:
        levels = broadcast(docs, count_levels(slim, lambda b: (x[4] for x in segments(b.column(1), length)), log2=log2, probes=2))

    def suspects(seen, batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for doc, first, last, a, h, g in segments(batch.column(1), length):
                k = np.flatnonzero(seen.of(h))
                cols = (
                    h[k].view(np.int64), g[k].view(np.int64), ids[doc[k]], first[k].astype(np.int32),
                    (a - first)[k].astype(np.int32), (last - first + 1)[k].astype(np.int32),
                )
                yield pa.record_batch([pa.array(c) for c in cols], names=["h", "g", "doc_id", "s", "off", "n"])

    # Each table goes when it is read, and with it the shuffles it was made by: segments before their bytes are fetched.
    rows = written(slim.mapInArrow(using(levels, suspects), SEGMENT), "segments")
    sketch.release(docs.sparkSession)
    classes = written(
        rows.groupBy("h", "g").agg(
            F.min(F.struct("doc_id", "s")).alias("first"), F.first("off").alias("off"), F.first("n").alias("n"), F.count("*").alias("times")
        ),
        "segment-classes",
    )
    tidy(docs.sparkSession)
    whole = written(_spans_of(rows, classes), "repeated-spans")
    discard(rows)
    anchors = classes.groupBy("h").agg(F.count("*").alias("k")).filter("k > 1")
    wanted = classes.join(anchors, "h").select("h", "g", "first.doc_id", "first.s", "off", "n", "k")
    fetched = written(_fetched(docs, wanted, length), "segment-bytes")
    discard(classes)
    ordered = written(_sorted_spans(fetched.filter(F.col("k") <= many), length), "ordered-spans")
    grouped = _grouped_spans(fetched.filter(F.col("k") > many), length)
    discard(fetched)
    return whole.unionByName(ordered).unionByName(grouped)


def own_spans(text: bytes, start: np.ndarray, end: np.ndarray, off: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Positions of the spans whose bytes stand in this text (rows that share an id get each other's spans)."""
    order = np.argsort(start, kind="stable")
    order = order[end[order] <= len(text)]
    buf, out, k = np.frombuffer(text, np.uint8), [], 0
    while k < len(order):  # hashed a region at a time, however long the text
        at = int(start[order[k]])
        m = max(k + 1, int(np.searchsorted(start[order], at + PIECE)))
        some = order[k:m]
        prefix = prefix_hash(buf[at : int(end[some].max())])
        h = range_hash(prefix, (start[some] - at).astype(np.int64), (end[some] - at).astype(np.int64))
        out.append(some[_digest(h, off[some]) == g[some].view(U64)])
        k = m
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def dedup_substrings(docs: DataFrame, length: int = LENGTH, **params) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): removed byte spans [start, end) and the remaining bytes of every row.

    Removes each byte covered by a string of ``length`` bytes that also starts
    earlier: in a document with a smaller id, or earlier in the same document.
    """
    # Dealt by document only here, so that a hot segment's join partition can be split.
    spans = repeated_spans(docs, length, **params).repartition("doc_id")
    lists = spans.groupBy(F.col("doc_id").alias("id")).agg(F.collect_list(F.struct("lo", "hi", "off", "g")).alias("cuts"))
    rows = packed_texts(docs).join(lists, F.col("doc_id") == F.col("id"), "left").select("doc_id", "body", "cuts")
    schema = "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def cut(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            sizes, spans, kept = [], [], []
            for body, cuts in zip(batch.column(1), batch.column(2)):
                text = unpack.decompress(body.as_buffer())
                sizes.append(len(text))
                gone: list[list[int]] = []
                if cuts.is_valid:
                    lo, hi, off, g = (cuts.values.field(k).to_numpy() for k in range(4))
                    mine = own_spans(text, lo, hi + (length - 1), off, g)
                    lo, hi = lo[mine], hi[mine] + (length - 1)
                    order = np.argsort(lo, kind="stable")
                    for a, b in zip(lo[order].tolist(), hi[order].tolist()):
                        if gone and a <= gone[-1][1]:
                            gone[-1][1] = max(gone[-1][1], b)
                        else:
                            gone.append([a, b])
                spans.append([{"start": a, "end": b} for a, b in gone])
                edges = [0, *(x for g in gone for x in g), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
            yield pa.record_batch(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(span)), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "spans", "kept"],
            )

    return rows.mapInArrow(cut, schema)
