"""N-gram Jaccard self-join of documents, and the groups that its links make.

A document is the set of its distinct 5-word shingles (64-bit hashes). Exact
copies of a set become one class first. Shingles are ranked rare first by a
counting sketch of what the whole corpus shares (ties by hash), so two sets with
a similarity of 0.75 or more share a shingle among the first
n - ceil(0.75 n) + 1 of each. Shingles that the sketch proves unique can be shared with nobody and
are not indexed; most documents therefore index nothing.

Pairs come from joins on indexed shingles, in two rounds. First every class
meets one class of each of its shingles, the one with most shingles that others
may share (in a group of near copies, one close to their origin): as many pairs
as index rows.
Then only classes of the same shingle that the first round's links left in
different components meet, so a large group of near copies is joined through a
few members and its pairs are never all emitted. The join condition holds the
length filter, the positional filter (only shingles not proven unique can match
before a position), a bound by levels of the sketch (a shingle has one level in
all sets), and in the second round the suffix filter, which bounds the overlap
bucket by bucket of the hash. The second round compares the rows of a shingle in
numpy, blocks of pairs at a time, with the positional filter of the first shared
shingle. What is left is verified once by the exact intersection.

Cases: null, empty or wordless texts have an empty set and link with nothing;
rows without an id take part (their component is the least id of the group, null
if no member has one); repeated rows are copies of each other; an empty table
gives an empty result; only doc_id and text are read, other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._bytes import MULT, NOT_SPACE, U64, column_bytes, combine, doc_groups, mix, word_hashes
from ._components import components
from ._sketch import broadcast, shared_levels, using
from ._store import discard, written

WIDTH = 5
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Slots of the sketch, as a power of 2.
LOG2 = 29
#: Buckets of the suffix filter.
BUCKETS = 64
#: Bytes of texts whose shingles are looked up together and make one batch of a task's output (a longer text alone).
TOGETHER = 1 << 22
#: Pairs compared at a time, rows of a task compared together (more of one shingle), and rows of a shingle that one task compares with all of them.
MEET, HELD, CHUNK = 1 << 18, 20_000, 8192
ROW = "doc_id long, n long, set binary, free int, l1 int, l2 int, grams array<long>, counts array<short>"
#: What a posting says of its set: size, shingles proven unique, shingles of levels 1 and 2.
SHAPE = ("n", "free", "l1", "l2")


def shingle_sets(col, width: int = WIDTH):
    """The sorted distinct shingle hashes of each document of an Arrow text column."""
    for _, words, at in word_hashes(col, NOT_SPACE):
        runs = combine(words, width)
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
            if hi - lo >= width:
                s = np.sort(runs[lo : hi - width + 1])
                yield s[np.flatnonzero(np.diff(s, prepend=~s[:1]))]
            else:
                yield combine(words[lo:hi], hi - lo) if hi > lo else words[lo:hi]


def _sets(docs: DataFrame, width: int, percent: int, log2: int) -> DataFrame:
    """ROW of every document; grams (ranked rare first) only where some indexed shingle may be shared."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    levels = broadcast(docs, shared_levels(slim, lambda b: shingle_sets(b.column(1), width), log2=log2))

    def pieces(batches):
        for batch in batches:
            for lo, hi in doc_groups(column_bytes(batch.column(1))[1], TOGETHER):
                yield batch.slice(lo, hi - lo)

    def rows(seen, batches):
        for batch in pieces(batches):
            n, key, levels_of, grams, counts = [], [], [], [], []
            sets = list(shingle_sets(batch.column(1), width))
            levels_in = np.split(seen.of_many(np.concatenate(sets)), np.cumsum([len(s) for s in sets])[:-1])
            for s, lv in zip(sets, levels_in):
                n.append(len(s))
                marks = np.array([np.sum(s), np.sum(mix(s ^ MULT[40]))], U64)
                key.append(marks.tobytes())
                by_level = np.bincount(lv, minlength=4).tolist() if len(s) else [0] * 4
                alone = by_level[0]
                levels_of.append(by_level)
                if alone >= len(s) - -(-percent * len(s) // 100) + 1 or not len(s):
                    grams.append(None)
                    counts.append(None)
                    continue
                grams.append(s[np.argsort(lv, kind="stable")].view(np.int64))
                counts.append(np.minimum(np.bincount((s[lv > 0] & U64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS), 32767).astype(np.int16))
            yield pa.record_batch(
                [
                    batch.column(0), pa.array(n, pa.int64()), pa.array(key, pa.binary()),
                    *(pa.array([x[k] for x in levels_of], pa.int32()) for k in range(3)),
                    pa.array(grams, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int16())),
                ],
                names=["doc_id", "n", "set", "free", "l1", "l2", "grams", "counts"],
            )

    return written(slim.mapInArrow(using(levels, rows), ROW), "shingle-sets")


def _need(na: Column, nb: Column, percent: int) -> Column:
    """The least intersection of two linked sets: ceil(percent * (na + nb) / (100 + percent))."""
    return F.ceil(F.lit(percent) * (na + nb) / F.lit(100 + percent))


def _may_link(a: str, b: str, percent: int) -> Column:
    """Length, positional and level filters for two postings of the same shingle."""

    def both(f) -> Column:
        return F.least(f(lambda c: F.col(f"{a}.{c}")), f(lambda c: F.col(f"{b}.{c}")))

    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    need = _need(na, nb, percent)
    here = both(lambda c: c("n") - c("pos")) + both(lambda c: c("pos") - c("free"))
    levels = both(lambda c: c("l1")) + both(lambda c: c("l2")) + both(lambda c: c("n") - c("free") - c("l1") - c("l2"))
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & (here >= need) & (levels >= need)


def _buckets_allow(na: Column, nb: Column, ca: Column, cb: Column, percent: int) -> Column:
    """Suffix filter: the sum over buckets of the smaller count bounds the intersection."""
    most = F.aggregate(F.zip_with(ca, cb, lambda x, y: F.least(x, y).cast("int")), F.lit(0), lambda s, x: s + x)
    return (F.greatest(na, nb) > 32767) | (most >= _need(na, nb, percent))  # counts are cut at 32767


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(F.col(f"{a}.set"), F.col(f"{b}.set")).alias("a"), F.greatest(F.col(f"{a}.set"), F.col(f"{b}.set")).alias("b")]


def _verified(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link: suffix filter on bucket counts first, then the exact intersection."""
    small = classes.select("set", "n", "counts")
    near = (
        pairs.join(small.toDF("a", "na", "ca"), "a")
        .join(small.toDF("b", "nb", "cb"), "b")
        .filter(_buckets_allow(F.col("na"), F.col("nb"), F.col("ca"), F.col("cb"), percent))
        .select("a", "b", "na", "nb")
    )
    grams = classes.select("set", "grams")
    both = near.join(grams.toDF("a", "ga"), "a").join(grams.toDF("b", "gb"), "b")
    both = both.withColumn("same", F.size(F.array_intersect("ga", "gb")))
    return both.filter(100 * F.col("same") >= percent * (F.col("na") + F.col("nb") - F.col("same"))).select("a", "b")


def _pairs_of_rows(first: np.ndarray, size: np.ndarray, xs: np.ndarray):
    """(x, y): rows xs, each with every row of its group, about MEET pairs at a time; a row's group are ``size`` rows from ``first`` on."""
    ends = np.cumsum(size[xs])
    lo = 0
    while lo < len(xs):
        before = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + MEET, "right")))
        own = xs[lo:hi]
        x = np.repeat(own, size[own])
        yield x, np.arange(len(x)) + np.repeat(first[own] - (ends[lo:hi] - size[own] - before), size[own])
        lo = hi


def _met(rows: pa.Table, percent: int):
    """(x, y) of the rows' pairs in the same group and of different parts that may link, as row numbers.

    One of two is not of the group's main part. A pair that links does so at the
    first shingle they share, too, where nothing before it is shared: two that
    share the indexed shingle before, ``prev``, are left to an earlier group.
    """
    n, free, l1, l2 = (np.asarray(rows[c]).astype(np.int32) for c in SHAPE)
    behind, l3 = n - np.asarray(rows["pos"]).astype(np.int32), n - free - l1 - l2
    prev, later = np.asarray(rows["prev"]), behind < n - free
    part = np.asarray(rows["part"].combine_chunks().dictionary_encode().indices)
    main, own = np.asarray(rows["is_main"]), np.asarray(rows["own"])
    counts = np.asarray(rows["counts"].combine_chunks().flatten()).reshape(len(n), BUCKETS)
    gram, chunk = np.asarray(rows["gram"]), np.asarray(rows["chunk"])
    starts = np.flatnonzero(np.concatenate([[True], (gram[1:] != gram[:-1]) | (chunk[1:] != chunk[:-1])]))
    sizes = np.diff(starts, append=len(n))
    for x, y in _pairs_of_rows(np.repeat(starts, sizes), np.repeat(sizes, sizes), np.flatnonzero(own & ~main)):
        nx, ny = n[x], n[y]
        need = -(-percent * (nx + ny).astype(np.int64) // (100 + percent))
        ok = np.flatnonzero((np.minimum(behind[x], behind[y]) >= need) & ~(later[x] & later[y] & (prev[x] == prev[y])))
        x, y, nx, ny, need = x[ok], y[ok], nx[ok], ny[ok], need[ok]
        ok = (part[x] != part[y]) & (100 * np.minimum(nx, ny).astype(np.int64) >= percent * np.maximum(nx, ny).astype(np.int64))
        ok &= np.minimum(l1[x], l1[y]) + np.minimum(l2[x], l2[y]) + np.minimum(l3[x], l3[y]) >= need
        x, y, need, big = x[ok], y[ok], need[ok], np.maximum(nx, ny)[ok] > 32767  # counts are cut at 32767
        for lo in range(0, len(x), 1 << 14):
            a, b = x[lo : lo + (1 << 14)], y[lo : lo + (1 << 14)]
            ok = big[lo : lo + (1 << 14)] | (np.minimum(counts[a], counts[b]).sum(axis=1, dtype=np.int64) >= need[lo : lo + (1 << 14)])
            yield a[ok], b[ok]


def _meetings(left: DataFrame, percent: int) -> DataFrame:
    """(x, y): sets of the same shingle but different parts that may link; a pair may come more than once.

    Rows of a shingle stand together in a task. In a shingle of many rows each
    part of them, CHUNK rows, meets all of them in a task of its own.
    """
    chunks = F.ceil(F.col("members") / CHUNK).cast("int")
    dealt = left.withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1))).select(
        "gram", "chunk", "set", *SHAPE, "pos", "prev", "part", "counts",
        (F.col("part") == F.col("main")).alias("is_main"), (F.pmod(F.xxhash64("set"), chunks) == F.col("chunk")).alias("own"),
    )

    def meet(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < HELD:
                continue
            rows = pa.Table.from_batches(held)
            key = np.asarray(rows["gram"]), np.asarray(rows["chunk"])
            last = np.flatnonzero((key[0] != key[0][-1]) | (key[1] != key[1][-1]))
            if len(last):  # the last group may go on
                at = int(last[-1]) + 1
                yield from found(rows.slice(0, at))
                held = rows.slice(at).to_batches()
        if held:
            yield from found(pa.Table.from_batches(held))

    def found(rows):
        sets = rows["set"].combine_chunks()
        for x, y in _met(rows, percent):
            if len(x):
                yield pa.record_batch([sets.take(pa.array(x)), sets.take(pa.array(y))], names=["x", "y"])

    return dealt.repartition("gram", "chunk").sortWithinPartitions("gram", "chunk").mapInArrow(meet, "x binary, y binary")


def similar_groups(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, log2: int = LOG2) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs."""
    sets = _sets(docs, width, percent, log2)
    classes = written(
        sets.filter("grams is not null").groupBy("set").agg(
            F.min("doc_id").alias("rep"), *(F.first(c).alias(c) for c in (*SHAPE, "grams", "counts"))
        ),
        "shingle-classes",
    )
    # From here on a document is its class; the shingles of every copy need not stay.
    members = written(sets.select("doc_id", "n", F.when(F.col("grams").isNotNull(), F.col("set")).alias("set")), "shingle-members")
    discard(sets)
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    rows = classes.withColumn("part", F.slice("grams", F.col("free") + 1, (prefix - F.col("free")).cast("int")))
    index = written(
        rows.select("set", *SHAPE, "part", F.posexplode("part").alias("k", "gram")).select(
            "gram", "set", *SHAPE, (F.col("k") + F.col("free")).alias("pos"), F.coalesce(F.get("part", F.col("k") - 1), F.lit(0)).alias("prev")
        ),
        "shingle-index",
    )
    size = index.count()
    hubs = (
        index.groupBy("gram")
        .agg(F.max(F.struct((F.col("n") - F.col("free")).alias("shared"), "set", *SHAPE, "pos")).alias("hub"), F.count("*").alias("members"))
        .filter("members > 1")
        .select("gram", "hub.*")
    )
    # Written, so that the join has a plain shuffle on both sides and a hot shingle's partition can be split.
    h = written(hubs, "shingle-hubs", size // 2)
    star = index.alias("i").join(h.alias("h"), F.col("i.gram") == F.col("h.gram")).filter((F.col("i.set") != F.col("h.set")) & _may_link("i", "h", percent))
    star = written(star.select(*_ordered("i", "h")).distinct(), "star-pairs", size)
    discard(h)
    links = written(_verified(star, classes, percent), "star-links")
    label = components(links)

    # Shingles whose members are still in several components: all of them but the
    # largest component's meet the whole list.
    labelled = index.join(label, index["set"] == label["node"], "left").select("gram", "set", *SHAPE, "pos", "prev", F.coalesce("component", "set").alias("part"))
    labelled = written(labelled, "labelled-index", size)
    discard(index)
    parts = labelled.groupBy("gram", "part").agg(F.count("*").alias("c"))
    open_ = parts.groupBy("gram").agg(F.max(F.struct("c", "part")).alias("top"), F.count("*").alias("k"), F.sum("c").alias("members")).filter("k > 1")
    open_ = written(open_.select("gram", F.col("top.part").alias("main"), "members"), "open-shingles", size // 2)
    left = labelled.join(open_, "gram").join(classes.select(F.col("set").alias("key"), "counts"), F.col("set") == F.col("key"))
    left = written(left.drop("key"), "open-index", size)
    discard(labelled, open_)
    rest = _meetings(left, percent)
    rest = rest.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct().join(star, ["a", "b"], "left_anti")
    more = written(_verified(rest, classes, percent), "more-links")
    discard(left, star)
    # The second round's links join whole components of the first: only these are nodes now.
    first = label.select("node", F.col("component").alias("part"))
    ends = more.join(first.toDF("a", "pa"), "a", "left").join(first.toDF("b", "pb"), "b", "left")
    whole = components(ends.select(F.coalesce("pa", "a").alias("a"), F.coalesce("pb", "b").alias("b")))
    named = classes.select("set", "rep").join(first, F.col("set") == F.col("node"), "left")
    named = named.select("set", "rep", F.coalesce("part", "set").alias("part")).join(whole, F.col("part") == F.col("node"), "left")
    named = named.select("set", "rep", F.coalesce("component", "part").alias("part"))
    least = named.groupBy(F.col("part").alias("p")).agg(F.min("rep").alias("component_id"))
    named = named.join(least, F.col("part") == F.col("p")).select(F.col("set").alias("key"), "component_id")
    grouped = members.filter("set is not null").join(named, F.col("set") == F.col("key"))
    alone = members.filter("set is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return grouped.select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(alone)


def one_of_each_group(docs: DataFrame, **params) -> DataFrame:
    """The documents whose id is the least of their group, same columns; rows without an id stay."""
    keep = similar_groups(docs, **params).filter("doc_id = component_id").select(F.col("doc_id").alias("__keep")).distinct()
    return docs.join(keep, F.col("doc_id") == F.col("__keep"), "left").filter("__keep is not null or doc_id is null").drop("__keep")
