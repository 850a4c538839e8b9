"""Hard-negative mining by threshold joins over an inverted index with norm bounds.

Vectors become integer vectors, floor(scale * x); scores are inner products and
exact. Two joins bring anchors and rows together in blocks of bounded size: the
first finds every anchor's best rows of its own label (the positives), the
second, for every positive, the best rows of other labels whose score lies in
the positive's window.

A block is joined at a threshold. Dimensions go from the most to the least
energy; a row's tail is left out of the index from the first dimension on where
the norm of the rest, times the anchors' norm of the rest, cannot reach the
threshold. Postings hold the remaining dimensions; the anchors' partial scores
are accumulated over groups of dimensions, and rows and anchors none of whose
pairs can still reach the threshold by the norms that remain are dropped after
a group once they are many. Pairs left are scored in full. Anchors whose windows
are not full go on at a lower threshold, down to a floor that is proven to be
low enough: the score that enough rows of a bounded sample reach, or the
window's end, or else no threshold at all.

First join: rows by (label, part), anchors only meet their own label's blocks.
Second join: rows by part, whatever their label. Parts and anchor blocks have at
most BLOCK rows, by hash, so a label or a group of copies with any share of the
rows is split; a block returns at most as many rows as the result needs. Work is
a stated query set (the anchors) against all rows, in blocks.

Cases: rows with a null id, label or vector, or with null or non-finite entries,
or not of the most frequent length, take no part; integer entries are held
within 2**53 either way; of rows that share an id the least (label, vector)
counts; equal scores go to the smaller id; with too few rows all are returned;
a window that holds nothing gives no row; scores beyond a long are held at its
ends; an empty table gives an empty result; columns other than vec_id,
embedding and label are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._store import sent, written
from ._vectors import finite, most_frequent

#: Rows, and anchors, of a block.
BLOCK = 8192
#: Anchors that are scored together, and dimensions that are accumulated together.
TOGETHER, GROUP = 64, 16
#: The share of rows (or anchors) that can still reach the threshold under which the others are dropped.
DROP = 0.75
#: Rows of the sample that floors are read off.
SAMPLE = 2048
#: Where thresholds go between the highest possible score and the floor: shares of that distance.
STEPS = (0.5, 0.25, 0.0)
LARGEST = 2**53

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def integer_rows(vectors: DataFrame, label: Column, scale: int) -> DataFrame:
    """(vec_id, label, x, n): usable rows, x as bytes of integer doubles."""

    def place(batches):
        for batch in batches:
            for at, matrix in finite(batch.column(2)):
                x = np.floor(np.clip(matrix * float(scale), -LARGEST, LARGEST)) + 0.0
                ids = [batch.column(k).take(pa.array(at)) for k in (0, 1)]
                yield pa.record_batch([*ids, pa.array([r.tobytes() for r in x], pa.binary()), pa.array([x.shape[1]] * len(x), pa.int32())], names=["vec_id", "label", "x", "n"])

    columns = [F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding")]
    known = vectors.select(columns).filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    return known.mapInArrow(place, "vec_id long, label long, x binary, n int")


def _matrix(column) -> np.ndarray:
    data = column.to_pylist()
    return np.frombuffer(b"".join(data)).reshape(len(data), -1) if data else np.zeros((0, 1))


def _tails(x: np.ndarray) -> np.ndarray:
    """Norms of the rest from each dimension on: (rows, dimensions + 1), a little too large rather than too small."""
    rest = np.zeros((len(x), x.shape[1] + 1))
    rest[:, :-1] = np.sqrt(np.cumsum((x * x)[:, ::-1], axis=1))[:, ::-1]
    return rest * (1 + 1e-9)


class Postings:
    """Rows of a block as an inverted index, dimensions in the order of ``order``; cut anew for each threshold."""

    def __init__(self, x: np.ndarray, order: np.ndarray):
        self.order = order
        self.x = np.ascontiguousarray(x[:, order])
        self.rest = _tails(self.x)
        self.longest = float(self.rest[:, 0].max(initial=0))

    def reach(self, a: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor positions, row positions, scores) of all pairs with score >= low of the anchor; ``a`` in index order."""
        dim = self.x.shape[1]
        rest = _tails(a)
        if self.longest * float(rest[:, 0].max(initial=0)) >= LARGEST:
            return self._reach_large(a, low)
        edges = [*range(0, dim, GROUP), dim]
        # A row is indexed up to the first edge from which its rest cannot reach any of these anchors' thresholds.
        cut = np.full(len(self.x), dim)
        if (low > 0).all():
            for e in reversed(edges[:-1]):
                cut[self.rest[:, e] * (rest[:, e] / low).max() < 1] = e
        rows = np.argsort(-cut, kind="stable")
        rows = rows[cut[rows] > 0]  # the others share no posting with an anchor and cannot reach it
        cut, x, tail = cut[rows], self.x[rows], self.rest[rows]
        anchors, score = np.arange(len(a)), np.zeros((len(a), len(rows)))
        may = np.ones(score.shape, bool)
        for lo, hi in zip(edges, edges[1:]):
            held = int(np.searchsorted(-cut, -lo))  # rows with postings in these dimensions come first; the others are settled
            if held:
                part = score[:, :held]
                part += a[anchors, lo:hi] @ x[:held, lo:hi].T
                most = np.outer(rest[anchors, hi], tail[:held, hi])
                most += part
                np.greater_equal(most, low[anchors, None], out=may[:, :held])
            keep, stay = may.any(axis=0), may.any(axis=1)
            if not keep.any():
                return _NONE
            if keep.mean() < DROP or stay.mean() < DROP:
                rows, cut, x, tail = rows[keep], cut[keep], x[keep], tail[keep]
                score, may, anchors = score[stay][:, keep], may[stay][:, keep], anchors[stay]
        full = a[anchors] @ x.T  # whole numbers below 2**53: exact
        who, row = np.nonzero(may & (full >= low[anchors, None]))
        return anchors[who], rows[row], full[who, row].astype(np.int64)

    def _reach_large(self, a: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for numbers that doubles would round: whole numbers of any size, held within a long at the end."""
        whole = [[int(v) for v in r] for r in self.x]
        found: list[list[int]] = [[], [], []]
        for i, q in enumerate([int(v) for v in r] for r in a):
            for j, r in enumerate(whole):
                s = max(-(2**63), min(2**63 - 1, sum(u * v for u, v in zip(q, r))))
                if s >= low[i]:
                    for o, v in zip(found, (i, j, s)):
                        o.append(v)
        return tuple(np.array(o, np.int64) for o in found)


_NONE = (np.zeros(0, np.int64),) * 3


def lowered(x: np.ndarray, a: np.ndarray, floor: np.ndarray, order: np.ndarray, take) -> None:
    """Join anchors with rows at falling thresholds, the last of which is the floor.

    ``take(anchors, last, who, rows, scores)`` gets the pairs found for these
    anchors and says which of them are full; the others go on.
    """
    index = Postings(x, order)
    a = np.ascontiguousarray(a[:, order])
    most = np.sqrt((a * a).sum(axis=1)) * index.longest * (1 + 1e-9) + 1
    floor = np.maximum(floor, -most)
    for lo in range(0, len(a), TOGETHER):
        left = np.arange(lo, min(lo + TOGETHER, len(a)))
        for step in STEPS:
            low = floor[left] + step * np.maximum(most[left] - floor[left], 0)
            full = take(left, step == 0, *index.reach(a[left], low))
            left = left[~full]
            if not len(left):
                break


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best: higher scores first, then smaller ids."""
    near = np.arange(len(ids))
    if len(ids) > 4 * k:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return near[np.lexsort((ids[near], ~scores[near]))[:k]]


def _of_each(who: np.ndarray, n: int) -> list[np.ndarray]:
    """The positions in ``who`` of each anchor 0..n-1."""
    order = np.argsort(who, kind="stable")
    return np.split(order, np.searchsorted(who[order], np.arange(1, n)))


def window(positive: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest whole score from low to high percent of a positive's score."""
    return -(-low * positive // 100), high * positive // 100


def block_positives(asked: pa.Table, held: pa.Table, order: np.ndarray, k: int) -> pa.Table:
    """(anchor_id, positive_id, score): each anchor's k best rows of this block, itself left out."""
    out: list[list] = [[], [], []]
    if asked.num_rows and held.num_rows:
        ids, anchor = held["vec_id"].to_numpy(), asked["vec_id"].to_numpy()

        def take(at, last, who, rows, scores):
            other = ids[rows] != anchor[at][who]
            rows, scores, groups = rows[other], scores[other], _of_each(who[other], len(at))
            full = np.array([len(g) >= k for g in groups])
            for i, g, f in zip(at, groups, full):
                if f or last:
                    top = g[best(ids[rows[g]], scores[g], k)]
                    for o, v in zip(out, ([anchor[i]] * len(top), ids[rows[top]], scores[top])):
                        o.extend(v)
            return full

        lowered(_matrix(held["x"]), _matrix(asked["x"]), asked["floor"].to_numpy(), order, take)
    return pa.table([pa.array(o, pa.int64()) for o in out], names=["anchor_id", "positive_id", "score"])


def block_negatives(asked: pa.Table, held: pa.Table, order: np.ndarray, k: int, low: int, high: int) -> pa.Table:
    """(anchor_id, positive_id, negative_id, positive_score, negative_score): the k best of this block in each window."""
    out: list[list] = [[], [], [], [], []]
    if asked.num_rows and held.num_rows:
        ids, labels = held["vec_id"].to_numpy(), held["label"].to_numpy()
        anchor, own, goals = asked["vec_id"].to_numpy(), asked["label"].to_numpy(), asked["positives"].to_pylist()

        def take(at, last, who, rows, scores):
            other = labels[rows] != own[at][who]
            rows, scores, groups = rows[other], scores[other], _of_each(who[other], len(at))
            full = np.zeros(len(at), bool)
            for n, (i, g) in enumerate(zip(at, groups)):
                found = []
                for p in goals[i]:
                    least, greatest = window(p["score"], low, high)
                    inside = g[(scores[g] >= least) & (scores[g] <= greatest)]
                    found.append((p, inside[best(ids[rows[inside]], scores[inside], k)]))
                full[n] = all(len(top) >= k for _, top in found)
                if full[n] or last:
                    for p, top in found:
                        for o, v in zip(out, ([anchor[i]] * len(top), [p["id"]] * len(top), ids[rows[top]], [p["score"]] * len(top), scores[top])):
                            o.extend(v)
            return full

        lowered(_matrix(held["x"]), _matrix(asked["x"]), asked["floor"].to_numpy(), order, take)
    return pa.table([pa.array(o, pa.int64()) for o in out], names=["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])


def _below(score: np.ndarray) -> np.ndarray:
    """A double below the whole numbers ``score``, near them."""
    return score - np.abs(score) * 1e-12 - 0.5


def _pair_scores(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.clip(a @ x.T, -(2.0**62), 2.0**62)


def hard_negatives(
    vectors: DataFrame, label: Column | str = "label", every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256
) -> DataFrame:
    """RESULT: for each anchor (an id divisible by ``every``) and positive, its best negatives.

    An anchor's positives are its ``positives`` best rows of its label; a
    positive's negatives are the ``negatives`` best rows of other labels with
    low to high percent of the positive's score (whole percents).
    """
    spark = vectors.sparkSession
    rows = written(integer_rows(vectors, F.col(label) if isinstance(label, str) else label, scale), "integer")
    dim = most_frequent(rows.groupBy("n").count().collect())  # one row a length
    if not dim:
        return spark.createDataFrame([], RESULT)
    least = F.min(F.struct("label", "x"))
    rows = written(rows.filter(F.col("n") == dim).groupBy("vec_id").agg(least.alias("r")).select("vec_id", "r.label", "r.x"), "rows")
    total = rows.count()

    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    sample = np.frombuffer(b"".join(bytes(r.x) for r in picked)).reshape(len(picked), dim)
    order = np.argsort(-(sample * sample).sum(axis=0), kind="stable")
    shared = sent(spark, (sample, np.array([r.label for r in picked]), np.array([r.vec_id for r in picked])))

    def first_floor(batches):
        x, labels, ids = shared.value
        for batch in batches:
            if batch.num_rows:
                scores = _pair_scores(_matrix(batch.column("x")), x)
                scores[labels != batch.column("label").to_numpy()[:, None]] = -np.inf
                scores[ids == batch.column("vec_id").to_numpy()[:, None]] = -np.inf
                kth = np.partition(scores, len(ids) - positives, axis=1)[:, len(ids) - positives] if len(ids) >= positives else np.full(batch.num_rows, -np.inf)
                yield pa.record_batch([*batch.columns, pa.array(np.where(np.isinf(kth), kth, _below(np.where(np.isinf(kth), 0, kth))))], names=["vec_id", "label", "x", "floor"])

    is_anchor = F.col("vec_id") % every == 0
    stats = rows.groupBy("label").agg(F.count("*").alias("rows"), F.count_if(is_anchor).alias("anchors")).filter("anchors > 0")
    stats = stats.select("label", F.ceil(F.col("rows") / BLOCK).alias("parts"), F.ceil(F.col("anchors") / BLOCK).alias("blocks"))

    def upto(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1))

    row_part, anchor_block = (F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.col(n)) for seed, n in ((1, "parts"), (2, "blocks")))
    asked = rows.filter(is_anchor).mapInArrow(first_floor, "vec_id long, label long, x binary, floor double")
    asked = asked.join(stats, "label").select("vec_id", "label", "x", "floor", anchor_block.alias("block"), upto(F.col("parts")).alias("part"))
    held = rows.join(stats, "label").select("vec_id", "label", "x", row_part.alias("part"), upto(F.col("blocks")).alias("block"))
    key = ["label", "part", "block"]
    found = asked.groupBy(*key).cogroup(held.groupBy(*key)).applyInArrow(lambda a, h: block_positives(a, h, order, positives), "anchor_id long, positive_id long, score long")
    place = F.row_number().over(W.partitionBy("anchor_id").orderBy(F.desc("score"), "positive_id"))
    chosen = found.withColumn("place", place).filter(F.col("place") <= positives)
    chosen = chosen.filter(F.col("score") >= 0)  # below 0, low percent are more than high percent
    goals = written(chosen.groupBy("anchor_id").agg(F.collect_list(F.struct(F.col("positive_id").alias("id"), "score")).alias("positives")), "positives")  # at most ``positives`` an anchor

    def second_floor(batches):
        x, labels, _ = shared.value
        for batch in batches:
            if batch.num_rows:
                scores = _pair_scores(_matrix(batch.column("x")), x)
                scores[labels == batch.column("label").to_numpy()[:, None]] = -np.inf
                floors = []
                for row, goal in zip(scores, batch.column("positives").to_pylist()):
                    ends = [window(p["score"], low, high) for p in goal]
                    inside = [row[(row >= least) & (row <= greatest)] for least, greatest in ends]
                    floors.append(min(float(np.sort(s)[-negatives]) if len(s) >= negatives else float(least) for s, (least, _) in zip(inside, ends)))
                yield pa.record_batch([*batch.columns, pa.array(_below(np.array(floors)))], names=["vec_id", "label", "x", "positives", "floor"])

    parts, blocks = max(1, -(-total // BLOCK)), max(1, -(-goals.count() // BLOCK))
    counted = [F.lit(parts).alias("parts"), F.lit(blocks).alias("blocks")]
    goal_type = "array<struct<id: long, score: long>>"
    asked = rows.join(goals.withColumnRenamed("anchor_id", "vec_id"), "vec_id").select("vec_id", "label", "x", "positives")
    asked = asked.mapInArrow(second_floor, f"vec_id long, label long, x binary, positives {goal_type}, floor double")
    asked = asked.select("*", *counted).select("vec_id", "label", "x", "positives", "floor", anchor_block.alias("block"), upto(F.col("parts")).alias("part"))
    held = rows.select("*", *counted).select("vec_id", "label", "x", row_part.alias("part"), upto(F.col("blocks")).alias("block"))
    key = ["part", "block"]
    schema = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"
    found = asked.groupBy(*key).cogroup(held.groupBy(*key)).applyInArrow(lambda a, h: block_negatives(a, h, order, negatives, low, high), schema)
    rank = F.row_number().over(W.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
