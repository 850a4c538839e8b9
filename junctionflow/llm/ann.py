"""Approximate nearest neighbours with an inverted multi-index.

Vectors are cut into two halves, each quantised by its own codebook; a pair of
centroids is a cell, and the index is the table of all vectors by cell. A query
walks the pairs in order of their summed distance with a heap until the cells
passed hold enough vectors; all entries of these cells are reranked by the exact
distance on the original vectors.

The codebooks are fitted on a bounded sample of distinct vectors, on which the share of vectors to
visit is chosen too: the least of SHARES that finds ``recall`` of the
sample's true neighbours (1 visits every cell, an exact search), but never fewer
than k + 1 vectors. Equal vectors
are one entry that carries its least ids, as many as a result can need. The
cells of one centroid of the first half are read together, in blocks of bounded
size, and queries come in blocks, too.

Cases: vectors that are null, all zero, hold null or non-finite components or
are not of the most frequent length take no part, nor do null ids; of rows that
share an id the one with the least bytes counts; equal distances go to the
smaller id; with fewer candidates than ``k`` all are returned; an empty table
gives an empty result; columns other than vec_id and embedding are ignored.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._store import sent, written

#: Vectors that codebooks and the visited share are fitted on, and trial queries for the latter.
SAMPLE, TRIALS = 16_384, 200
SHARES = (1 / 64, 1 / 32, 1 / 16, 1 / 8, 1 / 4, 3 / 8, 1 / 2, 5 / 8, 3 / 4, 1.0)
#: Centroids of a half, at most.
CENTROIDS = 256
#: Entries of a block of a row of cells (those of one centroid of the first half), and queries of a block.
CELL_BLOCK, QUERY_BLOCK = 4096, 8192


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): the vectors that take part, as bytes of doubles, one row an id."""

    def check(batches):
        for batch in batches:
            ids, out, sizes = [], [], []
            for i, e in zip(batch.column(0).to_pylist(), batch.column(1)):
                if i is None or not e.is_valid or e.values.null_count or len(e.values) == 0:
                    continue
                v = e.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(v).all() and v.any():
                    ids.append(i)
                    out.append((v + 0.0).tobytes())
                    sizes.append(len(v))
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(out, pa.binary()), pa.array(sizes, pa.int32())], names=["vec_id", "v", "n"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(check, "vec_id long, v binary, n int")
    rows = written(rows, "vectors")
    common = rows.groupBy("n").count().orderBy(F.desc("count"), F.desc("n")).select("n").first()
    rows = rows.filter(F.col("n") == (common.n if common else 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def _near(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of all x to all c."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1), 0)


def codebook(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k-means centroids; starts from evenly spaced rows of x, whose order is that of a hash."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        who = np.concatenate([_near(p, c).argmin(1) for p in np.array_split(x, max(1, len(x) // 4096))])
        sums, n = np.zeros_like(c), np.bincount(who, minlength=k)
        np.add.at(sums, who, x)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


@dataclass
class MultiIndex:
    first: np.ndarray
    second: np.ndarray
    mean: np.ndarray
    share: float = 1.0
    sizes: np.ndarray | None = None

    def cells(self, x: np.ndarray) -> np.ndarray:
        x, h = x - self.mean, x.shape[1] // 2
        return _near(x[:, :h], self.first).argmin(1) * len(self.second) + _near(x[:, h:], self.second).argmin(1)

    def enough(self, entries: int, k: int) -> int:
        """Entries to visit: the share, and no fewer than k others besides the query's own."""
        return max(int(np.ceil(self.share * entries)), k + 1)

    def walk(self, q: np.ndarray, enough: int) -> list[int]:
        """Cells with entries in order of the summed distance to their centroids, until they hold ``enough`` of them."""
        q, h = q - self.mean, len(q) // 2
        one, two = _near(q[None, :h], self.first)[0], _near(q[None, h:], self.second)[0]
        a, b = np.argsort(one, kind="stable").tolist(), np.argsort(two, kind="stable").tolist()
        heap, out, held = [(one[a[0]] + two[b[0]], 0, 0)], [], 0
        while heap and held < enough:
            _, i, j = heapq.heappop(heap)
            cell = a[i] * len(b) + b[j]
            if self.sizes[cell]:
                out.append(cell)
                held += int(self.sizes[cell])
            if j + 1 < len(b):
                heapq.heappush(heap, (one[a[i]] + two[b[j + 1]], i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (one[a[i + 1]] + two[b[0]], i + 1, 0))
        return out


def fit(sample: np.ndarray, total: int, k: int, recall: float) -> MultiIndex:
    size = int(np.clip(2 ** round(np.log2(4 * total**0.25)), 1, min(CENTROIDS, len(sample))))
    h, mean = sample.shape[1] // 2, sample.mean(axis=0)
    original, sample = sample, sample - mean
    index = MultiIndex(codebook(sample[:, :h], size), codebook(sample[:, h:], size), mean)
    cell = index.cells(original)
    index.sizes = np.bincount(cell, minlength=size * size)
    trial = sample[:TRIALS]
    far = _near(trial, sample)
    far[np.arange(len(trial)), np.arange(len(trial))] = np.inf
    true = np.argsort(far, axis=1, kind="stable")[:, : min(k, len(sample) - 1)]
    for index.share in SHARES:
        if index.share == 1.0 or not true.size:
            break
        found = [np.isin(cell[t], index.walk(q, index.enough(len(sample), k))).mean() for q, t in zip(original[:TRIALS], true)]
        if np.mean(found) >= recall:
            break
    return index


def nearest(vectors: DataFrame, k: int = 10, every: int = 100, recall: float = 0.95) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each vector whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    rows = written(usable(vectors), "usable")
    total = rows.count()
    result = "query_id long, vec_id long, score double"
    if not total:
        return spark.createDataFrame([], result).selectExpr("query_id", "1 AS rank", "vec_id", "score")
    firsts = rows.groupBy("v").agg(F.min("vec_id").alias("vec_id"))
    picked = firsts.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()
    index = fit(np.frombuffer(b"".join(bytes(r.v) for r in picked)).reshape(len(picked), -1), total, k, recall)
    del picked

    # Equal vectors: one entry with the k + 1 least ids (one may be the query's own).
    same = W.partitionBy("v").orderBy("vec_id")
    least = rows.withColumn("nth", F.row_number().over(same)).filter(F.col("nth") <= k + 1)
    distinct = least.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    first_index, mean = sent(spark, index), index.mean

    def place(batches):
        for batch in batches:
            if batch.num_rows:
                x = np.frombuffer(b"".join(batch.column(0).to_pylist())).reshape(batch.num_rows, -1)
                yield pa.record_batch([*batch.columns, pa.array(first_index.value.cells(x).astype(np.int32))], names=["v", "ids", "cell"])

    entries = written(distinct.mapInArrow(place, "v binary, ids array<long>, cell int"), "entries")
    index.sizes = np.zeros(len(index.first) * len(index.second), np.int64)
    for r in entries.groupBy("cell").agg(F.count("*").alias("n")).collect():  # at most CENTROIDS squared rows
        index.sizes[r.cell] = r.n
    enough = index.enough(int(index.sizes.sum()), k)
    ready = sent(spark, index)
    queries = rows.filter(F.col("vec_id") % every == 0)
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    width = len(index.second)
    row_parts = np.maximum(1, -(-index.sizes.reshape(-1, width).sum(1) // CELL_BLOCK))

    def probe(batches):
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                asked: dict[int, list[int]] = {}
                for cell in ready.value.walk(np.frombuffer(v), enough):
                    asked.setdefault(cell // width, []).append(cell)
                for first, cells in asked.items():
                    for part in range(int(row_parts[first])):
                        for o, x in zip(out, (i, v, first, part, cells)):
                            o.append(x)
                if len(out[0]) > 5000:
                    yield pa.record_batch([pa.array(o, t) for o, t in zip(out, kinds)], names=names)
                    out = [[], [], [], [], []]
            yield pa.record_batch([pa.array(o, t) for o, t in zip(out, kinds)], names=names)

    kinds = (pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.list_(pa.int32()))
    names = ["query_id", "v", "first", "part", "cells"]
    probes = queries.mapInArrow(probe, "query_id long, v binary, first int, part int, cells array<int>")
    probes = probes.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    parts = F.array(*[F.lit(int(p)) for p in row_parts])  # at most CENTROIDS numbers
    dealt = entries.withColumn("first", F.floor(F.col("cell") / width).cast("int"))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("v"), F.element_at(parts, F.col("first") + 1)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def rerank(asked: pa.Table, held: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if asked.num_rows and held.num_rows:
            x = np.frombuffer(b"".join(held["v"].to_pylist())).reshape(held.num_rows, -1)
            ids = held["ids"].to_pylist()
            who, qs = asked["query_id"].to_pylist(), np.frombuffer(b"".join(asked["v"].to_pylist())).reshape(asked.num_rows, -1)
            cell, cells = held["cell"].to_numpy(), asked["cells"].to_pylist()
            # Distances by the expanded square are off by rounding of this order, less so about the mean; the cut keeps all within it.
            xc, qc = x - mean, qs - mean
            slack = 8 * np.finfo(float).eps * x.shape[1] * ((qc * qc).sum(1) + (xc * xc).sum(1).max())
            for lo in range(0, len(qs), 256):
                d = _near(qc[lo : lo + 256], xc)
                for row, wanted in zip(d, cells[lo : lo + 256]):
                    row[~np.isin(cell, wanted)] = np.inf
                reach = min(k + 1, d.shape[1])  # the query itself may be one of them
                limit = np.partition(d, reach - 1, axis=1)[:, reach - 1]
                for n, (row, top) in enumerate(zip(d, limit), lo):
                    near = np.flatnonzero((row <= top + slack[n]) & (row < np.inf))
                    exact = np.sqrt(((x[near] - qs[n]) ** 2).sum(1))
                    best = sorted((s, i) for s, e in zip(exact.tolist(), near.tolist()) for i in ids[e] if i != who[n])[:k]
                    out[0] += [who[n]] * len(best)
                    out[1] += [i for _, i in best]
                    out[2] += [s for s, _ in best]
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], names=["query_id", "vec_id", "score"])

    key = ["first", "part", "block"]
    found = probes.groupBy(*key).cogroup(dealt.groupBy(*key)).applyInArrow(rerank, result)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
