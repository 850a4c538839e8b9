"""Whitening of embeddings by a covariance over distinct vectors.

Components are put on an integer grid, x = floor(scale * c) + offset. Equal
x vectors are grouped, with their number of copies; the fit weighs a group one
or by its copies. Sums are exact integers, so each x is centred without loss as
(n * x - S) / n before it is multiplied; every task makes the weighted product
of its own centred block, and the products are added row by row. The
eigenvectors of that one small matrix whiten each distinct vector once, and a
join on x brings the result back to all rows.

The driver sees matrices of dimensions squared, no rows. A vector with very many
copies is one row of the fit; in the join back its rows are the skewed side,
which adaptive execution splits.

Cases: rows whose vector is null or holds null or non-finite entries are
dropped, as are vectors not of the most frequent length; rows with a null id,
and each of several rows with one id, stay rows of their own; grid values are
held within 2**53 either way; components whose eigenvalue is no more than 1e-12
of the trace are left out (so one single distinct vector gives no rows); equal
eigenvalues come in the solver's order; each eigenvector's largest entry is
positive; a deviation beyond a long is null; an empty table gives an empty
result; columns other than vec_id and embedding are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import written
from ._vectors import finite, most_frequent

RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
#: Grid values beyond this are no exact doubles.
LARGEST = 2**53
#: Eigenvalues up to this share of the trace count as zero.
FLAT = 1e-12


def on_grid(vectors: DataFrame, scale: int, offset: int) -> DataFrame:
    """(vec_id, x, n): the usable vectors as bytes of integers (4 bytes each where all entries fit, else 8)."""

    def place(batches):
        for batch in batches:
            ids, xs, sizes = [], [], []
            for at, matrix in finite(batch.column(1)):
                grid = (np.floor(np.clip(matrix * float(scale), -LARGEST, LARGEST)).astype(np.int64) + offset).clip(-LARGEST, LARGEST)
                narrow = (np.abs(grid) < 2**31).all(axis=1)
                for small, dtype in ((True, np.int32), (False, np.int64)):
                    picked = narrow == small
                    ids.append(batch.column(0).take(pa.array(at[picked])))
                    xs += [r.tobytes() for r in grid[picked].astype(dtype)]
                    sizes += [matrix.shape[1]] * int(picked.sum())
            if sizes:
                yield pa.record_batch([pa.concat_arrays(ids), pa.array(xs, pa.binary()), pa.array(sizes, pa.int32())], names=["vec_id", "x", "n"])

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(place, "vec_id long, x binary, n int")


def _grid(column: pa.Array, dim: int) -> np.ndarray:
    """The x vectors of a batch as one int64 matrix."""
    data = column.to_pylist()
    if all(len(b) == 4 * dim for b in data):
        return np.frombuffer(b"".join(data), np.int32).reshape(len(data), dim).astype(np.int64)
    return np.array([np.frombuffer(b, np.int32 if len(b) == 4 * dim else np.int64) for b in data], np.int64).reshape(len(data), dim)


def exact_sums(fit: DataFrame, dim: int) -> list[int]:
    """The sum of every dimension of x over the rows of ``fit``: task sums of high and low halves, added as decimals."""

    def add(batches):
        high, low = np.zeros(dim, np.int64), np.zeros(dim, np.int64)
        for batch in batches:
            x = _grid(batch.column(0), dim)
            high += (x >> 27).sum(axis=0)
            low += (x & (2**27 - 1)).sum(axis=0)
        yield pa.record_batch([pa.array(np.arange(dim, dtype=np.int32)), pa.array(high), pa.array(low)], names=["d", "high", "low"])

    wide = "decimal(38,0)"
    sums = fit.select("x").mapInArrow(add, "d int, high long, low long").groupBy("d").agg(*[F.sum(F.col(c).cast(wide)).alias(c) for c in ("high", "low")])
    return [int(r.high) * 2**27 + int(r.low) for r in sums.orderBy("d").collect()]


class Centre:
    """Exact mean S / n as whole part and remainder."""

    def __init__(self, sums: list[int], n: int):
        parts = [divmod(s, n) for s in sums]
        self.n = n
        self.whole = np.array([p[0] for p in parts], np.int64)
        self.rest = np.array([p[1] for p in parts], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """(n * x - S) / n."""
        return (x - self.whole).astype(np.float64) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n * x - S)**2, exact; None beyond a long."""
        gap = x - self.whole
        most = self.n * (int(np.abs(gap).max(initial=0)) + 1)
        if most * most * max(1, x.shape[1]) < 2**63:
            return ((self.n * gap - self.rest) ** 2).sum(axis=1).tolist()
        wide = ((self.n * gap.astype(object) - self.rest) ** 2).sum(axis=1)
        return [int(v) if v < 2**63 else None for v in wide]


def product(fit: DataFrame, matrix, dim: int) -> np.ndarray:
    """Sum of w * u u' over the rows of ``fit``; ``matrix(batch)`` gives the rows u and their weights w.

    A task sends one product; the rows of equal number of all products are added
    in one group (as many vectors as there are tasks), in the order of the tasks.
    """

    def multiply(batches):
        total = np.zeros((dim, dim))
        for batch in batches:
            u, w = matrix(batch)
            total += (u * w[:, None]).T @ u
        task = TaskContext.get().partitionId()
        yield pa.record_batch([pa.array(np.arange(dim, dtype=np.int32)), pa.array([task] * dim, pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())], names=["d", "task", "row"])

    def add(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("task")
        return pa.table({"d": rows["d"][:1], "row": pa.array([np.frombuffer(b"".join(rows["row"].to_pylist())).reshape(-1, dim).sum(axis=0).tobytes()], pa.binary())})

    parts = fit.mapInArrow(multiply, "d int, task int, row binary").groupBy("d").applyInArrow(add, "d int, row binary")
    rows = {r.d: np.frombuffer(bytes(r.row)) for r in parts.collect()}  # one row a dimension
    return np.array([rows[d] if d in rows else np.zeros(dim) for d in range(dim)]).reshape(dim, dim)


def directions(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(falling eigenvalues, unit eigenvectors as columns) of v, at most ``most`` and none that is flat."""
    values, vectors = np.linalg.eigh((v + v.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = min(most, int((values > FLAT * np.trace(v)).sum()))
    values, vectors = values[:kept], vectors[:, :kept]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(kept)]) if kept else np.ones(0)
    return values, vectors * signs


def whiten(vectors: DataFrame, components: int = 16, weights: str = "one", scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """One row a usable row and component: RESULT.

    ``weights`` is "one" (each distinct x vector counts once in the fit) or
    "copies" (each row does). ``n`` is the fit's total weight, ``explained`` the
    eigenvalue's share of the trace, ``identity_error`` the largest absolute
    entry of the measured covariance of the whitened fit list minus the identity.
    """
    if weights not in ("one", "copies"):
        raise ValueError("weights is 'one' or 'copies'")
    spark = vectors.sparkSession
    rows = written(on_grid(vectors, scale, offset), "grid")
    dim = most_frequent(rows.groupBy("n").count().collect())  # one row a length
    if not dim:
        return spark.createDataFrame([], RESULT)
    rows = rows.filter(F.col("n") == dim).select("vec_id", "x")
    fit = written(rows.groupBy("x").agg(F.count("*").alias("copies")), "distinct")
    n = fit.agg(F.count("*") if weights == "one" else F.sum("copies")).first()[0]
    centre = Centre(exact_sums(fit if weights == "one" else rows, dim), n)

    def weight(batch) -> np.ndarray:
        return np.ones(batch.num_rows) if weights == "one" else batch.column("copies").to_numpy(zero_copy_only=False).astype(np.float64)

    v = product(fit, lambda batch: (centre.centred(_grid(batch.column("x"), dim)), weight(batch)), dim) / n
    values, axes = directions(v, components)
    if not len(values):
        return spark.createDataFrame([], RESULT)
    turn = axes / np.sqrt(values)

    def project(batches):
        for batch in batches:
            x = _grid(batch.column("x"), dim)
            z = centre.centred(x) @ turn
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, z.size + 1, len(values), dtype=np.int32)), pa.array(z.ravel()))
            yield pa.record_batch([batch.column("x"), batch.column("copies"), flat, pa.array(centre.deviations(x), pa.int64())], names=["x", "copies", "z", "deviation"])

    done = written(fit.mapInArrow(project, "x binary, copies long, z array<double>, deviation long"), "whitened")
    share = F.lit(1.0) if weights == "one" else F.col("copies").cast("double")
    means = done.select(share.alias("w"), F.posexplode("z").alias("k", "c")).groupBy("k").agg((F.sum(F.col("w") * F.col("c")) / n).alias("m"))
    mean = np.array([r.m for r in means.orderBy("k").collect()])  # one row a component

    def spread(batch):
        return batch.column("z").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(values)) - mean, weight(batch)

    error = float(np.abs(product(done, spread, len(values)) / n - np.eye(len(values))).max())
    explained = F.array(*[F.lit(float(e / np.trace(v))) for e in values])
    back = rows.join(done.select("x", "z", "deviation"), "x").select("vec_id", "deviation", F.posexplode("z").alias("k", "whitened"))
    return back.select(
        "vec_id",
        (F.col("k") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(explained, F.col("k") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
