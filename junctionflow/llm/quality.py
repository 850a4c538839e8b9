"""Quality by nearest-neighbour voting in a latent semantic space.

A text is a hashed count vector of byte trigrams (letters of any alphabet
folded to their length-preserving classes, so that form counts more than
vocabulary), of neighbouring word repeats and of word lengths. A bounded sample of
labelled rows gives document weights and, by a truncated singular value
decomposition, the latent space. Its labelled vectors are broadcast; every
document is projected, its cosines with all of them come from blocked matrix
products, and the most similar ones vote with their similarity.

Cases: null and empty texts have a vector of their own kind ("no words") and are
scored; rows without an id are scored (and not held out); repeated rows get equal
scores; ties of similarity vote together with the order of the sample; without any
usable label every score is 0.5; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._bytes import LOWER, NOT_SPACE, column_bytes, word_hashes
from ._labels import checksum_is, labelled_sample
from ._store import sent

#: Labelled rows that are broadcast, at most; dimensions of counts and of the latent space; voters.
SAMPLE, BUCKETS, LATENT, VOTERS = 4000, 2048, 64, 15
#: Documents of one matrix product.
BLOCK = 256
#: Extra counts behind the hashed ones: repeats of the word 1, 2 and 3 before, word lengths by doubling, no words.
EXTRA = 3 + 8 + 1

#: Letters and bytes of non-ASCII letters fold to one class, digits to another; punctuation and white space stay.
FOLD = LOWER.copy()
FOLD[97:123] = FOLD[65:91] = FOLD[128:] = 97
FOLD[48:58] = 48


def _doc_counts(buf: np.ndarray, words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(BUCKETS + EXTRA, np.float32)
    half = BUCKETS // 2
    if len(buf) > 2:
        for part, table in ((0, FOLD), (1, LOWER)):
            b = table[buf].astype(np.uint32)
            code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
            out[part * half : (part + 1) * half] = np.bincount((code * np.uint32(2654435761)) >> np.uint32(22), minlength=half)[:half]
    for k in (1, 2, 3):
        if len(words) > k:
            out[BUCKETS + k - 1] = np.count_nonzero(words[k:] == words[:-k])
    if len(lengths):
        out[BUCKETS + 3 : BUCKETS + 11] = np.bincount(np.minimum(np.log2(lengths).astype(int), 7), minlength=8)
    else:
        out[-1] = 1
    return out


def count_vectors(col) -> np.ndarray:
    """Count vectors of an Arrow text column, one row a document."""
    data, offsets = column_bytes(col)
    out = np.zeros((len(offsets) - 1, BUCKETS + EXTRA), np.float32)
    for lo, words, at in word_hashes(col, NOT_SPACE):
        for j in range(len(at) - 1):
            buf = data[offsets[lo + j] : offsets[lo + j + 1]]
            w = np.r_[False, NOT_SPACE[buf], False]
            edges = np.flatnonzero(w[1:] != w[:-1])
            out[lo + j] = _doc_counts(buf, words[at[j] : at[j + 1]], edges[1::2] - edges[::2])
    return out


def damped(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Square roots of the shares, so that length does not count, times the inverse document frequency."""
    total = np.maximum(counts[:, :BUCKETS].sum(1, keepdims=True), 1)
    words = np.maximum(counts[:, BUCKETS + 3 : BUCKETS + 11].sum(1, keepdims=True), 1)
    x = np.sqrt(np.hstack([counts[:, :BUCKETS] / total, counts[:, BUCKETS:] / words])) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


@dataclass
class Space:
    """The latent space and its labelled vectors (unit length)."""

    idf: np.ndarray | None = None
    basis: np.ndarray | None = None
    vectors: np.ndarray | None = None
    labels: np.ndarray | None = None

    def latent(self, counts: np.ndarray) -> np.ndarray:
        v = damped(counts, self.idf) @ self.basis
        return (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)).astype(np.float32)

    def scores(self, counts: np.ndarray, voters: int) -> np.ndarray:
        if self.vectors is None:
            return np.full(len(counts), 0.5)
        cosine = self.latent(counts) @ self.vectors.T
        k = min(voters, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 1e-6).astype(float) ** 8
        return (weight * self.labels[near]).sum(1) / weight.sum(1)


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1, sample: int = SAMPLE) -> Space:
    """The space, learned from labelled rows whose checksum mod ``modulus`` is not ``remainder``."""
    rows = labelled_sample(docs, labels, "quality", modulus, remainder, sample)

    def vectors(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, BLOCK):
                part = batch.slice(k, BLOCK)
                counts = count_vectors(part.column(0))
                yield pa.record_batch([pa.array([c.tobytes() for c in counts], pa.binary()), part.column(1)], names=["x", "y"])

    got = sorted((bytes(r.x), r.y) for r in rows.mapInArrow(vectors, "x binary, y int").collect())  # at most sample vectors
    if not got:
        return Space()
    counts = np.frombuffer(b"".join(x for x, _ in got), np.float32).reshape(len(got), -1)
    idf = np.log((1 + len(got)) / (1 + (counts > 0).sum(0))) + 0.2
    x = damped(counts, idf)
    values, basis = np.linalg.eigh(x.T @ x)  # right singular vectors of x
    space = Space(idf, basis[:, ::-1][:, :LATENT])
    space.vectors, space.labels = space.latent(counts), np.array([float(y > 0) for _, y in got])
    return space


def score_documents(docs: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1, voters: int = VOTERS, **params) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of docs."""
    space = sent(docs.sparkSession, fit(docs, labels, modulus, remainder, **params))

    def score(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, BLOCK):
                part = batch.slice(k, BLOCK)
                s = np.round(space.value.scores(count_vectors(part.column(1)), voters), 6)
                cols = [part.column(0), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))]
                yield pa.record_batch(cols, names=["doc_id", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, score double, predicted int")
    return rows.select("doc_id", checksum_is(modulus, remainder).alias("held_out"), "score", "predicted")
