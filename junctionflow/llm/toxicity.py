"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

1. Voters. Terms (words, and word beginnings as patterns) that speak for or
   against toxicity are mined from a bounded sample of labelled rows and dealt into
   many lexicons; each lexicon votes when a document holds one of its terms.
   Surface patterns (capitals, exclamation marks, ...) vote as well.
2. Label model. Each voter is a noisy channel of the unknown label: class prior and
   vote probabilities are estimated by expectation maximisation over the votes of
   the sample and of further rows without a label, started from the labelled rates.
   The given labels only start it: they are no voter. Correlations between voters that remain
   when the label is known are estimated from the residuals; a voter's evidence
   is divided by how much of it other voters repeat.
3. Classifier. A logistic regression on term presence learns the label model's
   posterior. It scores every whole text; labels, language, source and id are never
   inputs of a score.

Cases: null, empty and wordless texts get the score of a document without terms;
rows without an id are scored (and not held out); repeated rows get equal scores;
without any usable label every score is 0; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._bytes import LOWER_BYTES
from ._labels import checksum_is, labelled_sample
from ._store import give_back, sent, tidy

#: Labelled rows, and rows without a label, that the model is fitted on, at most.
SAMPLE, UNLABELLED = 12_000, 6_000
#: Terms that are kept, and lexicons that each side's terms are dealt into.
TERMS, LEXICONS = 512, 24
#: Documents of the sample that a term must occur in, and the standard errors that its rates must differ by.
LEAST_DOCS, LEAST_Z = 4, 4.0
#: How often given labels are taken to be wrong: where the estimates start, and their noise where they are to vote.
LABEL_NOISE = 0.02
BEGINNINGS = (3, 4, 5, 6, 7, 8)
EDGES = b".,;:!?\"'()[]{}<>|*#$%&-_"
#: Words that a task remembers the terms of; a full memory starts anew.
REMEMBERED = 30_000
#: Terms that a task counts before it passes them on.
HELD = 100_000
#: Rows whose part of the gradient is found together.
ROWS = 2048
PATTERNS = ("capitals", "exclamations", "questions", "digits", "symbols", "short")


def terms_of(token: bytes) -> list[str]:
    """The word itself and its beginnings (marked by a star)."""
    word = token.strip(EDGES).decode("utf-8", "replace")
    return [word, *(word[:k] + "*" for k in BEGINNINGS if len(word) > k)] if word else []


def tokens_of(value) -> set[bytes]:
    return set(value.as_buffer().to_pybytes().translate(LOWER_BYTES).split()) if value.is_valid else set()


def patterns_of(value) -> np.ndarray:
    """Which surface patterns hold; none in an empty text."""
    text = value.as_buffer().to_pybytes() if value.is_valid else b""
    if not text:
        return np.zeros(len(PATTERNS), bool)
    b = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n = len(text)
    symbols = int(b[35:39].sum() + b[42] + b[64] + b[94])
    return np.array([b[65:91].sum() > 0.2 * n, b[33] * 200 > n, b[63] * 200 > n, b[48:58].sum() > 0.05 * n, symbols > 0.02 * n, n < 200])


def mined_terms(sample: DataFrame, terms: int = TERMS) -> list[tuple[str, int, int]]:
    """(term, toxic documents, other documents) of the terms that tell most about the label."""

    def count(batches):
        seen = (Counter(), Counter())

        def flush():
            words = [*(seen[0].keys() | seen[1].keys())]
            cols = [pa.array(words, pa.string()), *(pa.array([s[w] for w in words], pa.int64()) for s in (seen[1], seen[0]))]
            seen[0].clear(), seen[1].clear()
            return pa.record_batch(cols, names=["term", "p", "n"])

        for batch in batches:
            for text, y in zip(batch.column(0), batch.column(1).to_pylist()):
                found: set[str] = set()
                for token in tokens_of(text):
                    found.update(terms_of(token))
                seen[y > 0].update(found)
                if len(seen[0]) + len(seen[1]) > HELD:
                    yield flush()
        yield flush()
        give_back()

    total = sample.agg(F.sum("y"), F.count("*")).first()
    pos, neg = int(total[0] or 0), int(total[1]) - int(total[0] or 0)
    rows = sample.mapInArrow(count, "term string, p long, n long").groupBy("term").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    rate_p, rate_n = (F.col("p") + 0.5) / (pos + 1.0), (F.col("n") + 0.5) / (neg + 1.0)
    told = F.abs(F.log(rate_p / rate_n)) * F.abs(rate_p - rate_n)
    share = (F.col("p") + F.col("n")) / max(1, pos + neg)
    error = F.sqrt(share * (1 - share) * (1 / max(1, pos) + 1 / max(1, neg)))
    sure = (F.col("p") + F.col("n") >= LEAST_DOCS) & (F.abs(F.col("p") / max(1, pos) - F.col("n") / max(1, neg)) >= LEAST_Z * error)
    best = rows.filter(sure).orderBy(F.round(told, 9).desc(), "term").limit(terms)
    return [(r.term, r.p, r.n) for r in best.collect()]


@dataclass
class Model:
    """Terms and pattern weights of the fitted classifier."""

    term_ids: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(PATTERNS)))
    bias: float = -np.inf
    memory: dict[bytes, tuple[int, ...]] = field(default_factory=dict)

    def ids(self, value) -> list[int]:
        """Sorted ids of the terms that a text holds."""
        out: set[int] = set()
        for token in tokens_of(value):
            got = self.memory.get(token)
            if got is None:
                if len(self.memory) >= REMEMBERED:
                    self.memory.clear()
                got = self.memory[token] = tuple(i for t in terms_of(token) if (i := self.term_ids.get(t)) is not None)
            out.update(got)
        return sorted(out)

    def free(self) -> None:
        """Forget the words: a worker that idles after its task holds the terms only."""
        self.memory.clear()
        give_back()

    def score(self, value) -> float:
        if self.bias == -np.inf:
            return 0.0
        k = len(self.term_ids)
        z = self.bias + self.weights[self.ids(value)].sum() + self.weights[k:][patterns_of(value)].sum()
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))


def votes_of(x: np.ndarray, terms: list[tuple[str, int, int]], pos: int, neg: int) -> np.ndarray:
    """0/1 votes of each lexicon and pattern (rows x voters).

    Terms go round the lexicons of their side in order of strength, so that
    each lexicon holds strong and weak ones.
    """
    odds = np.array([np.log(((p + 0.5) / (pos + 1)) / ((n + 0.5) / (neg + 1))) for _, p, n in terms])
    votes = []
    for toxic in (True, False):
        members = np.flatnonzero((odds > 0) if toxic else (odds < 0))
        members = members[np.argsort(-np.abs(odds[members]), kind="stable")]
        for k in range(LEXICONS):
            if len(lexicon := members[k::LEXICONS]):
                votes.append(x[:, lexicon].any(axis=1))
    for j in range(len(PATTERNS)):
        votes.append(x[:, len(terms) + j])
    return np.array(votes).T.astype(float)


def label_model(
    votes: np.ndarray, y: np.ndarray, rounds: int = 20, noise: float | None = LABEL_NOISE, known: np.ndarray | None = None
) -> np.ndarray:
    """Posterior probability of label 1 for each row of votes (rows x voters, 0 or 1).

    y, the given labels of the ``known`` rows (default: all), starts the estimates;
    with a ``noise`` it stays one voter that is wrong that often, with None it has
    no say after the start. All other rates are estimated on all rows. Evidence of
    a voter is divided by 1 + the sum of its absolute correlations, given the
    label, with the other voters.
    """
    known = np.ones(len(y), bool) if known is None else known
    post = np.clip(y.astype(float), LABEL_NOISE, 1 - LABEL_NOISE)
    given = np.where(y, 1, -1) * known * (np.log((1 - noise) / noise) if noise else 0.0)
    counted = known.astype(float)  # rows without a label count from the second round on
    for _ in range(rounds):
        ones, zeros = post * counted, (1 - post) * counted
        weight = ones.sum() + 1, zeros.sum() + 1
        prior = weight[0] / sum(weight)
        p1, p0 = ((q @ votes + 0.1) / (w + 0.2) for q, w in zip((ones, zeros), weight))
        residual = (votes - (post[:, None] * p1 + (1 - post)[:, None] * p0)) * counted[:, None]
        spread = np.sqrt((residual**2).sum(0) / counted.sum()) + 1e-9
        rho = np.abs((residual / spread).T @ (residual / spread)) / counted.sum()
        shared = 1 + np.where(rho > 0.1, rho, 0).sum(0) - np.minimum(1, np.diag(rho))
        evidence = votes * np.log(p1 / p0) + (1 - votes) * np.log((1 - p1) / (1 - p0))
        z = np.log(prior / (1 - prior)) + given + (evidence / shared).sum(1)
        post = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        counted = np.ones(len(y))
    return post


def logistic(x: np.ndarray, target: np.ndarray, rounds: int = 300, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on soft targets (Nesterov's gradient steps, classes weighed evenly).

    Gradients are summed in double precision, some rows at a time: the matrix is never held as doubles.
    """
    w = np.zeros(x.shape[1] + 1)
    look, step = w.copy(), 0.0
    x1 = np.ones((len(x), x.shape[1] + 1), np.float32)
    x1[:, :-1] = x
    share = np.clip(target.mean(), 0.01, 0.99)
    each = (np.where(target > 0.5, 0.5 / share, 0.5 / (1 - share)) / len(x)).astype(np.float32)
    rate = 4.0 / max(1.0, float(np.einsum("i,ij,ij->j", each, x1, x1).max() * 4))
    rate = min(rate, 4.0 / max(1e-9, float(each @ np.einsum("ij,ij->i", x1, x1))))
    for t in range(rounds):
        z = 1 / (1 + np.exp(-np.clip(x1 @ look.astype(np.float32), -30, 30)))
        off = (z - target) * each
        grad = sum(off[i : i + ROWS] @ x1[i : i + ROWS].astype(float) for i in range(0, len(x1), ROWS)) + ridge * np.r_[look[:-1], 0.0]
        new = look - rate * grad
        look = new + t / (t + 3) * (new - w)
        w = new
    return w[:-1], float(w[-1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    modulus: int = 5,
    remainder: int = 0,
    sample: int = SAMPLE,
    terms: int = TERMS,
    unlabelled: int = UNLABELLED,
    label_noise: float | None = None,
) -> Model:
    """The classifier, learned from rows whose checksum mod ``modulus`` is not ``remainder``.

    With a ``label_noise`` the given labels also vote (see :func:`label_model`).
    """
    rows = labelled_sample(docs, labels, "toxic", modulus, remainder, sample, unlabelled)
    best = mined_terms(rows.filter("y is not null"), terms)
    probe = sent(rows.sparkSession, Model({t: i for i, (t, _, _) in enumerate(best)}))
    k = len(best)

    def features(batches):
        try:
            for batch in batches:
                out = []
                for t in batch.column(0):
                    bits = np.zeros(k + len(PATTERNS), bool)
                    bits[probe.value.ids(t)] = True
                    bits[k:] = patterns_of(t)
                    out.append(np.packbits(bits).tobytes())
                yield pa.record_batch([pa.array(out, pa.binary()), batch.column(1)], names=["bits", "y"])
        finally:
            probe.value.free()

    # At most sample + unlabelled rows of k + len(PATTERNS) bits; the order of rows does not show in the weights.
    got = sorted((-1 if r.y is None else int(r.y > 0), bytes(r.bits)) for r in rows.mapInArrow(features, "bits binary, y int").collect())
    y, known = np.array([g[0] > 0 for g in got], bool), np.array([g[0] >= 0 for g in got], bool)
    if not known.any():
        return Model()
    width = k + len(PATTERNS)
    x = np.unpackbits(np.frombuffer(b"".join(g[1] for g in got), np.uint8).reshape(len(got), -1), axis=1)[:, :width].astype(bool)
    del got
    tidy(rows.sparkSession)  # the fit's matrices are the most that the driver's Python holds
    pos, neg = int(y.sum()), int((known & ~y).sum())
    if not pos or not neg:
        return Model(bias=4.0 if pos else -4.0, weights=np.zeros(width), term_ids=probe.value.term_ids)
    posterior = label_model(votes_of(x, best, pos, neg), y, noise=label_noise, known=known)
    weights, bias = logistic(x, posterior)
    return Model(probe.value.term_ids, weights, bias)


def score_documents(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0, **params) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of docs."""
    model = sent(docs.sparkSession, fit(docs, labels, modulus, remainder, **params))

    def score(batches):
        try:
            for batch in batches:
                s = np.array([model.value.score(t) for t in batch.column(1)], float)
                cols = [batch.column(0), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))]
                yield pa.record_batch(cols, names=["doc_id", "score", "predicted"])
        finally:
            model.value.free()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, score double, predicted int")
    return rows.select("doc_id", checksum_is(modulus, remainder).alias("held_out"), "score", "predicted")


def without_toxic(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """The documents that are not predicted toxic, same columns.

    Only texts go to the Python workers and only decisions come back: the other
    columns, and the texts that stay, never leave the JVM.
    """
    model = sent(docs.sparkSession, fit(docs, labels, **params))

    @F.arrow_udf("boolean")
    def stays(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for texts in batches:
                yield pa.array([model.value.score(t) < 0.5 for t in texts], pa.bool_())
        finally:
            model.value.free()

    return docs.filter(stays("text"))
