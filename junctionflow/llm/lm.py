"""Language-model scoring: marginal likelihood over all segmentations of a word lattice.

A word is scored by the sum, over all its segmentations, of the product of its
arcs' probabilities, computed left to right in log space. The arcs are the pieces
of an existing subword vocabulary (a public file; its path is a parameter), the
single bytes of a word, so that nothing has probability 0, and the whole word
where the training documents hold it. A word ends with an end arc, so that words
of all lengths together have probability 1.

* Arc weights start from the vocabulary's own scores (unigram log probabilities as
  they are; the rank scores of a merge vocabulary are read as Zipf's law). The
  vocabulary itself is not trained; its scores are re-estimated from expected
  counts over all segmentations of every distinct training word.
* A token is a word or the end of a text. With N training tokens, V of them
  distinct, and D = N + V + 2, the end has probability (its count + 1) / D and a
  word its count / D + (V + 1) / D * lattice (Witten and Bell's share for words
  not seen): as if the whole word were one more arc. Over all words and the end
  this adds up to 1.

Counts are exact and over all training documents. A bounded table of the most
frequent words (HEAD, a parameter) is broadcast; every other word of a document
meets its count and likelihood in a join, so the vocabulary may be of any size.

Cases: null and empty texts have one token, the end; rows without an id are
training rows (their checksum is null) and are scored; repeated rows are counted
and scored each; an empty corpus has no words and an empty result; other columns
are ignored. Very long texts are scored whole, and so is a word of many megabytes:
its cost is in proportion to its bytes, and the arcs of one section are held at a time.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._bytes import BYTE_VALUE, LOWER_BYTES, MULT, U64, mix, powers, prefix_hash, range_hash
from ._store import written

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Most frequent words whose scores are broadcast.
HEAD = 1 << 17
#: Bytes of a word from which on it is swept alone, and bytes of such a word whose arcs are held at a time.
LONG, SECTION = 65, 1 << 16
LOG10 = math.log(10)


def vocabulary(path: str) -> dict[bytes, float]:
    """Pieces (UTF-8, without the word mark) and the weights that the file's scores give."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    ranked = all(s == round(s) for _, s in rows)  # a merge vocabulary numbers its pieces
    out: dict[bytes, float] = {}
    for piece, score in rows:
        key = piece.replace("▁", "").lower().encode()
        if key:
            out[key] = out.get(key, 0.0) + (1.0 / (10.0 - score) if ranked else math.exp(score))
    return out


class Lattice:
    """Arc log probabilities and the recursions over words, many words of one length at a time.

    Arcs are the 256 bytes and the vocabulary's pieces, found by hash in a table
    of two probes; a word ends with an end arc. Long words, of which few share a
    length, are swept one by one: their arcs are found for all places of a section
    at once, and the forward values are carried from section to section.
    """

    def __init__(self, pieces: list[bytes], weights: np.ndarray, end: float):
        self.pieces, self.log_end = pieces, math.log(end)
        self.logs = np.log(weights / weights.sum() * (1 - end))
        self.longest = max(map(len, pieces), default=1)
        self.sizes = sorted({len(p) for p in pieces})
        self._place(self._hash(pieces).tolist())

    def _place(self, hashes: list[int]) -> None:
        """A cuckoo table: every hash stands in one of its two slots; a new one may push others to their second slot."""
        size = 1 << max(4, (4 * len(hashes)).bit_length())
        while True:
            slots: dict[int, int] = {}
            for k in range(len(hashes)):
                at = hashes[k] & (size - 1)
                for _ in range(200):
                    k, slots[at] = slots.get(at, -1), k
                    if k < 0:
                        break
                    one, two = hashes[k] & (size - 1), (hashes[k] >> 32) & (size - 1)
                    at = two if at == one else one
                else:
                    break
            else:
                break
            size *= 2
        self.keys, self.ids = np.zeros(size, U64), np.full(size, -1, np.int32)
        for at, k in slots.items():
            self.keys[at], self.ids[at] = hashes[k], 256 + k

    @staticmethod
    def _hash(words: list[bytes]) -> np.ndarray:
        buf = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words]).astype(np.int64)
        return range_hash(prefix_hash(buf), np.r_[0, ends[:-1]].astype(np.int64), ends) if words else np.empty(0, U64)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """The arc of each hash, -1 where there is none."""
        size = U64(len(self.keys) - 1)
        one, two = (h & size).astype(np.int64), ((h >> U64(32)) & size).astype(np.int64)
        return np.where(self.keys[one] == h, self.ids[one], np.where(self.keys[two] == h, self.ids[two], -1))

    def _arcs(self, text: np.ndarray) -> list[list[tuple[int, np.ndarray, np.ndarray]]]:
        """By end position: (start, which words, arc) of all arcs, the byte arc first."""
        m, n = text.shape
        power, inv = powers(n + 1)
        prefix = np.zeros((n + 1, m), U64)
        np.cumsum(BYTE_VALUE[text.T] * power[:n, None], axis=0, out=prefix[1:])
        everyone = np.arange(m)
        out = []
        for j in range(1, n + 1):
            arcs = [(j - 1, everyone, text[:, j - 1].astype(np.int64))]
            for i in range(max(0, j - self.longest), j):
                h = mix((prefix[j] - prefix[i]) * inv[i] + U64((j - i) * int(MULT[63]) % (1 << 64)))
                found = self._find(h)
                who = np.flatnonzero(found >= 0)
                if len(who):
                    arcs.append((i, who, found[who].astype(np.int64)))
            out.append(arcs)
        return out

    def _forward(self, arcs, m: int) -> np.ndarray:
        """Log of the summed probability of all segmentations of each prefix."""
        a = np.full((len(arcs) + 1, m), -np.inf)
        a[0] = 0.0
        for j, into in enumerate(arcs, 1):
            for i, who, arc in into:
                a[j, who] = np.logaddexp(a[j, who], a[i, who] + self.logs[arc])
        return a

    def _by_length(self, words: list[bytes]):
        sizes = np.array([len(w) for w in words])
        order = np.argsort(sizes, kind="stable")
        at = np.flatnonzero(np.r_[True, np.diff(sizes[order]) > 0, True]) if len(words) else [0]
        for lo, hi in zip(at[:-1], at[1:]):
            n = int(sizes[order[lo]])
            step = max(1, 200_000 // n)
            for k in range(lo, hi, step):
                who = order[k : min(hi, k + step)]
                yield who, np.frombuffer(b"".join(words[w] for w in who), np.uint8).reshape(len(who), n)

    def _section(self, word: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, arcs, first arc by end) of all arcs of one word that end in lo + 1 .. hi, by their end."""
        base = max(0, lo + 1 - self.longest)
        prefix = prefix_hash(word[base:hi])
        start, end, arc = [np.arange(lo, hi)], [np.arange(lo + 1, hi + 1)], [word[lo:hi].astype(np.int64)]
        for size in self.sizes:
            at = np.arange(max(0, lo + 1 - size), hi - size + 1)
            if len(at):
                found = self._find(range_hash(prefix, at - base, at - base + size))
                k = np.flatnonzero(found >= 0)
                start.append(at[k])
                end.append(at[k] + size)
                arc.append(found[k].astype(np.int64))
        ends = np.concatenate(end)
        order = np.argsort(ends, kind="stable")
        first = np.searchsorted(ends[order], np.arange(lo + 1, hi + 2))
        return np.concatenate(start)[order], np.concatenate(arc)[order], first

    def _forward_long(self, word: np.ndarray) -> list[float]:
        """:meth:`_forward` of one word."""
        exp, log = math.exp, math.log
        a = [0.0] * (len(word) + 1)
        for lo in range(0, len(word), SECTION):
            start, arc, first = self._section(word, lo, min(len(word), lo + SECTION))
            i, w, first = start.tolist(), self.logs[arc].tolist(), first.tolist()
            for j, (k, m) in enumerate(zip(first, first[1:]), lo + 1):
                if m == k + 1:
                    a[j] = a[i[k]] + w[k]
                else:
                    into = [a[x] + y for x, y in zip(i[k:m], w[k:m])]
                    top = max(into)
                    a[j] = top + log(sum([exp(t - top) for t in into]))
        return a

    def _expected_long(self, word: np.ndarray) -> np.ndarray:
        """:meth:`expected` of one word: the sections again, from the last to the first."""
        exp, log1p = math.exp, math.log1p
        n = len(word)
        a, b = np.array(self._forward_long(word)), [-math.inf] * n + [0.0]
        total = np.zeros(len(self.logs))
        for lo in reversed(range(0, n, SECTION)):
            hi = min(n, lo + SECTION)
            start, arc, first = self._section(word, lo, hi)
            i, w, at = start.tolist(), self.logs[arc].tolist(), first.tolist()
            for j in range(hi, lo, -1):
                bj = b[j]
                for k in range(at[j - lo - 1], at[j - lo]):
                    x, y = b[i[k]], w[k] + bj
                    if x < y:
                        x, y = y, x
                    b[i[k]] = x + log1p(exp(y - x))
            ends = np.repeat(np.arange(lo + 1, hi + 1), np.diff(first))
            share = a[start] + self.logs[arc] + np.array(b[lo + 1 : hi + 1])[ends - lo - 1] - a[n]
            total += np.bincount(arc, np.exp(share), len(total))
        return total

    def likelihoods(self, words: list[bytes]) -> np.ndarray:
        """Natural log of the marginal probability of each word."""
        out = np.empty(len(words))
        for who, text in self._by_length(words):
            if text.shape[1] >= LONG:
                out[who] = [self._forward_long(word)[-1] + self.log_end for word in text]
            else:
                out[who] = self._forward(self._arcs(text), len(who))[-1] + self.log_end
        return out

    def expected(self, words: list[bytes]) -> np.ndarray:
        """Expected count of every arc over all segmentations of the words."""
        total = np.zeros(len(self.logs))
        for _, text in self._by_length(words):
            m, n = text.shape
            if n >= LONG:
                total += sum(map(self._expected_long, text))
                continue
            arcs = self._arcs(text)
            a = self._forward(arcs, m)
            b = np.full((n + 1, m), -np.inf)
            b[n] = 0.0
            for j in range(n, 0, -1):
                for i, who, arc in arcs[j - 1]:
                    t = self.logs[arc] + b[j, who]
                    total += np.bincount(arc, np.exp(a[i, who] + t - a[n, who]), len(total))
                    b[i, who] = np.logaddexp(b[i, who], t)
        return total


def first_lattice(path: str) -> Lattice:
    pieces = vocabulary(path)
    weights = np.array([*pieces.values()])
    return Lattice([*pieces], np.r_[np.full(256, 0.01 * weights.sum() / 256), weights], 0.25)


def adapted(counts: DataFrame, lattice: Lattice, rounds: int) -> Lattice:
    """The lattice with the vocabulary's scores re-estimated on every distinct training word.

    Each round sums expected arc counts over all segmentations; distinct words
    count once each, as the lattice stands for words that have not been seen.
    What reaches the driver is one number an arc.
    """
    sc = counts.sparkSession.sparkContext
    words = counts.filter("c > 0").select("word")
    n = words.count()
    for _ in range(rounds if n else 0):
        now = sc.broadcast(lattice)

        def expect(batches, now=now):
            total = np.zeros(len(now.value.logs))
            for batch in batches:
                total += now.value.expected(batch.column(0).to_pylist())
            arc = np.flatnonzero(total)
            yield pa.record_batch([pa.array(arc), pa.array(np.rint(total[arc] * 1e6).astype(np.int64))], names=["arc", "e"])

        got = np.zeros(len(lattice.logs))
        for r in words.mapInArrow(expect, "arc long, e long").groupBy("arc").agg(F.sum("e").alias("e")).collect():
            got[r.arc] = r.e / 1e6
        prior = np.exp(lattice.logs)
        weights = got + len(got) * prior / prior.sum()
        lattice = Lattice(lattice.pieces, weights, n / (n + weights.sum()))
    return lattice


def held_out(modulus: int, remainder: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def _words(batch_text) -> Counter:
    return Counter(batch_text.as_buffer().to_pybytes().translate(LOWER_BYTES).split()) if batch_text.is_valid else Counter()


def word_counts(docs: DataFrame, held: int = 400_000) -> DataFrame:
    """(word, c) of every distinct word of docs (text, held_out): its count in the training rows, 0 if only others have it.

    Tasks add up their own words first and hold at most about ``held`` of them.
    """

    def count(batches):
        train: Counter = Counter()
        other: set[bytes] = set()

        def flush():
            words = [*train, *(other - train.keys())]
            c = [*train.values(), *[0] * (len(words) - len(train))]
            train.clear()
            other.clear()
            return pa.record_batch([pa.array(words, pa.binary()), pa.array(c, pa.int64())], names=["word", "c"])

        for batch in batches:
            for text, out in zip(batch.column(0), batch.column(1).to_pylist()):
                (other if out else train).update(_words(text))
                if len(train) + len(other) > held:
                    yield flush()
        yield flush()

    return docs.select("text", "held_out").mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Scores:
    """log10 probabilities of a token under the add-one unigram and under the lattice model."""

    def __init__(self, lattice: Lattice, tokens: int, distinct: int, ends: int, word_arcs: bool = True):
        self.lattice, self.n, self.v, self.ends, self.word_arcs = lattice, tokens, distinct, ends, word_arcs
        self.d = tokens + distinct + 2.0

    def base(self, c):
        return np.log10((c + 1) / (self.n + 1.0 * (self.v + 1)))

    def end(self) -> float:
        return math.log10((self.ends + 1) / self.d)

    def words(self, words: list[bytes], c: np.ndarray) -> np.ndarray:
        marginal = self.lattice.likelihoods(words)
        if not self.word_arcs:
            return (math.log1p(-(self.ends + 1) / self.d) + marginal) / LOG10
        sub = math.log((self.v + 1) / self.d) + marginal
        with np.errstate(divide="ignore"):
            return np.logaddexp(np.log(c / self.d), sub) / LOG10


def score_documents(
    docs: DataFrame, path: str = VOCABULARY, modulus: int = 7, remainder: int = 2, head: int = HEAD, rounds: int = 2, word_arcs: bool = True
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of docs, in the order of doc_id.

    Training rows are those whose crc32(doc_id as text) mod ``modulus`` is not
    ``remainder``. ``base_score`` is the add-one unigram over the words and one end,
    ``score`` the lattice model's log10 probability of the same tokens. Without
    ``word_arcs`` whole training words are no arcs, and with 0 ``rounds`` the
    vocabulary's scores weigh the segmentations as they are.
    """
    sc = docs.sparkSession.sparkContext
    slim = docs.select("doc_id", "text", held_out(modulus, remainder).alias("held_out"))
    counts = written(word_counts(slim), "word-counts")
    ends = slim.filter("not held_out").count()
    known, tokens = counts.filter("c > 0").agg(F.count("*"), F.sum("c")).first()
    n = int(tokens or 0) + ends
    lattice = adapted(counts, first_lattice(path), rounds)
    scores = sc.broadcast(Scores(lattice, n, int(known) + (ends > 0), ends, word_arcs))

    def likelihoods(batches):
        m = scores.value
        for batch in batches:
            c = batch.column(1).to_numpy()
            score = m.words(batch.column(0).to_pylist(), c)
            yield pa.record_batch([*batch.columns, pa.array(m.base(c)), pa.array(score)], names=["word", "c", "b", "s"])

    frequent = counts.orderBy(F.desc("c"), "word").limit(head).mapInArrow(likelihoods, "word binary, c long, b double, s double")
    top = sc.broadcast({bytes(r.word): (int(r.c > 0), r.b, r.s) for r in frequent.collect()})

    def split(batches):
        """A document's sums over its frequent words and its end, and its other words."""
        most, m = top.value, scores.value
        for batch in batches:
            sums: list[list] = [[], [], [], []]
            words_of, times_of = [], []
            for text in batch.column(1):
                words = _words(text)
                k, b, s = int(m.ends > 0), float(m.base(m.ends)), m.end()
                rest, times = [], []
                for w, t in words.items():
                    hit = most.get(w)
                    if hit:
                        k, b, s = k + t * hit[0], b + t * hit[1], s + t * hit[2]
                    else:
                        rest.append(w)
                        times.append(t)
                for o, x in zip(sums, (sum(words.values()) + 1, k, b, s)):
                    o.append(x)
                words_of.append(rest)
                times_of.append(times)
            yield pa.record_batch(
                [
                    batch.column(0), batch.column(2), pa.array(sums[0], pa.int64()), pa.array(sums[1], pa.int64()),
                    pa.array(sums[2], pa.float64()), pa.array(sums[3], pa.float64()),
                    pa.array(words_of, pa.list_(pa.binary())), pa.array(times_of, pa.list_(pa.int32())),
                ],
                names=["doc_id", "held_out", "tokens", "k", "b", "s", "words", "times"],
            )

    schema = "doc_id long, held_out boolean, tokens long, k long, b double, s double, words array<binary>, times array<int>"
    slim = slim.withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = written(slim.mapInArrow(split, schema).withColumn("row", F.monotonically_increasing_id()), "document-words")
    rest = rows.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", F.col("w.words").alias("word"), "w.times")
    others = counts.mapInArrow(likelihoods, "word binary, c long, b double, s double").withColumnRenamed("word", "key")
    met = rest.join(others, F.col("word") == F.col("key")).select(
        "row", F.when(F.col("c") > 0, F.col("times")).otherwise(0).alias("k2"), (F.col("times") * F.col("b")).alias("b2"), (F.col("times") * F.col("s")).alias("s2")
    )
    per = met.groupBy(F.col("row").alias("r")).agg(F.sum("k2").alias("k2"), F.sum("b2").alias("b2"), F.sum("s2").alias("s2"))
    out = rows.drop("words", "times").join(per, F.col("row") == F.col("r"), "left")
    plus = lambda x, y: F.col(x) + F.coalesce(F.col(y), F.lit(0))
    return out.orderBy("doc_id", "row").select(
        "doc_id",
        "held_out",
        F.col("tokens").alias("n_tokens"),
        plus("k", "k2").cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        F.round(plus("b", "b2"), 6).alias("base_score"),
        F.round(plus("s", "s2"), 6).alias("score"),
    )
