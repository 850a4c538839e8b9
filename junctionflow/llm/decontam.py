"""Benchmark decontamination with a generalised suffix automaton of the test items.

Items are cut into overlapping pieces and these dealt into blocks of a bounded
number of words; one task per block builds the automaton of its pieces, which is
written and then broadcast as bytes. Every document is streamed through each
block's automaton; a task holds one automaton at a time, and the driver the bytes
of one. Each executor's disk gets the bytes of all. Two neighbouring words that follow each other in no item end every
match, so only runs of known word pairs are streamed; the longest matching
length is tracked there, and a match of at least ``width`` words (or of a whole
shorter item) marks its words.

Cases: null texts and texts without words match nothing; an item without words
is never reported; items of equal text are all reported; items of null id are
left out of the report and cut by :func:`decontaminated`; an empty benchmark contaminates nothing; repeated document rows are scored
alike; other columns are ignored (:func:`decontaminated` keeps them).
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._bytes import ALNUM, U64, column_bytes, combine, word_hashes
from ._store import sent, written

#: Words of a window.
WIDTH = 10
#: Words of the pieces of one automaton, which bounds what a task holds at a time.
BLOCK_WORDS = 500_000
#: Documents that a task streams through one automaton after the other, where there are several.
GATHERED_BYTES = 32 << 20


class ItemAutomaton:
    """Suffix automaton of several word sequences; no match runs across two of them."""

    def __init__(self, items: list[tuple[str, np.ndarray]], width: int):
        self.width = width
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        self.ends: dict[int, set[int]] = {}
        self.names = [name for name, _ in items]
        pairs = [combine(words, 2) for _, words in items]
        self.pairs = np.unique(np.concatenate([*pairs, np.empty(0, U64)]))
        self.singles = {int(words[0]): [] for _, words in items if len(words) == 1}
        for k, (_, words) in enumerate(items):
            if len(words) == 1:
                self.singles[int(words[0])].append(k)
            last = 0
            for w in words.tolist():
                last = self._add(last, w)
        for k, (_, words) in enumerate(items):
            self._mark(k, words.tolist())

    def _add(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._split(last, w, q)
        cur = len(length)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, w, q)
        return cur

    def _split(self, p: int, w: int, q: int) -> int:
        copy = len(self.len)
        self.next.append(dict(self.next[q]))
        self.len.append(self.len[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _mark(self, k: int, words: list[int]) -> None:
        """Names item k at the state of each of its windows; a state holds one window, as windows of one state are equal."""
        width = min(self.width, len(words))
        if width < 2:
            return
        state, n = 0, 0
        for w in words:
            state, n = self._step(state, n, w)
            if n >= width:
                self.ends.setdefault((self._at(state, width), width), set()).add(k)

    def _at(self, state: int, n: int) -> int:
        """The state of the last n words of a match that ends in state."""
        while self.len[self.link[state]] >= n:
            state = self.link[state]
        return state

    def _step(self, state: int, n: int, w: int) -> tuple[int, int]:
        while state and w not in self.next[state]:
            state = self.link[state]
            n = self.len[state]
        to = self.next[state].get(w)
        return (0, 0) if to is None else (to, n + 1)

    def finish(self) -> "ItemAutomaton":
        self.widths = sorted({w for _, w in self.ends})
        self.ends = {k: tuple(v) for k, v in self.ends.items()}
        return self

    def run(self, words: list[int], at: int, marks: np.ndarray, found: set[int]) -> None:
        """Stream words (a run of known pairs, from position ``at``); add to marks (a difference array) and found items."""
        state = n = 0
        for i, w in enumerate(words, at + 1):
            state, n = self._step(state, n, w)
            best = 0
            for width in self.widths:
                if width > n:
                    break
                items = self.ends.get((self._at(state, width), width))
                if items:
                    found.update(items)
                    best = width
            if best:
                marks[i - best] += 1
                marks[i] -= 1

    def hits(self, words: np.ndarray) -> tuple[np.ndarray, set[int]]:
        """(which words are hit, indexes of the items found) of one document."""
        found: set[int] = set()
        marks = np.zeros(len(words) + 1, np.int32)
        if self.singles:
            for i in np.flatnonzero(np.isin(words, np.fromiter(self.singles, U64))).tolist():
                found.update(self.singles[int(words[i])])
                marks[i] += 1
                marks[i + 1] -= 1
        if len(self.pairs) and len(words) > 1:
            pairs = combine(words, 2)
            place = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
            known = np.concatenate([[False], self.pairs[place] == pairs, [False]])
            edges = np.flatnonzero(known[1:] != known[:-1])
            shortest = self.widths[0] if self.widths else self.width
            for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist()):
                if hi - lo + 1 >= shortest:
                    self.run(words[lo : hi + 1].tolist(), lo, marks, found)
        return np.cumsum(marks[:-1]) > 0, found


def pieces(benchmark: DataFrame, width: int, most: int) -> DataFrame:
    """(item, part, n, words) of every item with words: its word hashes in pieces of at most ``most`` words.

    Neighbouring pieces share width - 1 words, so that every window lies in one.
    """

    def cut(batches):
        for batch in batches:
            out: list[list] = [[], [], [], []]
            names = iter(batch.column(0).to_pylist())
            for _, words, at in word_hashes(batch.column(1), ALNUM):
                for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                    name = next(names)
                    for part, k in enumerate(range(a, max(a + 1, b - width + 1), most - width + 1) if b > a else ()):
                        end = min(k + most, b)
                        for o, v in zip(out, (name, part, end - k, words[k:end].tobytes())):
                            o.append(v)
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary())
            yield pa.record_batch([pa.array(o, k) for o, k in zip(out, kinds)], names=["item", "part", "n", "words"])

    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    return items.mapInArrow(cut, "item string, part long, n long, words binary")


def automata(benchmark: DataFrame, width: int = WIDTH, block_words: int = BLOCK_WORDS) -> tuple[int, DataFrame]:
    """(number of blocks, written table of (block, pickled automaton)).

    A block is a hash bucket of pieces. With several blocks a piece has at most a
    quarter of ``block_words`` and the mean bucket half, so that few pass it.
    """
    parts = written(pieces(benchmark, width, max(block_words // 4, 2 * width)), "item-pieces")
    total = parts.agg(F.sum("n")).first()[0] or 0
    blocks = 1 if total <= block_words else -(-2 * total // block_words)

    def build(group: pa.Table) -> pa.Table:
        named = [(n, np.frombuffer(w, U64)) for n, w in zip(group["item"].to_pylist(), group["words"].to_pylist())]
        model = pickle.dumps(ItemAutomaton(named, width).finish())
        return pa.table({"block": group["block"][:1], "model": pa.array([model], pa.binary())})

    dealt = parts.withColumn("block", F.pmod(F.xxhash64("item", "part", "words"), F.lit(blocks))).repartition(blocks, "block")
    return blocks, written(dealt.groupBy("block").applyInArrow(build, "block long, model binary"), "automata")


def gathered(batches, most: int):
    """Lists of batches of about ``most`` bytes together."""
    some, held = [], 0
    for batch in batches:
        some.append(batch)
        held += batch.nbytes
        if held >= most:
            yield some
            some, held = [], 0
    if some:
        yield some


def _marking(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_words: int = BLOCK_WORDS):
    """The function on batches of docs that adds the columns of :func:`find_hits`."""
    blocks, table = automata(benchmark, width, block_words)
    # One at a time through the driver, which keeps them in files as the executors do.
    found_models = (table.filter(F.col("block") == k).select("model").first() for k in range(blocks))
    models = [sent(docs.sparkSession, bytes(r.model)) for r in found_models if r is not None]
    at = docs.columns.index("text")
    names = [*docs.columns, "__n_words", "__n_hit", "__items", "__hits"]

    def rows(batches):
        only = pickle.loads(models[0].value) if len(models) == 1 else None
        for some in gathered(batches, 0 if only else GATHERED_BYTES):
            texts = [
                words[lo:hi]
                for batch in some
                for _, words, cuts in word_hashes(batch.column(at), ALNUM)
                for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist())
            ]
            hits, items = [np.zeros(len(t), bool) for t in texts], [set() for _ in texts]
            for m in models:
                auto = only or pickle.loads(m.value)
                if not only:
                    del m._value  # what a broadcast keeps once it is read; the next use reads its file again
                for k, t in enumerate(texts):
                    if len(t):
                        hit, found = auto.hits(t)
                        hits[k] |= hit
                        items[k].update(auto.names[f] for f in found)
                del auto
            k = 0
            for batch in some:
                own, named = hits[k : k + batch.num_rows], items[k : k + batch.num_rows]
                k += batch.num_rows
                yield pa.record_batch(
                    [
                        *batch.columns, pa.array([len(h) for h in own], pa.int64()), pa.array([int(h.sum()) for h in own], pa.int64()),
                        pa.array([sorted(i - {None}) for i in named], pa.list_(pa.string())),
                        pa.array([h.astype(np.uint8).tobytes() if h.any() else None for h in own], pa.binary()),
                    ],
                    names=names,
                )

    return rows


def find_hits(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """docs with ``__n_words``, ``__n_hit``, ``__items`` (ids, sorted) and ``__hits`` (a byte a word, 1 where hit; null if none is).

    Items of null id mark their words like any other; there is no id to report for them.
    """
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(_marking(docs, benchmark, **params), f"{kinds}, __n_words long, __n_hit long, __items array<string>, __hits binary")


def contamination(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """(doc_id, n_words, n_hit, items, contaminated) of every document."""
    found = find_hits(docs.select("doc_id", "text"), benchmark, **params)
    return found.select(
        "doc_id",
        F.col("__n_words").alias("n_words"),
        F.col("__n_hit").alias("n_hit"),
        F.col("__items").alias("items"),
        (F.col("__n_hit") > 0).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, max_coverage: float = 0.5, **params) -> DataFrame:
    """The documents without their hit spans, same columns.

    A span runs from its first hit word to its last and takes the characters
    between them along; it is replaced by a space. A document of which more than
    ``max_coverage`` of the words are hit is dropped whole.
    """
    names, kinds = docs.columns, docs.schema
    at = names.index("text")

    def cut(batches):
        for batch in batches:
            data, offsets = column_bytes(batch.column(at))
            marks, texts, keep = batch.column(batch.num_columns - 1), [], []
            for i, m in enumerate(marks):
                if not m.is_valid:
                    texts.append(batch.column(at)[i].as_py())
                    keep.append(True)
                    continue
                hit = np.frombuffer(m.as_buffer(), np.uint8)
                buf = data[offsets[i] : offsets[i + 1]]
                w = ALNUM[buf]
                start, end = np.flatnonzero(w & ~np.r_[False, w[:-1]]), np.flatnonzero(w & ~np.r_[w[1:], False]) + 1
                edge = np.flatnonzero(np.diff(np.r_[0, hit, 0]))
                out, last = [], 0
                for a, b in zip(edge[::2], edge[1::2]):
                    out.append(buf[last : start[a]].tobytes())
                    last = int(end[b - 1])
                out.append(buf[last:].tobytes())
                texts.append(b" ".join(out).decode("utf-8", "replace"))
                keep.append(float(hit.mean()) <= max_coverage)
            cols = list(batch.columns[: len(names)])
            cols[at] = pa.array(texts, pa.string())
            yield pa.record_batch(cols, names=names).filter(pa.array(keep))

    mark = _marking(docs, benchmark, **params)
    # One Python function: a second one in the same task would take a second worker, which stays with the executor.
    return docs.mapInArrow(lambda batches: cut(mark(batches)), kinds)
