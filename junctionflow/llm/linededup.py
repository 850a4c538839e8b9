"""Line dedup: two Bloom filters find the suspects, one shuffle of suspects decides.

A counting sketch of all line keys gives the once-seen and the twice-seen
filter (level 0 or above). A line that is not in the twice-seen filter occurs
in one document only and never moves. The others are counted exactly by a
128-bit digest of their key, and the holder is chosen; only texts with a
suspect line are shuffled to meet the decisions.

Cases: a null or empty text is one empty line; documents without an id keep all
lines and are not counted; rows that share an id are one document for counting
and each loses the same lines; ties cannot occur (the holder is an id); an empty
table gives an empty result; other columns pass through :func:`drop_repeated_lines`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._bytes import digest16, line_key
from ._sketch import broadcast, count_levels, using
from ._store import written

MIN_CHARS, MIN_DOCS = 40, 5
#: Slots of the sketch, as a power of 2.
LOG2 = 26


def _text(value) -> bytes:
    return value.as_buffer().to_pybytes() if value.is_valid else b""


def _key(line: bytes, min_chars: int) -> bytes | None:
    """Digest of the line's key, or None for a line that is too short to count."""
    if len(line) < min_chars:
        return None
    key = line_key(line)
    if len(key) < min_chars or len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return digest16(key)


def _hash(digests) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.uint64)[::2].copy()


def line_decisions(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, log2: int = LOG2):
    """(levels, decisions): decisions are rows (__id, __drop: digests of the lines that this document loses)."""
    slim = docs.select("doc_id", "text")

    def own(text: bytes) -> set[bytes]:
        keys = {_key(x, min_chars) for x in text.split(b"\n")}
        keys.discard(None)
        return keys

    def hashes(batch):
        for i, t in zip(batch.column(0), batch.column(1)):
            if i.is_valid and (keys := own(_text(t))):
                yield _hash(keys)

    levels = broadcast(docs, count_levels(slim, hashes, log2=log2, probes=2))

    def suspects(seen, batches):
        for batch in batches:
            ids, out = [], []
            for i, t in zip(batch.column(0), batch.column(1)):
                if i.is_valid and (keys := sorted(own(_text(t)))):
                    hit = [k for k, lv in zip(keys, seen.of(_hash(keys))) if lv]
                    ids += [i.as_py()] * len(hit)
                    out += hit
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], names=["doc_id", "line"])

    found = slim.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(using(levels, suspects), "doc_id long, line binary")
    # Rows that share an id count once: first one row an (line, id), then one a line.
    pairs = written(found.distinct(), "line-suspects")
    exact = pairs.groupBy("line").agg(F.count("*").alias("docs"), F.max("doc_id").alias("holder")).filter(F.col("docs") >= min_docs)
    # Written, so that the join has a plain shuffle on both sides and a hot line's partition can be split.
    exact = written(exact, "repeated-lines")
    lost = pairs.alias("p").join(exact.alias("e"), "line").filter("p.doc_id <> e.holder")
    # Dealt by document right after the join, so that a hot line's join partition can be split.
    lost = lost.select(F.col("doc_id").alias("__id"), "line").repartition("__id")
    return levels, lost.groupBy("__id").agg(F.collect_list("line").alias("__drop"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, log2: int = LOG2) -> DataFrame:
    """docs with their kept text, plus ``__n_lines`` (before) and ``__n_dropped``.

    Lines of which the key (ASCII white space stripped at both ends, A-Z
    lower-cased) has at least ``min_chars`` code points and occurs in at least
    ``min_docs`` documents stay only in the document with the largest id.
    """
    levels, lost = line_decisions(docs, min_chars, min_docs, log2)
    at, of_id = docs.columns.index("text"), docs.columns.index("doc_id")
    names = docs.columns

    def split(seen, batches):
        """Marks documents with a suspect line; the others are finished here."""
        for batch in batches:
            n, flag = [], []
            for i, t in zip(batch.column(of_id), batch.column(at)):
                lines = _text(t).split(b"\n")
                keys = [k for k in (_key(x, min_chars) for x in lines) if k]
                n.append(len(lines))
                flag.append(bool(i.is_valid and keys and seen.of(_hash(keys)).any()))
            yield pa.record_batch([*batch.columns, pa.array(n, pa.int64()), pa.array(flag, pa.bool_())], names=[*names, "__n", "__s"])

    def finish(batches):
        for batch in batches:
            drop, texts, gone = batch.column(batch.num_columns - 1), [], []
            for t, d in zip(batch.column(at), drop):
                if not d.is_valid:
                    texts.append(t.as_py())
                    gone.append(0)
                    continue
                out = set(d.as_py())
                lines = _text(t).split(b"\n")
                kept = [x for x in lines if _key(x, min_chars) not in out]
                texts.append(b"\n".join(kept).decode("utf-8", "replace"))
                gone.append(len(lines) - len(kept))
            cols = [*batch.columns[: len(names)], batch.column(len(names)), pa.array(gone, pa.int64())]
            cols[at] = pa.array(texts, pa.string())
            yield pa.record_batch(cols, names=[*names, "__n_lines", "__n_dropped"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    marked = docs.mapInArrow(using(levels, split), f"{kinds}, __n long, __s boolean")
    moved = marked.filter("__s").drop("__s").join(lost, F.col("doc_id") == F.col("__id"), "left").drop("__id")
    # Documents without a suspect line are done: they pass no second Python function.
    done = marked.filter("not __s").select(*names, F.col("__n").alias("__n_lines"), F.lit(0).cast("long").alias("__n_dropped"))
    return done.unionByName(moved.mapInArrow(finish, f"{kinds}, __n_lines long, __n_dropped long"))


def drop_repeated_lines(docs: DataFrame, **params) -> DataFrame:
    """The documents with their kept lines, same columns."""
    return dedup_lines(docs, **params).select(*docs.columns)
