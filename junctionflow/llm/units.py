"""Line hashing: every repeated line or sentence but its earliest ranked occurrence is removed, offsets kept.

Units are lines (or paragraphs, with another separator) and, because a repeated
passage may stand inside a longer line, the sentences of lines: pieces that end
after a run of . ! ? or their ideographic forms. Units are normalised (words
joined by single spaces, A-Z lower-cased) and hashed; digests are grouped over
the whole corpus with partial aggregates, and each digest keeps the occurrence
with the least (doc_id, start). A repeated line goes whole; of other lines the
repeated sentences go. Every line with a word counts, in any script; a sentence
counts from SENTENCE code points on, as shorter ones are common phrases rather
than copied passages.

Cases: a null or empty text is one empty line; a line without words always
stays; rows without an id are neither compared nor cut; rows that share an id
and a text are one text, so that each keeps what the other keeps; rows that
share an id with different texts are cut each by its own units (of one unit that
starts at the same place in several of them, all stay); very long texts are
hashed and cut one at a time; an empty table gives an empty result; only doc_id
and text are read, other columns are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._bytes import LOWER_BYTES, digest16
from ._store import written

#: Code points of a normalised sentence from which on it counts as a unit.
SENTENCE = 40
_SENTENCES = re.compile("[^.!?。！？]*[.!?。！？]+|[^.!?。！？]+")


def unit_text(unit: str) -> bytes:
    """A unit's words joined by single spaces, A-Z lower-cased."""
    return b" ".join(unit.encode().translate(LOWER_BYTES).split())


def units_of(text: str, separator: str, sentence: int | None):
    """(digest or None, start, end, is a line) of every line and counted sentence; a line comes before its sentences."""
    at = 0
    for line in text.split(separator):
        key = unit_text(line)
        yield (digest16(b"l" + key) if key else None), at, at + len(line), True
        if sentence is not None and len(line) >= sentence:
            for m in _SENTENCES.finditer(line):
                key = unit_text(m.group())
                if len(key) >= sentence and len(key.decode()) >= sentence:
                    yield digest16(b"s" + key), at + m.start(), at + m.end(), False
        at += len(line) + len(separator)


def repeated_units(docs: DataFrame, separator: str = "\n", sentence: int | None = SENTENCE) -> DataFrame:
    """(doc_id, of, start, end, line) of every unit that has an earlier occurrence: code points, and whether it is a line.

    ``of`` is the text's hash.
    ``sentence`` is the least length of sentences that count (None: lines only).
    """

    def hashed(batches):
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for i, of, t in zip(*(c.to_pylist() for c in batch.columns)):
                for key, start, end, line in units_of(t or "", separator, sentence):
                    if key:
                        for o, v in zip(out, (key, i, of, start, end, line)):
                            o.append(v)
                if len(out[0]) > 20_000:
                    yield pa.record_batch([pa.array(o, k) for o, k in zip(out, kinds)], names=names)
                    out = [[] for _ in names]
            yield pa.record_batch([pa.array(o, k) for o, k in zip(out, kinds)], names=names)

    kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
    names = ["unit", "doc_id", "of", "start", "end", "line"]
    slim = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("of"), "text")
    units = written(slim.mapInArrow(hashed, "unit binary, doc_id long, of long, start long, end long, line boolean"), "units")
    first = units.groupBy(F.col("unit").alias("u")).agg(F.min(F.struct("doc_id", "start")).alias("first"), F.count("*").alias("times"))
    # Written, so that the join has a plain shuffle on both sides and a hot unit's partition can be split.
    first = written(first.filter("times > 1"), "first-units")
    later = units.join(first, F.col("unit") == F.col("u")).filter(F.struct("doc_id", "start") > F.col("first"))
    return later.select("doc_id", "of", "start", "end", "line")


def _texts(docs: DataFrame) -> DataFrame:
    """(doc_id, of, body): texts compressed for the shuffle, with their hash."""

    def pack(batches):
        c = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = (t.as_buffer() if t.is_valid else b"" for t in batch.column(2))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([c.compress(t) for t in texts], pa.binary())], names=["doc_id", "of", "body"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("of"), "text").mapInArrow(pack, "doc_id long, of long, body binary")


def cut_text(text: str, separator: str, sentence: int | None, cuts: set[tuple[int, int, bool]]) -> tuple[int, list[tuple[int, int]], str]:
    """(lines, removed spans, kept text): ``cuts`` holds [start, end) and whether it is a line of the text's repeated units.

    Spans inside a line that goes whole are part of it and not listed.
    """
    lines, removed, kept, gone = 0, [], [], False
    pieces: list[str] = []
    at = upto = 0
    for _, start, end, is_line in units_of(text, separator, sentence):
        if is_line:
            if lines and not gone:
                kept.append("".join(pieces) + text[at:upto])
            lines, pieces, at, upto = lines + 1, [], start, end
            gone = (start, end, True) in cuts
            if gone:
                removed.append((start, end))
        elif not gone and (start, end, False) in cuts:
            pieces.append(text[at:start])
            at = end
            removed.append((start, end))
    if not gone:
        kept.append("".join(pieces) + text[at:upto])
    return lines, removed, separator.join(kept)


def dedup_units(docs: DataFrame, separator: str = "\n", sentence: int | None = SENTENCE) -> DataFrame:
    """(doc_id, removed, n_units, kept): removed units as [start, end) in code points, lines of the text, and what stays."""
    # Dealt by document right after the join, so that a hot unit's join partition can be split.
    gone = repeated_units(docs, separator, sentence).repartition("doc_id", "of").distinct()
    lists = gone.groupBy(F.col("doc_id").alias("id"), F.col("of").alias("text_of")).agg(F.collect_list(F.struct("start", "end", "line")).alias("cuts"))
    same = (F.col("doc_id") == F.col("id")) & (F.col("of") == F.col("text_of"))
    rows = _texts(docs).join(lists, same, "left").select("doc_id", "body", "cuts")
    schema = "doc_id long, removed array<struct<start: long, end: long>>, n_units long, kept string"
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def cut(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            n, removed, kept = [], [], []
            for body, cuts in zip(batch.column(1), batch.column(2).to_pylist()):
                text = unpack.decompress(body.as_buffer()).decode()
                lines, spans, stay = cut_text(text, separator, sentence, {(c["start"], c["end"], c["line"]) for c in cuts or []})
                n.append(lines)
                removed.append([{"start": a, "end": b} for a, b in spans])
                kept.append(stay)
            yield pa.record_batch(
                [batch.column(0), pa.array(removed, pa.list_(span)), pa.array(n, pa.int64()), pa.array(kept, pa.string())],
                names=["doc_id", "removed", "n_units", "kept"],
            )

    return rows.mapInArrow(cut, schema)
