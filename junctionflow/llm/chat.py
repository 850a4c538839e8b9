"""Chat logs folded into final messages and rendered with a reversible template.

A log holds events of messages: ``open`` names a message's role, ``delta``
appends text, ``edit`` replaces the text so far, ``regenerate`` throws it away.
What a run of events does to a message is "append this" or "replace by this",
and two such steps in a row are one again, so a log can be folded in pieces:
events are range-partitioned and sorted by conversation and sequence, and every
task folds its range in one pass. A conversation that lies inside one range is
final there and is rendered at once. Only the first and the last one of a range
can go on in another; their messages' pieces are shuffled by message and joined
in order. A conversation of any size is so spread over as many ranges as it
fills, and one that spans ranges is rendered message by message.

The template writes a turn as ``### role: text</turn>`` and a line feed. Inside
texts and roles a backslash is doubled, and one is put into every ``###`` and
``</turn>`` (and before ``:`` in a role), so control strings stand nowhere else
and taking the backslashes out again gives the text back. The loss mask is a
list of spans, in code points of the part, that cover the assistants' texts.

Cases: events are taken in order of ``seq`` (nulls first); a message's place is
that of its first event, its role the first that is not null (none: empty); null
texts are empty; other kinds of events, and those without a kind, change
nothing but open a message; rows without a message id belong to one message of
their own conversation; a null conversation id is a conversation of its own;
very long texts are held one message at a time (parts end after PART characters,
but no message is split); an empty log gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._store import written

#: Characters after which a part of a conversation ends.
PART = 1 << 20
HEAD, COLON, END = "### ", ": ", "</turn>\n"
LEARNED = "assistant"

_PIECES = "conv_id long, message long, place long, role string, resets boolean, text string, whole boolean, n_messages long, loss array<struct<start: long, end: long>>"
_ROLE = re.compile(r"### ((?:[^\\:]|\\.)*): ", re.S)


def escape(text: str) -> str:
    return re.sub("#(?=##)", r"#\\", text.replace("\\", "\\\\")).replace("</turn>", "<\\/turn>")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """(formatted text, loss spans) of (role, text) turns."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = HEAD + escape(role).replace(":", "\\:") + COLON, escape(text)
        if role == LEARNED:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(out), spans


def read_back(formatted: str) -> Iterator[tuple[str, str]]:
    """The (role, text) turns of a rendered text."""
    for turn in formatted.split(END)[:-1]:
        head = _ROLE.match(turn)
        yield unescape(head.group(1)), unescape(turn[head.end() :])


class _Message:
    """What a run of events does to one message."""

    __slots__ = ("place", "role", "resets", "texts")

    def __init__(self, place: int):
        self.place, self.role, self.resets, self.texts = place, None, False, []

    def take(self, kind: str | None, role: str | None, text: str | None) -> None:
        if self.role is None:
            self.role = role
        if kind in ("edit", "regenerate"):
            self.resets, self.texts = True, []
        if kind in ("delta", "edit") and text:
            self.texts.append(text)


def _record(rows: list[tuple]) -> pa.RecordBatch:
    loss = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.bool_(), pa.int64(), loss)
    names = ["conv_id", "message", "place", "role", "resets", "text", "whole", "n_messages", "loss"]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _spans(spans: list[tuple[int, int]]) -> list[dict]:
    return [{"start": a, "end": b} for a, b in spans]


def _rendered(conv, messages: dict[object, _Message]) -> Iterator[tuple]:
    """Rows of the parts of a conversation that is final."""
    turns, size, first, parts = [], 0, None, []
    for m in messages.values():
        first = m.place if first is None else first
        turns.append((m.role or "", "".join(m.texts)))
        size += len(turns[-1][1])
        if size >= PART:
            parts.append((first, turns))
            turns, size, first = [], 0, None
    if turns:
        parts.append((first, turns))
    for place, turns in parts:
        text, spans = render(turns)
        yield conv, None, place, None, None, text, len(parts) == 1, len(turns), _spans(spans)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One pass over a sorted range: rendered parts of conversations inside it, message pieces of its first and last."""
    base, n = TaskContext.get().partitionId() << 40, 0
    conv, messages, first = None, None, True

    def pieces():
        for k, m in messages.items():
            yield conv, k, m.place, m.role, m.resets, "".join(m.texts), None, None, None

    out, held = [], 0
    for batch in batches:
        for c, message, kind, role, text in zip(*(col.to_pylist() for col in batch.columns)):
            if messages is None or c != conv:
                if messages is not None:
                    for row in pieces() if first else _rendered(conv, messages):
                        out.append(row)
                        held += len(row[5])
                        if held > 8 * PART or len(out) >= 10_000:
                            yield _record(out)
                            out, held = [], 0
                    first = False
                conv, messages = c, {}
            if message not in messages:
                messages[message] = _Message(base + n)
                n += 1
            messages[message].take(kind, role, text)
    if out:
        yield _record(out)
    if messages:
        out, held = [], 0
        for row in pieces():
            out.append(row)
            held += len(row[5])
            if held > 8 * PART:
                yield _record(out)
                out, held = [], 0
        if out:
            yield _record(out)


def _joined(pieces: DataFrame) -> DataFrame:
    """Messages of conversations that span ranges, whole, each rendered as a part."""
    ordered = F.sort_array(F.collect_list(F.struct("place", "role", "resets", "text")))  # one a range that the message lies in
    whole = pieces.groupBy("conv_id", "message").agg(ordered.alias("p"))
    last = F.coalesce(F.array_max(F.transform("p", lambda x, i: F.when(x["resets"], i))), F.lit(0))
    text = F.array_join(F.transform(F.slice("p", last + 1, F.size("p")), lambda x: x["text"]), "")
    role = F.try_element_at(F.filter(F.transform("p", lambda x: x["role"]), lambda r: r.isNotNull()), F.lit(1))
    final = whole.select("conv_id", F.col("p")[0]["place"].alias("place"), role.alias("role"), text.alias("text"))

    def one_by_one(batches):
        for batch in batches:
            rows = []
            for conv, place, role, text in zip(*(col.to_pylist() for col in batch.columns)):
                formatted, spans = render([(role or "", text)])
                rows.append((conv, None, place, None, None, formatted, False, 1, _spans(spans)))
            if rows:
                yield _record(rows)

    return final.mapInArrow(one_by_one, _PIECES)


def format_conversations(events: DataFrame) -> DataFrame:
    """(conv_id, part, whole, n_messages, formatted, loss): rendered conversations of an event log.

    ``events`` has conv_id, seq (of any type that sorts), message (long), kind,
    role and text. Parts, in order of ``part``, make up a conversation; ``whole``
    says that a part is all of it.
    """
    log = events.select("conv_id", "seq", "message", "kind", "role", "text")
    ranges = log.repartitionByRange("conv_id", "seq").sortWithinPartitions("conv_id", "seq")
    folded = written(ranges.select("conv_id", "message", "kind", "role", "text").mapInArrow(_fold, _PIECES), "folded")
    parts = folded.filter("whole IS NOT NULL").unionByName(_joined(folded.filter("whole IS NULL")))
    return parts.select("conv_id", F.col("place").alias("part"), "whole", "n_messages", F.col("text").alias("formatted"), "loss")


def events_of_turns(turns: DataFrame) -> DataFrame:
    """The event log of finished turns (conv_id, turn, role, text): each row opens a message and sends its text.

    Rows of one turn go in order of role and the text's md5; equal rows are
    turns of their own.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("message"),
    )

    def event(step: int, kind: str, text: Column) -> Column:
        return F.struct(F.lit(step).alias("step"), F.lit(kind).alias("kind"), text.alias("text"))

    rows = rows.withColumn("digest", F.md5("text")).withColumn("e", F.explode(F.array(event(0, "open", F.lit(None).cast("string")), event(1, "delta", F.col("text")))))
    seq = F.struct("turn", "role", "digest", "message", "e.step")
    return rows.select("conv_id", seq.alias("seq"), "message", "e.kind", "role", "e.text")


def digests(parts: DataFrame) -> DataFrame:
    """What stands in the formatted parts, read back: one row a conversation.

    Conversations of one part need no shuffle. The parts of the others come
    sorted to a task that hashes them one by one and keeps none of them: a
    digest runs over a whole conversation in order and cannot be split.
    """

    def read(batches):
        conv, state, rows = None, None, []

        def result():
            return conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

        for batch in batches:
            for c, formatted, loss in zip(*(col.to_pylist() for col in batch.columns)):
                if state is None or c != conv:
                    if state is not None:
                        rows.append(result())
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in read_back(formatted):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                for span in loss:
                    learned = unescape(formatted[span["start"] : span["end"]])
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                state[4] += len(formatted)
            if len(rows) > 10_000:
                yield record(rows)
                rows = []
        if state is not None:
            yield record([*rows, result()])

    def record(rows):
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    columns = ["conv_id", "formatted", "loss"]
    whole = parts.filter("whole").select(columns).mapInArrow(read, schema)
    split = parts.filter("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return whole.unionByName(split.select(columns).mapInArrow(read, schema))


#: A conversation that quotes the template's own control strings.
QUOTING = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def with_quoting(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """The turns plus the conversation QUOTING."""
    extra = spark.createDataFrame(QUOTING, "conv_id long, turn long, role string, text string")
    return turns.select("conv_id", "turn", "role", "text").unionByName(extra)
