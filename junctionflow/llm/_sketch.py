"""A counting sketch of all hashes of a corpus, built by Spark and small enough to broadcast.

The sketch has a fixed number of slots (2**log2, a parameter), so its size is
bounded whatever the input: 2 bits a slot. Tasks send their slots as sorted
gaps (about a byte each), merge tasks add them up range by range, in two rounds
so that no merge task reads from all map tasks. A slot's level never understates
how often a hash occurs: level 0 proves that it occurs at most once, which is
all that callers rely on for whole results; a fuller sketch only prunes less.

Where most hashes of a corpus occur once (:func:`shared_levels`), they are
counted in far more slots than a sketch could have, range by range, and only
slots met more than once enter the sketch. Then it fills with what documents
share, not with all they hold.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ._bytes import MULT, U64, mix
from ._store import give_back, sent

RANGES = 64
#: Hashes that a map task holds before it sends them on.
HELD = 1 << 22
FULL = 15
#: Slots that :func:`shared_levels` counts in and the cells that it counts one after the other, as powers of 2.
FINE, CELLS = 37, 10
ROW = "part int, fan int, dense boolean, payload binary"
_ROW = pa.schema([("part", pa.int32()), ("fan", pa.int32()), ("dense", pa.bool_()), ("payload", pa.binary())])
CELL_ROW = "part int, cell int, wide boolean, payload binary"
_CELL_ROW = pa.schema([("part", pa.int32()), ("cell", pa.int32()), ("wide", pa.bool_()), ("payload", pa.binary())])


class Levels:
    """Packed levels: 0 for at most 1 occurrence, 1 for 2 to 3, 2 for 4 to 14, 3 for more.

    Parts stay compressed (a sparse sketch is mostly zeros) until a task asks, and
    the unpacked slots go when it ends (:func:`using`): idle workers hold little.
    The driver only passes the parts on.
    """

    def __init__(self, parts: dict[int, bytes], log2: int, probes: int):
        self.parts, self.log2, self.probes = parts, log2, probes
        self.packed: np.ndarray | None = None

    def _unpack(self) -> None:
        self.packed = np.zeros(1 << (self.log2 - 2), np.uint8)
        size, unzip = len(self.packed) // RANGES, zstandard.ZstdDecompressor()
        for part, body in self.parts.items():
            self.packed[part * size :][:size] = np.frombuffer(unzip.decompress(body), np.uint8)

    def of(self, h: np.ndarray) -> np.ndarray:
        if self.packed is None:
            self._unpack()
        out = None
        for k in range(self.probes):
            slot = _slots(h, k, self.log2)
            lv = (self.packed[slot >> U64(2)] >> ((slot & U64(3)) << U64(1)).astype(np.uint8)) & np.uint8(3)
            out = lv if out is None else np.minimum(out, lv)
        return out

    def of_many(self, h: np.ndarray) -> np.ndarray:
        """The same, of many hashes at once: only one part is unpacked at a time, so no task holds the whole sketch."""
        out, unzip = None, zstandard.ZstdDecompressor()
        for k in range(self.probes):
            slot = _slots(h, k, self.log2)
            part = (slot >> U64(self.log2 - 6)).astype(np.uint8)
            order = np.argsort(part, kind="stable")
            at = np.searchsorted(part[order], np.arange(RANGES + 1))
            lv = np.zeros(len(h), np.uint8)
            for r, body in self.parts.items():
                some = order[at[r] : at[r + 1]]
                if len(some):
                    packed, own = np.frombuffer(unzip.decompress(body), np.uint8), slot[some]
                    byte = packed[(own & U64((1 << (self.log2 - 6)) - 1)) >> U64(2)]
                    lv[some] = (byte >> ((own & U64(3)) << U64(1)).astype(np.uint8)) & np.uint8(3)
            out = lv if out is None else np.minimum(out, lv)
        return out


def _slots(h: np.ndarray, probe: int, log2: int) -> np.ndarray:
    return (mix(h ^ MULT[32 + probe]) if probe else h) >> U64(64 - log2)


def _gaps(slots: np.ndarray) -> bytes:
    """Sorted slots as gaps in base 255; byte 255 carries on."""
    d = np.diff(slots, prepend=0)
    over = d // 255
    out = np.full(int(over.sum()) + len(d), 255, np.uint8)
    out[np.cumsum(over + 1) - 1] = d % 255
    return out.tobytes()


def _slots_of(payload: bytes) -> np.ndarray:
    b = np.frombuffer(payload, np.uint8)
    return np.cumsum(b, dtype=np.int64)[b != 255]


def _cell_gaps(slots: np.ndarray) -> tuple[bool, bytes]:
    """Sorted slots (uint32) as 16-bit gaps in base 65535, 65535 carries on; as they are (True) where that takes no more."""
    d = np.diff(slots, prepend=slots[:1] * 0)
    over = d // 65535
    n = int(over.sum(dtype=np.int64)) + len(d)
    if n >= 2 * len(d):
        return True, slots.tobytes()
    out = np.full(n, 65535, np.uint16)
    out[np.cumsum(over + 1, dtype=np.int64) - 1] = d % 65535
    return False, out.tobytes()


def _cell_slots(wide: bool, payload: bytes) -> np.ndarray:
    if wide:
        return np.frombuffer(payload, np.uint32)
    b = np.frombuffer(payload, np.uint16)
    return np.cumsum(b, dtype=np.uint32)[b != 65535]


def _add(counts: np.ndarray, dense: bool, payload: bytes) -> None:
    if dense:
        b = np.frombuffer(payload, np.uint8)
        counts[0::2] = np.minimum(counts[0::2] + (b & 15), FULL)
        counts[1::2] = np.minimum(counts[1::2] + (b >> 4), FULL)
        return
    slots = _slots_of(payload)
    if len(slots):
        first = np.flatnonzero(np.diff(slots, prepend=-1))
        times = np.diff(first, append=len(slots))
        at = slots[first]
        counts[at] = np.minimum(counts[at] + np.minimum(times, FULL), FULL)


def _dump(counts: np.ndarray) -> tuple[bool, bytes]:
    at = np.flatnonzero(counts)
    if int(counts[at].sum()) + len(counts) // 255 < len(counts) // 2:
        return False, _gaps(np.repeat(at, counts[at]))
    return True, (counts[0::2] | (counts[1::2] << 4)).tobytes()


def count_levels(
    df: DataFrame,
    hashes_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]],
    log2: int = 28,
    probes: int = 1,
    fan: int = 8,
) -> Levels:
    """Levels of all 64-bit hashes that ``hashes_of`` draws from df's batches (one entry counts once)."""
    width = 1 << (log2 - 6)

    def sow(batches):
        mine = TaskContext.get().partitionId() % fan
        held: list[np.ndarray] = []

        def flush():
            slots = np.concatenate(held)
            slots.sort()
            at = np.searchsorted(slots, np.arange(RANGES + 1, dtype=np.int64) * width)
            parts = [r for r in range(RANGES) if at[r] < at[r + 1]]
            held.clear()
            cols = [parts, [mine] * len(parts), [False] * len(parts), [_gaps(slots[at[r] : at[r + 1]].astype(np.int64) - r * width) for r in parts]]
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, _ROW)], schema=_ROW)

        n = 0
        for batch in batches:
            for h in hashes_of(batch):
                for k in range(probes):
                    held.append(_slots(h, k, log2).astype(np.uint32))
                n += len(h) * probes
                if n >= HELD:
                    yield flush()
                    n = 0
        if n:
            yield flush()
        give_back()

    def reap(last: bool):
        def run(batches):
            key, c = None, np.zeros(width, np.uint8)

            def out():
                r, f = key
                if last:
                    lv = ((c > 1).astype(np.uint8) + (c > 3) + (c >= FULL)).reshape(-1, 4)
                    packed = (lv[:, 0] | (lv[:, 1] << 2) | (lv[:, 2] << 4) | (lv[:, 3] << 6)).tobytes()
                    row = True, zstandard.ZstdCompressor(level=1).compress(packed)
                else:
                    row = _dump(c)
                return pa.record_batch([pa.array([x], t.type) for x, t in zip((r, f, *row), _ROW)], schema=_ROW)

            for batch in batches:  # sorted: one range is counted at a time
                for r, f, dense, payload in zip(*(batch.column(i) for i in range(4))):
                    now = (r.as_py(), -1 if last else f.as_py())
                    if now != key:
                        if key is not None:
                            yield out()
                        key, c[:] = now, 0
                    _add(c, dense.as_py(), payload.as_buffer())
            if key is not None:
                yield out()

        return run

    parts = df.mapInArrow(sow, ROW).repartition(RANGES, "part", "fan").sortWithinPartitions("part", "fan").mapInArrow(reap(False), ROW)
    whole = parts.repartition(RANGES, "part").sortWithinPartitions("part").mapInArrow(reap(True), ROW).select("part", "payload")
    # RANGES rows, at most 2**(log2 - 2) bytes together.
    return Levels({row.part: bytes(row.payload) for row in whole.collect()}, log2, probes)


def shared_levels(df: DataFrame, hashes_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], log2: int = 28) -> Levels:
    """As :func:`count_levels` with one probe, of a sketch that holds only what 2**FINE slots met more than once.

    A slot has the highest level of the finer ones in it. Tasks send their fine
    slots as gaps (2 to 4 bytes each); one merge task counts a range, cell by cell.
    """
    width, inner = 1 << (log2 - 6), FINE - CELLS

    def sow(batches):
        held: list[np.ndarray] = []

        def flush():
            slots = np.concatenate(held)
            held.clear()
            slots.sort()
            at = np.searchsorted(slots, np.arange((1 << CELLS) + 1, dtype=U64) << U64(inner))
            np.bitwise_and(slots, U64((1 << inner) - 1), out=slots)
            slots = slots.astype(np.uint32)
            cells = np.flatnonzero(np.diff(at))
            wide, payload = zip(*(_cell_gaps(slots[at[c] : at[c + 1]]) for c in cells))
            return pa.record_batch([pa.array(c, f.type) for c, f in zip((cells >> (CELLS - 6), cells, wide, payload), _CELL_ROW)], schema=_CELL_ROW)

        n = 0
        for batch in batches:
            for h in hashes_of(batch):
                held.append(_slots(h, 0, FINE))
                n += len(h)
                if n >= HELD:
                    yield flush()
                    n = 0
        if n:
            yield flush()
        give_back()

    def reap(batches):
        key, held, levels = None, [], np.zeros(width, np.uint8)

        def count():
            slots = np.concatenate(held)
            held.clear()
            slots.sort()
            first = np.flatnonzero(np.concatenate([[True], slots[1:] != slots[:-1]]))
            times = np.diff(first, append=len(slots))
            more = np.flatnonzero(times > 1)
            times = times[more]
            at = ((slots[first[more]].astype(np.int64) + (key[1] << inner)) >> (FINE - log2)) & (width - 1)
            for level, some in ((1, times > 1), (2, times > 3), (3, times >= FULL)):
                levels[at[some]] = np.maximum(levels[at[some]], level)

        def out():
            lv = levels.reshape(-1, 4)
            packed = (lv[:, 0] | (lv[:, 1] << 2) | (lv[:, 2] << 4) | (lv[:, 3] << 6)).tobytes()
            levels[:] = 0
            return pa.record_batch([pa.array([key[0]], pa.int32()), pa.array([zstandard.ZstdCompressor(level=1).compress(packed)], pa.binary())], names=["part", "payload"])

        for batch in batches:  # sorted: one cell is counted at a time
            for r, c, wide, payload in zip(*(batch.column(i) for i in range(4))):
                now = r.as_py(), c.as_py()
                if now != key:
                    if key is not None:
                        count()
                        if now[0] != key[0]:
                            yield out()
                    key = now
                held.append(_cell_slots(wide.as_py(), payload.as_buffer()))
        if key is not None:
            count()
            yield out()
        give_back()

    cells = df.mapInArrow(sow, CELL_ROW).repartition(RANGES, "part").sortWithinPartitions("part", "cell")
    whole = cells.mapInArrow(reap, "part int, payload binary")
    # RANGES rows, at most 2**(log2 - 2) bytes together.
    return Levels({row.part: bytes(row.payload) for row in whole.collect()}, log2, 1)


def using(shared, fn):
    """The mapInArrow function ``fn(levels, batches)`` with a broadcast sketch, freed when the task ends.

    What earlier tasks of the worker have freed goes back before the sketch is unpacked, too.
    """

    def run(batches):
        levels = shared.value
        give_back()
        try:
            yield from fn(levels, batches)
        finally:
            levels.packed = None
            give_back()

    return run


def broadcast(df: DataFrame, levels: Levels):
    """2**(log2 - 2) bytes to each Python worker."""
    return sent(df.sparkSession, levels)

