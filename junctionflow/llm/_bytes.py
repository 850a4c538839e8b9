"""Word and byte hashing of whole Arrow text columns in numpy.

Texts are handled as UTF-8 bytes. All word separators used here are ASCII, so a
byte class decides whether a byte belongs to a word and no decoding is needed.
A piece of text is hashed with one running polynomial (modulo 2**64, a random
odd base and a random 64-bit value per byte); the hash of any byte range is then
a difference of two prefix values.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Bytes hashed at a time; only a longer word makes a piece longer.
PIECE = 1 << 19

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_BYTES = LOWER.tobytes()

#: ASCII white space: space and \t \n \v \f \r.
SPACE_BYTES = b" \t\n\x0b\x0c\r"
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[list(SPACE_BYTES)] = False
#: Digits, letters and every byte of a non-ASCII character.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

_rng = np.random.default_rng(20240131)
BYTE_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
BASE = int(_rng.integers(1, 1 << 62, dtype=np.uint64)) * 4 + 3
_INV = pow(BASE, -1, 1 << 64)
MULT = _rng.integers(1, 1 << 62, 64, dtype=np.uint64) * U64(2) + U64(1)
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n, kept between calls."""
    while len(_powers[0]) < n:
        k = len(_powers[0])
        for j, b in ((0, BASE), (1, _INV)):
            _powers[j] = np.concatenate([_powers[j], _powers[j] * U64(pow(b, k, 1 << 64))])
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the splitmix64 finaliser)."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Running hash, one longer than buf."""
    out = np.zeros(len(buf) + 1, U64)
    np.cumsum(BYTE_VALUE[buf] * powers(len(buf))[0][: len(buf)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte range; equal for equal bytes of equal length wherever they stand."""
    inv = powers(len(prefix))[1]
    return mix((prefix[end] - prefix[start]) * inv[start] + (end - start).astype(U64) * MULT[63])


def column_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow text column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = pc.fill_null(col, b"")
    if len(col) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset : col.offset + len(col) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)), offsets


def doc_groups(offsets: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Runs of neighbouring documents of at most ``size`` bytes together (a longer one alone)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield lo, hi
        lo = hi


def _words(buf: np.ndarray, cuts: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w = is_word[buf]
    prev = np.zeros(len(w), bool)
    prev[1:] = w[:-1]
    after = np.zeros(len(w), bool)
    after[:-1] = w[1:]
    inner = cuts[(cuts > 0) & (cuts < len(w))]
    prev[inner] = False
    after[inner - 1] = False
    starts, ends = np.flatnonzero(w & ~prev), np.flatnonzero(w & ~after) + 1
    return range_hash(prefix_hash(LOWER[buf]), starts, ends), np.searchsorted(starts, cuts)


def _long_doc(buf: np.ndarray, is_word: np.ndarray) -> np.ndarray:
    out, at = [], 0
    while at < len(buf):
        end = min(len(buf), at + PIECE)
        while end < len(buf):
            gaps = np.flatnonzero(~is_word[buf[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
                break
            end = min(len(buf), end + PIECE)
        out.append(_words(buf[at:end], np.array([0, end - at]), is_word)[0])
        at = end
    return np.concatenate(out) if out else np.empty(0, U64)


def word_hashes(col, is_word: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first document, word hashes, word offsets by document) for runs of documents.

    Words are maximal runs of bytes of the class, A-Z lower-cased.
    """
    data, offsets = column_bytes(col)
    for lo, hi in doc_groups(offsets):
        buf = data[offsets[lo] : offsets[hi]]
        if len(buf) > PIECE:
            h = _long_doc(buf, is_word)
            yield lo, h, np.array([0, len(h)])
        elif len(buf):
            yield lo, *_words(buf, offsets[lo : hi + 1] - offsets[lo], is_word)
        else:
            yield lo, np.empty(0, U64), np.zeros(hi - lo + 1, np.int64)


def combine(h: np.ndarray, width: int) -> np.ndarray:
    """Order-sensitive hash of every ``width`` neighbouring values."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, U64)
    out = np.full(n, MULT[width], U64)
    for j in range(width):
        out += h[j : j + n] * MULT[j]
    return mix(out)


def line_key(line: bytes) -> bytes:
    """A line without ASCII white space at its ends, A-Z lower-cased."""
    return line.strip(SPACE_BYTES).translate(LOWER_BYTES)


def digest16(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()
