"""Words of Arrow text columns as numpy arrays: no Python object per word.

A word is a run of bytes other than space and 0x09-0x0D; A-Z are lower-cased,
other bytes are kept. A word's hash is a polynomial over random values of its
bytes, read off prefix sums (mod 2**64) and mixed; equal words hash equally in
every process. A batch is worked through in pieces of about a megabyte, so
memory stays bounded by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256)
_FOLD[ord("A") : ord("Z") + 1] += 32
_VALUE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64)[_FOLD]
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (xor-shift-multiply)."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, PIECE * 2)
        for k, base in enumerate((_P, _P_INV)):
            full = np.full(size, base, np.uint64)
            full[0] = 1
            _powers[k] = np.multiply.accumulate(full)
    return _powers[0][:n], _powers[1][:n]


@dataclass
class Piece:
    """Some consecutive rows of a batch: ``rows`` [lo, hi), their bytes, and their words."""

    lo: int
    hi: int
    data: np.ndarray  # bytes
    offsets: np.ndarray  # row -> byte, hi - lo + 1 entries
    starts: np.ndarray  # word -> first byte
    ends: np.ndarray  # word -> byte after the last
    hashes: np.ndarray  # word -> uint64
    first: np.ndarray  # row -> word, hi - lo + 1 entries

    @property
    def doc(self) -> np.ndarray:
        """word -> row within the piece."""
        return np.repeat(np.arange(self.hi - self.lo), np.diff(self.first))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls as empty texts."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1 + column.offset)[column.offset :] if offsets else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets


def pieces(column: pa.Array, limit: int = PIECE) -> Iterator[Piece]:
    raw, offsets = text_buffers(column)
    n, lo = len(column), 0
    while lo < n:
        hi = max(lo + 1, min(int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1, lo + 60_000, n))
        own = offsets[lo : hi + 1] - offsets[lo]
        yield _piece(lo, hi, raw[offsets[lo] : offsets[hi]], own)
        lo = hi


def _piece(lo: int, hi: int, data: np.ndarray, offsets: np.ndarray) -> Piece:
    size = len(data)
    word = np.empty(size + 1, bool)
    np.logical_not(_SPACE[data], out=word[:size])
    word[size] = False
    begins = word[:size].copy()
    begins[1:] &= ~word[: size - 1] if size else False
    edge = offsets[(offsets > 0) & (offsets < size)]
    begins[edge] = word[edge]  # a text's first byte begins a word even after another text's word
    starts = np.flatnonzero(begins)
    stops = word[:size] & ~word[1:]
    stops[edge - 1] = word[edge - 1]
    ends = np.flatnonzero(stops) + 1
    power, inverse = _power(size + 1)
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(_VALUE[data] * power[:size], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return Piece(lo, hi, data, offsets, starts, ends, hashes, np.searchsorted(starts, offsets))


def ngrams(piece: Piece, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams in order, and their first words' indices."""
    count = len(piece.hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = piece.hashes[:count].copy()
    for k in range(1, n):
        h *= np.uint64(0xC2B2AE3D27D4EB4F)
        h += piece.hashes[k : count + k]
    doc = piece.doc
    at = np.flatnonzero(doc[:count] == doc[n - 1 :])
    return mix(h[at]), at
