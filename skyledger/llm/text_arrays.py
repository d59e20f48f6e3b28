"""Words of many texts as numpy arrays, cut and hashed without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

#: Texts are handled in runs of about this many bytes, so that the working arrays stay small; a longer text is a run.
RUN_BYTES = 1 << 20
#: The same where each word takes arrays of many values, which a worker keeps for the next task.
SMALL_RUN_BYTES = 1 << 18

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_BASE = 0xD1342543DE82EF95


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= _MIX[0]
    x ^= x >> np.uint64(27)
    x *= _MIX[1]
    x ^= x >> np.uint64(31)
    return x


def seeds(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit multipliers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * _ODD + np.uint64(seed)) | np.uint64(1)


#: A 64-bit value for every byte.
BYTE_VALUES = seeds(256, 7)

_BYTES = np.arange(256)
WHITE = (_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D))
LETTERS = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x41) & (_BYTES <= 0x5A)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
FOLD = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for b in (_BASE, inverse):
        p = np.full(size, np.uint64(b))
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(18, int(n).bit_length())
    return _powers(size)


@dataclass
class Run:
    """Some consecutive texts: their bytes, and where each begins (one offset more than texts)."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def count(self) -> int:
        return len(self.offsets) - 1


def runs(texts: pa.Array, run_bytes: int = RUN_BYTES) -> Iterator[Run]:
    """Cut a column of texts into runs of whole texts. A null is an empty text."""
    texts = texts.fill_null("") if texts.null_count else texts
    if not len(texts):
        return
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + run_bytes, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        own = offsets[first : last + 1]
        yield Run(first, data[own[0] : own[-1]], own - own[0])
        first = last


@dataclass
class Words:
    """The words of a run in order: byte spans, hashes, and for each text where its words begin."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    at: np.ndarray
    inside: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.at)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.at) - 1), self.counts)


def word_spans(run: Run, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of the longest stretches of bytes marked inside; none crosses from one text into the next."""
    n = len(run.data)
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edges = run.offsets[(run.offsets > 0) & (run.offsets < n)]
    start[edges] = inside[edges]
    end[edges - 1] = inside[edges - 1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


class Prefix:
    """Polynomial hashes of any stretch of a run's bytes from one running sum."""

    def __init__(self, data: np.ndarray, fold: np.ndarray | None = None):
        values = BYTE_VALUES if fold is None else BYTE_VALUES[fold]
        power, self._inverse = powers(len(data))
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * power[: len(data)], out=self._sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * self._inverse[starts] + (ends - starts).astype(np.uint64))


def words(run: Run, letters: np.ndarray, fold: np.ndarray | None = None) -> Words:
    """Words are the longest stretches of bytes for which ``letters`` holds; ``fold`` maps bytes before hashing."""
    inside = letters[run.data]
    starts, ends = word_spans(run, inside)
    hashes = Prefix(run.data, fold).hashes(starts, ends)
    return Words(starts, ends, hashes, np.searchsorted(starts, run.offsets), inside)


def code_points(data: np.ndarray) -> np.ndarray:
    """Marks the first byte of every code point of UTF-8."""
    return (data & 0xC0) != 0x80


def sum_by_text(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of values between consecutive positions."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def shingles(hashes: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``width`` consecutive words of each text, and where each text's begin.

    A text of fewer words, but not none, has one shingle, its whole sequence.
    """
    counts = np.diff(at)
    sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    begins = np.concatenate([[0], np.cumsum(sizes)])
    factors = seeds(width, 11)
    out = np.empty(begins[-1], np.uint64)
    full = np.flatnonzero(counts >= width)
    total = max(len(hashes) - width + 1, 0)
    rolled = np.zeros(total, np.uint64)
    for k in range(width):
        rolled += hashes[k : k + total] * factors[k]
    rolled = mix(rolled)
    if len(full):
        ok = np.ones(total, bool)
        # a window may not reach into the next text
        for k in range(1, width):
            cut = at[1:-1] - k
            ok[cut[(cut >= 0) & (cut < total)]] = False
        mask = np.repeat(counts >= width, sizes)
        out[mask] = rolled[ok]
    for i in np.flatnonzero((counts > 0) & (counts < width)):
        with np.errstate(over="ignore"):
            own = hashes[at[i] : at[i + 1]] * factors[: counts[i]]
            out[begins[i]] = mix(own.sum(dtype=np.uint64, keepdims=True) + np.uint64(counts[i]))[0]
    return out, begins
