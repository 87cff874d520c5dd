"""Words and word shingles of whole Arrow columns as 64-bit hashes, in numpy.

A-Z are lowered; words are runs of anything but the ASCII blanks (space and 0x09 to 0x0D). The hash
of a word is a polynomial over a random value per byte, finished by a mixing step; two different
words or shingles agree with a chance of 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
_random = np.random.default_rng(7)
_BYTE = _random.integers(1, 2**64, 256, dtype=np.uint64)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_PLACE = _random.integers(1, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


class Rows(NamedTuple):
    """Values of all rows one after the other; those of row i are values[offsets[i]:offsets[i + 1]]."""

    values: np.ndarray
    offsets: np.ndarray

    def row(self, i: int) -> np.ndarray:
        return self.values[self.offsets[i] : self.offsets[i + 1]]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[:1] = 1
    return np.cumprod(powers, dtype=np.uint64)


_UP, _DOWN = _powers(_BASE, CHUNK_BYTES), _powers(_INVERSE, CHUNK_BYTES)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins; nulls have none."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def chunks(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``CHUNK_BYTES`` of text, or one row if that is longer."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(lengths), 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + CHUNK_BYTES, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of each word, and the offsets of the rows in words."""
    word = ~BLANK[raw]
    inner = np.zeros(len(raw) + 1, bool)  # the byte goes on with the word before it
    inner[1:-1] = word[1:] & word[:-1]
    inner[offsets] = False
    starts = np.flatnonzero(word & ~inner[:-1])
    ends = np.flatnonzero(word & ~inner[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words(texts: pa.Array) -> Rows:
    """The hashes of the words of each text."""
    raw, offsets = utf8(texts)
    starts, ends, rows = word_spans(raw, offsets)
    up, down = (_UP, _DOWN) if len(raw) <= CHUNK_BYTES else (_powers(_BASE, len(raw)), _powers(_INVERSE, len(raw)))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[: len(raw)], out=sums[1:])
    return Rows(mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), rows)


def shingles(of: Rows, k: int) -> Rows:
    """The k-word shingles of each row in order, with repeats; the whole row as one if it is shorter."""
    values, counts = of.values, of.counts
    n = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    offsets = np.concatenate([[0], np.cumsum(n)])
    first = np.repeat(of.offsets[:-1] - offsets[:-1], n) + np.arange(offsets[-1])
    left = np.repeat(of.offsets[1:], n) - first
    total = np.zeros(len(first), np.uint64)
    padded = np.concatenate([values, np.zeros(k, np.uint64)])
    for j in range(k):
        part = padded[first + j] * _PLACE[j]
        total += part if j == 0 else np.where(j < left, part, np.uint64(j))
    return Rows(mix(total), offsets)


def distinct(of: Rows) -> Rows:
    """Each row sorted, without repeats."""
    values, offsets = of.values.copy(), of.offsets
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if b - a > 1:
            values[a:b].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    keep[offsets[:-1][offsets[:-1] < len(values)]] = True
    return Rows(values[keep], np.concatenate([[0], np.cumsum(keep)])[offsets])


def sums(of: Rows, values: np.ndarray) -> np.ndarray:
    """The sum (modulo 2^64) of ``values``, aligned with the rows' values, for each row."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[of.offsets[1:]] - total[of.offsets[:-1]]
