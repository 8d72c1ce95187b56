"""Words of whole texts as numpy arrays, straight from Arrow's byte buffers.

A word is a run of bytes other than space and the control characters 9 to 13.
Those are ASCII, so cutting at them never splits a UTF-8 character, and all
texts of a batch are cut and hashed at once without a Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: The words of the contracts, for Spark's and Python's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that are worked on at a time; a longer text is worked on alone.
SLICE_BYTES = 2 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: All ASCII but letters and digits: what is left are words without punctuation.
PUNCTUATION = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BASE = 0x9E3779B97F4A7C15 | 1  # any odd number has an inverse modulo 2**64


@dataclass
class Words:
    """The words of some rows: `first[i]:first[i + 1]` are those of row i."""

    data: np.ndarray  # bytes of all rows
    start: np.ndarray  # of each word, in data
    end: np.ndarray
    first: np.ndarray  # len(rows) + 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64 bits; a bijection."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo 2**64."""
    out = np.ones(max(n, 1), np.uint64)
    out[1:] = base & 0xFFFFFFFFFFFFFFFF
    return np.cumprod(out, dtype=np.uint64)


class Hasher:
    """Polynomial hashes of words, by prefix sums modulo 2**64."""

    def __init__(self) -> None:
        self.up = powers(_BASE, 1)
        self.down = powers(pow(_BASE, -1, 1 << 64), 1)

    def words(self, words: Words, lower: bool) -> np.ndarray:
        data = _LOWER[words.data] if lower else words.data
        n = len(data)
        if n > len(self.up):
            self.up = powers(_BASE, n)
            self.down = powers(pow(_BASE, -1, 1 << 64), n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
        h = (sums[words.end] - sums[words.start]) * self.down[words.start]
        return mix(h)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Rabin-Karp hash of every `size` consecutive words; one less per further word.

    They run over row ends: take them with `window_rows`.
    """
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base = 0xD6E8FEB86659FD93 | 1
    up, down = powers(base, len(hashes)), powers(pow(base, -1, 1 << 64), n)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up, out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * down)


def window_rows(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and row of every window that lies in one row."""
    count = np.maximum(np.diff(first) - size + 1, 0)
    row = np.repeat(np.arange(len(count)), count)
    begin = np.concatenate(([0], np.cumsum(count)))[:-1]
    start = np.arange(len(row)) - begin[row] + first[:-1][row]
    return start, row


def split(texts: pa.Array, blank: np.ndarray = _BLANK) -> Words:
    """Words of the texts; a null has none.  `blank` tells for each byte if it separates."""
    texts = texts.cast(pa.large_binary())
    n = len(texts)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint8), none, none, np.zeros(1, np.int64))
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer else np.zeros(0, np.uint8)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    valid = texts.is_valid().to_numpy(zero_copy_only=False)
    length = np.where(valid, np.diff(offsets), 0)
    inside = ~blank[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edge = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    begins[edge] |= inside[edge]
    ends[edge - 1] |= inside[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, np.append(offsets[:-1], len(data)))
    if (length != np.diff(offsets)).any():  # bytes below a null
        keep = np.repeat(valid, np.diff(first))
        first = np.concatenate(([0], np.cumsum(np.where(valid, np.diff(first), 0))))
        start, end = start[keep], end[keep]
    return Words(data, start, end, first)


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in parts of about `SLICE_BYTES` of text."""
    text = batch.column(column).cast(pa.large_binary())
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    at = 0
    while at < len(text):
        to = int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1
        to = min(max(to, at + 1), len(text))
        yield batch.slice(at, to - at)
        at = to


def smallest(values: np.ndarray, size: int) -> np.ndarray:
    """The least of every `size` consecutive values."""
    have, out = 1, values
    while have * 2 <= size:
        out = np.minimum(out[:-have], out[have:]) if len(out) > have else out[:0]
        have *= 2
    rest = size - have
    if rest:
        out = np.minimum(out[:-rest], out[rest:]) if len(out) > rest else out[:0]
    return out


def keyed(values: np.ndarray, row: np.ndarray) -> np.ndarray:
    """One hash for each (value, row)."""
    return mix(values ^ mix(row.astype(np.uint64) + np.uint64(1)))
