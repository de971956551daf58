"""Words of Arrow text columns as NumPy arrays: borders, 64-bit hashes, hashes of runs of words.

All functions work on whole texts. A batch is cut into slices of about a megabyte (never inside a text), so memory
follows the slice, or the longest text, and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_MULT = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _table(word_byte) -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    return lower, np.array([word_byte(int(b)) for b in lower])


LOWER, ALNUM = _table(lambda b: b >= 128 or 48 <= b <= 57 or 97 <= b <= 122)
_, SPACED = _table(lambda b: not (b == 32 or 9 <= b <= 13))
_RANDOM = np.random.default_rng(20240115).integers(1, 1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of the multiplier and of its inverse, kept for the longest slice seen."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def __reduce__(self):
        return _Powers, ()  # the arrays are made again where they are needed

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, SLICE_BYTES + 1)
            for name, factor in (("up", _MULT), ("down", _INV)):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        return self.up[:n], self.down[:n]


_powers = _Powers()


@dataclass
class Words:
    """Words of a slice of texts, in order. `raw` holds the texts' bytes one after the other, `low` with A-Z lowered."""

    first: int  # number of the first text in the batch
    n_texts: int
    raw: np.ndarray
    low: np.ndarray
    text_start: np.ndarray  # byte offsets of the texts, one more than there are texts
    start: np.ndarray  # of each word
    end: np.ndarray
    text: np.ndarray  # number of each word's text, from 0 in the slice

    def counts(self) -> np.ndarray:
        return np.bincount(self.text, minlength=self.n_texts)

    def word_offsets(self) -> np.ndarray:
        """First word of each text, and the number of all words at the end."""
        return np.concatenate(([0], np.cumsum(self.counts())))

    def hashes(self) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, np.uint64)
        up, down = _powers.upto(len(self.low) + 1)
        sums = np.zeros(len(self.low) + 1, np.uint64)
        np.cumsum(_RANDOM[self.low] * up[:-1], out=sums[1:])
        return mix((sums[self.end] - sums[self.start]) * down[self.start])

    def word(self, k: int) -> str:
        return self.low[self.start[k]:self.end[k]].tobytes().decode("utf-8", "replace")


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on, where that many follow in the slice."""
    size = max(0, len(hashes) - n + 1)
    out = np.full(size, n, np.uint64)
    for k in range(n):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += hashes[k:k + size]
    return mix(out)


def runs_at(hashes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """`runs` at some words only; n words have to follow there."""
    out = np.full(len(at), n, np.uint64)
    for k in range(n):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += hashes[at + k]
    return mix(out)


def inside(text: np.ndarray, n: int) -> np.ndarray:
    """Where a run of n words stays in its text."""
    size = max(0, len(text) - n + 1)
    return text[:size] == text[n - 1:n - 1 + size] if size else np.zeros(0, bool)


def slices(texts: pa.Array, word_table: np.ndarray = ALNUM) -> Iterator[Words]:
    """The words of a text column, slice by slice. A null text counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    texts = texts.fill_null("").cast(pa.large_binary())
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1
        to = min(n, max(to, at + 1))
        raw = data[offsets[at]:offsets[to]]
        yield _split(raw, offsets[at:to + 1] - offsets[at], at, word_table)
        at = to


def _split(raw: np.ndarray, text_start: np.ndarray, first: int, word_table: np.ndarray) -> Words:
    is_word = word_table[raw]
    starts, ends = is_word.copy(), is_word.copy()
    starts[1:] &= ~is_word[:-1]
    ends[:-1] &= ~is_word[1:]
    edges = text_start[1:-1]
    edges = edges[(edges > 0) & (edges < len(raw))]
    starts[edges] |= is_word[edges]
    ends[edges - 1] |= is_word[edges - 1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    text = np.searchsorted(text_start, start, "right") - 1
    return Words(first, len(text_start) - 1, raw, LOWER[raw], text_start, start, end, text)


class Bitmap:
    """A set of hashes, kept as one bit for each residue of a fixed size; members always pass, others rarely.

    Its size is fixed, whatever the number of members, so it may travel to every task.
    """

    BITS = 1 << 26

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits

    @classmethod
    def empty(cls) -> Bitmap:
        return cls(np.zeros(cls.BITS // 8, np.uint8))

    def __getitem__(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & np.uint64(self.BITS - 1)
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0
