"""Words of whole texts as numpy arrays, taken straight from Arrow batches.

Texts stay UTF-8 bytes. All separators used here are ASCII, and no byte of a
longer UTF-8 sequence is ASCII, so cutting bytes cuts characters rightly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
SLICE = 1 << 18  # bytes, or words, hashed at a time
CHUNK_BYTES = 1 << 21  # texts handled at a time; a longer one is handled alone

# Word characters: everything but white space.
DARK = np.ones(256, bool)
DARK[[0x20, *range(0x09, 0x0E)]] = False

# Word characters: digits, letters and everything beyond ASCII.
LETTERS = np.zeros(256, bool)
LETTERS[0x30:0x3A] = LETTERS[0x41:0x5B] = LETTERS[0x61:0x7B] = LETTERS[0x80:] = True


class Words(NamedTuple):
    """Words of several texts: byte spans in ``data``, ``bounds[i]:bounds[i + 1]`` are text i's."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def text_of(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def last(self) -> np.ndarray:
        """For each word the end of its text, as a place among all words."""
        return np.repeat(self.bounds[1:], self.counts)

    def spelled(self, lo: int, hi: int, lower: bool = False) -> list[str]:
        raw = self.data
        out = [raw[a:b].tobytes() for a, b in zip(self.starts[lo:hi], self.ends[lo:hi])]
        return [(w.lower() if lower else w).decode() for w in out]


def chunks(
    batch: pa.RecordBatch, column: str = "text", max_bytes: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``max_bytes`` of text, never within a text."""
    sizes = batch.column(column).fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(sizes.buffers()[1], np.int64)[sizes.offset :][: len(sizes) + 1]
    lo = 0
    while lo < batch.num_rows:
        hi = int(np.searchsorted(offsets, offsets[lo] + max_bytes, "right")) - 1
        hi = min(max(hi, lo + 1), batch.num_rows)
        yield batch.slice(lo, hi - lo)
        lo = hi


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts and where each begins; null counts as empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def find_words(texts: pa.Array, inside: np.ndarray) -> Words:
    """The words of each text: runs of bytes that ``inside`` marks."""
    data, offsets = text_bytes(texts)
    marks = inside[data]
    first, last = marks.copy(), marks.copy()
    first[1:] &= ~marks[:-1]
    last[:-1] &= ~marks[1:]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[begins] = marks[begins]
    ends = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[ends] = marks[ends]
    starts = np.flatnonzero(first)
    return Words(data, starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets))


@lru_cache(4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.full(size, BASE, np.uint64)
        down = np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        return np.cumprod(up), np.cumprod(down)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``size`` of them."""
    return _powers(1 << max(SLICE.bit_length(), int(size).bit_length()))


@lru_cache(2)
def byte_values(lower: bool) -> np.ndarray:
    """A fixed 64-bit value for every byte; with ``lower``, A-Z count as a-z."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
    if lower:
        values[0x41:0x5B] = values[0x61:0x7B]
    return values


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, one to one."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _span_sums(terms: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(terms) + 1, np.uint64)
    np.cumsum(terms, out=sums[1:])
    return sums


def word_hashes(words: Words, lower: bool, prefix: int | None = None) -> np.ndarray:
    """A 64-bit hash of every word, or of its first ``prefix`` bytes."""
    values, out, lo = byte_values(lower), np.empty(len(words.starts), np.uint64), 0
    with np.errstate(over="ignore"):
        while lo < len(out):
            a = int(words.starts[lo])
            hi = int(np.searchsorted(words.starts, a + SLICE))
            b = int(words.ends[hi - 1])
            up, down = powers(b - a + 1)
            sums = _span_sums(values[words.data[a:b]] * up[: b - a])
            start, end = words.starts[lo:hi] - a, words.ends[lo:hi] - a
            if prefix:
                end = np.minimum(end, start + prefix)
            size = (end - start).astype(np.uint64)
            out[lo:hi] = mix((sums[end] - sums[start]) * down[start] + size)
            lo = hi
    return out


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` words; ``len(hashes) - size + 1`` of them."""
    count = max(len(hashes) - size + 1, 0)
    out, lo = np.empty(count, np.uint64), 0
    with np.errstate(over="ignore"):
        while lo < count:
            hi = min(lo + SLICE, count)
            up, down = powers(hi - lo + size)
            sums = _span_sums(hashes[lo : hi + size - 1] * up[: hi - lo + size - 1])
            run = np.arange(hi - lo)
            out[lo:hi] = mix((sums[run + size] - sums[run]) * down[run] + np.uint64(size))
            lo = hi
    return out


def sliding(values: np.ndarray, size: int, of) -> np.ndarray:
    """``of`` (np.minimum or np.maximum) over each run of ``size`` values, by doubling."""
    have, out = 1, values
    while have < size:
        step = min(have, size - have)
        out = of(out[:-step], out[step:])
        have += step
    return out


def winnow(grams: np.ndarray, usable: np.ndarray, window: int) -> np.ndarray:
    """Marks the least hash of every ``window`` neighbouring grams, all of them on a tie.

    ``usable`` excludes grams that reach into the next text. Whether a gram is
    marked depends on its window alone, so equal windows mark equal places.
    """
    marked = np.zeros(len(grams), bool)
    if not len(grams):
        return marked
    values = np.where(usable, grams, np.uint64(MASK))
    padded = np.full(len(values) + 2 * (window - 1), MASK, np.uint64)
    padded[window - 1 : window - 1 + len(values)] = values
    least = sliding(padded, window, np.minimum)
    marked = sliding(least, window, np.maximum) == values
    return marked & usable


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as Spark's bigint."""
    return x.view(np.int64)


def split_lists(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    """``values`` cut into lists of the given lengths."""
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), values
    )
