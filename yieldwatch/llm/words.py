"""Words of many texts at once, as NumPy arrays.

A word is a run of bytes other than space and 0x09-0x0D, with A-Z lower-cased. Words are
named by 64-bit hashes, so that counting, joining and comparing them needs no strings.
Texts are handled in parts of a megabyte; a longer text is a part of its own, since
no text is ever cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PART_BYTES = 1 << 20
SHINGLE = 5

_random = np.random.default_rng(20240501)
_BYTE = _random.integers(0, 2**64, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_powers = np.ones(1, dtype=np.uint64)

#: The token that closes every text; no word has this hash.
END = np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that any of their bits can choose a bucket."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def power(n: int) -> np.ndarray:
    """The first n powers of an odd constant, modulo 2**64."""
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 2 * len(_powers)), _STEP, dtype=np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
    return _powers


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and the offsets of its texts; null counts as empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if not len(offsets) or offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def parts(offsets: np.ndarray, most: int = PART_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts with at most `most` bytes together, or one text that has more."""
    first, count = 0, len(offsets) - 1
    while first < count:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), count)
        yield first, last
        first = last


@dataclass
class Words:
    """hashes: one per word, in order. offsets: where the words of each text start.
    starts, ends: byte positions of each word in the part."""

    hashes: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)


def split_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The words of the texts in `data`; `offsets` start at 0."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return Words(np.zeros(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64), none, none)
    low = _LOWER[data]
    inside = _IS_WORD[low]
    first = np.zeros(n + 1, dtype=bool)
    first[offsets] = True  # the first byte of a text, and the end
    starting = inside.copy()
    starting[1:] &= ~inside[:-1] | first[1:-1]
    ending = inside.copy()
    ending[:-1] &= ~inside[1:] | first[1:-1]
    starts, ends = np.flatnonzero(starting), np.flatnonzero(ending) + 1
    if not len(starts):
        return Words(np.zeros(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64), starts, ends)
    lengths = ends - starts
    begin = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(begin, lengths)
    values = _BYTE[low[inside]] * power(int(lengths.max()))[place]
    hashes = mix(np.add.reduceat(values, begin) + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    hashes[hashes <= END] += np.uint64(2)
    return Words(hashes, np.searchsorted(starts, offsets), starts, ends)


def words_of(texts: pa.Array) -> Iterator[tuple[int, int, Words]]:
    """(first, last, words) for successive ranges of the texts."""
    data, offsets = text_buffer(texts)
    for first, last in parts(offsets):
        yield first, last, split_words(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])


def shingles_of(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words and the offsets of each text's runs.

    A text with fewer words has one run, the whole text; a text without words has none.
    """
    counts = words.counts
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    offsets = np.concatenate([[0], np.cumsum(runs)])
    if not offsets[-1]:
        return np.zeros(0, dtype=np.uint64), offsets
    start = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - words.offsets[:-1], runs)
    held = np.repeat(np.minimum(counts, size), runs)
    total = held.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    powers = power(size + 1)
    last = len(words.hashes) - 1
    for k in range(size):
        word = words.hashes[np.minimum(start + k, last)] * powers[k + 1]
        total += np.where(held > k, word, np.uint64(0))
    return mix(total), offsets
