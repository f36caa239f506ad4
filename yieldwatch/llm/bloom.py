"""Bloom filters of fixed size, built by the tasks and sent to all of them.

A filter only spares rows that cannot match from being shuffled. Where it lets too many
through, as with very many keys, the result is the same and more rows are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldwatch.llm.words import mix

BITS = 24  # 2**24 bits, 2 MB
BLOCK = 1 << 13  # 64-bit words of a block that one task puts together
PROBES = 3


def _places(keys: np.ndarray) -> Iterator[np.ndarray]:
    for k in range(PROBES):
        step = np.uint64((k * 2 + 1) * 0x9E3779B97F4A7C15 % 2**64)
        yield (mix(keys + step) >> np.uint64(64 - BITS)).astype(np.int64)


def contains(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """False for keys that are certainly not in the filter."""
    found = np.ones(len(keys), dtype=bool)
    for place in _places(keys):
        found &= (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
    return found


def build(keys: DataFrame, column: str) -> np.ndarray:
    """A filter of all values of a bigint column, as bytes. One job; its fixed size reaches the driver."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(1 << BITS, dtype=bool)
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for place in _places(values):
                flags[place] = True
        words = np.packbits(flags, bitorder="little").view(np.int64).reshape(-1, BLOCK)
        for block in np.flatnonzero(words.any(axis=1)):
            at = np.flatnonzero(words[block])
            place = pa.array((int(block) * BLOCK + at).astype(np.int32))
            yield pa.RecordBatch.from_arrays([place, pa.array(words[block][at])], names=["place", "word"])

    known = keys.select(column).filter(F.col(column).isNotNull())
    filled = known.mapInArrow(fill, "place int, word bigint").groupBy("place").agg(F.bit_or("word").alias("word"))
    words = np.zeros((1 << BITS) // 64, dtype=np.int64)
    for batch in filled.toArrow().to_batches():
        words[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return words.view(np.uint8)
