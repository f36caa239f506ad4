"""Quality of texts by regularised quadratic discriminant analysis.

Every text becomes a short vector of transformed statistics. Each class is a normal
distribution whose covariance is shrunk towards a diagonal; the score is the logistic of
the difference of the two log densities, which come from Mahalanobis distances with
Cholesky factors computed once. Spark sums the moments, the driver sees only those sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldwatch.llm.words import Words, parts, shingles_of, split_words, text_buffer

STATISTICS = [
    "bytes",
    "words",
    "word_length",
    "upper_case",
    "digits",
    "stops",
    "symbols",
    "lines",
    "distinct_words",
    "commonest_word",
    "repeated_neighbours",
    "symbol_endings",
    "short_words",
    "distinct_triples",
    "long_words",
]
#: Weight of the diagonal in a class covariance; more where a class has few rows.
SHRINKAGE = 0.1
FLOOR = 1e-4

_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".,;:?'\"-"]] = True
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:?'\"-"]] = True


def _per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of `values` between offsets; zero where a text has none."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)


def _runs(hashes: np.ndarray, text: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text: how many distinct hashes it has, and how often the commonest occurs."""
    if not len(hashes):
        return np.zeros(count), np.zeros(count)
    order = np.lexsort((hashes, text))
    h, t = hashes[order], text[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (t[1:] != t[:-1])])
    begins = np.flatnonzero(new)
    lengths = np.diff(np.append(begins, len(h)))
    most = np.zeros(count)
    np.maximum.at(most, t[begins], lengths)
    return np.bincount(t[begins], minlength=count).astype(float), most


def _ratio(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """A share, stretched near 0 and 1 so that its spread is about even."""
    return np.arcsin(np.sqrt(np.clip(part / np.maximum(whole, 1), 0, 1)))


def _of_part(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    count = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    words: Words = split_words(data, offsets)
    n = words.counts.astype(float)
    text = words.text_of_word()
    lengths = words.ends - words.starts
    distinct, commonest = _runs(words.hashes, text, count)
    triples, at = shingles_of(words, 3)
    n_triples = np.diff(at).astype(float)
    distinct_triples, _ = _runs(triples, np.repeat(np.arange(count), np.diff(at)), count)
    same = np.zeros(len(words.hashes), dtype=bool)
    if len(same) > 1:
        same[1:] = (words.hashes[1:] == words.hashes[:-1]) & (text[1:] == text[:-1])
    final = data[words.ends - 1] if len(words.ends) else np.zeros(0, dtype=np.uint8)
    points = _per_text((data & 0xC0) != 0x80, offsets)
    columns = [
        np.log1p(size),
        np.log1p(n),
        np.log1p(_per_text(lengths, words.offsets) / np.maximum(n, 1)),
        _ratio(_per_text(_UPPER[data], offsets), points),
        _ratio(_per_text(_DIGIT[data], offsets), points),
        _ratio(_per_text(_STOP[data], offsets), n),
        _ratio(_per_text(_SYMBOL[data], offsets), points),
        _ratio(_per_text(data == 10, offsets), n),
        _ratio(distinct, n),
        _ratio(commonest, n),
        _ratio(_per_text(same, words.offsets), n),
        _ratio(_per_text(_SYMBOL[final], words.offsets), n),
        _ratio(_per_text(lengths <= 3, words.offsets), n),
        _ratio(distinct_triples, n_triples),
        _ratio(_per_text(lengths >= 14, words.offsets), n),
    ]
    return np.column_stack(columns)


def statistics_of(texts: pa.Array) -> np.ndarray:
    """One row of STATISTICS for each text; a null or empty text has zeros."""
    data, offsets = text_buffer(texts)
    rows = [_of_part(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in parts(offsets)]
    return np.vstack(rows) if rows else np.zeros((0, len(STATISTICS)))


def _lists(matrix: np.ndarray) -> pa.Array:
    offsets = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix).ravel()))


def text_statistics(text: str | Column) -> Column:
    """array<double> of STATISTICS."""

    @F.arrow_udf("array<double>")
    def run(texts: pa.Array) -> pa.Array:
        return _lists(statistics_of(texts))

    return run(text)


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and constants of the classes 0 and 1."""

    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row."""
        density = [
            constant - 0.5 * np.square((rows - mean) @ factor.T).sum(axis=1)
            for mean, factor, constant in zip(self.means, self.factors, self.constants)
        ]
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))

    def score(self, text: str | Column) -> Column:
        """The score of a text, computed from the text alone."""
        model = self

        @F.arrow_udf("double")
        def run(texts: pa.Array) -> pa.Array:
            return pa.array(model.scores(statistics_of(texts)))

        return run(text)

    def score_statistics(self, statistics: str | Column) -> Column:
        """The same from stored `text_statistics`."""
        model = self

        @F.arrow_udf("double")
        def run(rows: pa.Array) -> pa.Array:
            matrix = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
            return pa.array(model.scores(matrix))

        return run(statistics)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of 1, x and x x' for each class, in long form, once for a partition."""
    size = len(STATISTICS) + 1
    sums = np.zeros((2, size, size))
    for batch in batches:
        matrix = batch["statistics"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        rows = np.column_stack([np.ones(batch.num_rows), matrix])
        label = batch["label"].to_numpy(zero_copy_only=False)
        for c in (0, 1):
            own = rows[label == c]
            sums[c] += own.T @ own
    label, i, j = np.indices(sums.shape)
    columns = [label.ravel().astype(np.int32), i.ravel().astype(np.int32), j.ravel().astype(np.int32), sums.ravel()]
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["label", "i", "j", "total"])


def fit(rows: DataFrame, statistics: str = "statistics", label: str = "label", shrinkage: float = SHRINKAGE) -> Discriminant:
    """Fit the two classes to all rows whose label is 0 or 1; other labels and nulls are left out.

    Runs one job that returns two matrices. A class without rows gets the other's shape, so
    that its prior alone decides; without any rows every score is 0.5.
    """
    known = rows.select(F.col(statistics).alias("statistics"), F.col(label).cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & F.col("statistics").isNotNull())
    summed = known.mapInArrow(_moments, "label int, i int, j int, total double")
    size = len(STATISTICS) + 1
    sums = np.zeros((2, size, size))
    for row in summed.groupBy("label", "i", "j").agg(F.sum("total").alias("total")).collect():
        sums[row["label"], row["i"], row["j"]] = row["total"]
    return solve(sums, shrinkage)


def solve(sums: np.ndarray, shrinkage: float) -> Discriminant:
    counts = sums[:, 0, 0]
    width = sums.shape[1] - 1
    means, spreads = np.zeros((2, width)), np.zeros((2, width, width))
    for c in (0, 1):
        if counts[c]:
            means[c] = sums[c, 0, 1:] / counts[c]
            spreads[c] = sums[c, 1:, 1:] / counts[c] - np.outer(means[c], means[c])
    pooled = np.diag((counts[:, None, None] * spreads).sum(axis=0)) / max(counts.sum(), 1)
    factors, constants = [], []
    for c in (0, 1):
        if not counts[c]:
            means[c], spreads[c] = means[1 - c], spreads[1 - c]
        own = max(counts[c], 0)
        weight = max(shrinkage, width / (width + own))
        shrunk = (1 - weight) * spreads[c] + weight * np.diag(pooled) + FLOOR * np.eye(width)
        lower = np.linalg.cholesky((shrunk + shrunk.T) / 2)
        factors.append(np.linalg.inv(lower))
        prior = np.log((own + 1) / (counts.sum() + 2))
        constants.append(prior - np.log(np.diag(lower)).sum())
    if not counts.all():  # one shape for both
        factors[0], constants = factors[1], [np.log((n + 1) / (counts.sum() + 2)) for n in counts]
    return Discriminant(means, np.array(factors), np.array(constants))
