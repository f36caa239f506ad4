"""Whitening of embeddings by a covariance that is recovered from variances alone.

Entries become integers, floor(scale * entry) + OFFSET. For every dimension, and for the sum
of every two dimensions, Spark adds up exact squares of centred values; the polarisation
identity cov(a, b) = (var(a + b) - var(a) - var(b)) / 2 then gives all cross-covariances as
exact fractions. The matrix, whose size depends on the width of the vectors only, is
decomposed by `eigh` on the driver, and the rows are projected in batches.

Sums are exact for any number of rows: values are centred at the integer mean m = floor(S / n),
so that with z = x - m and r = S - n m, the sum of (n x - S)^2 is n (n sum(z^2) - r^2), and
partial sums travel as two halves of 60 bits in decimals.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldwatch.llm.columns import free_name, without

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
#: Eigenvalues below this share of the largest are rounding: the component has no variance.
LEAST = 1e-13
LIMB = 60
#: Numbers in a batch of rows that are handled together.
CELLS = 1 << 20


@dataclass(frozen=True)
class Whitening:
    """Of the vectors of one width: number of rows, exact sums and covariances of their
    integers, eigenvalues (falling) and unit eigenvectors (rows) of the kept components."""

    rows: int
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray

    @property
    def means(self) -> list[int]:
        return [s // self.rows for s in self.sums]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n as doubles: an exact integer less a fraction below 1."""
        rest = np.array([(s % self.rows) / self.rows for s in self.sums])
        return (x - np.array(self.means, dtype=np.int64)) - rest

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Projections of unit variance; 0 on a component without variance."""
        real = self.values > 0
        scale = np.where(real, 1 / np.sqrt(np.where(real, self.values, 1)), 0)
        return (self.centred(x) @ self.vectors.T) * scale

    def deviations(self, x: np.ndarray) -> list[int]:
        """The sum over dimensions of (n x - S)^2, exact."""
        n = self.rows
        z = x - np.array(self.means, dtype=np.int64)
        rest = np.array([s % n for s in self.sums], dtype=object)
        largest = int(np.abs(z).max(initial=0)) + 1
        if (n * largest) ** 2 * max(1, z.shape[1]) < 2**62:
            y = n * z - rest.astype(np.int64)
            return np.square(y).sum(axis=1).tolist()
        y = n * z.astype(object) - rest
        return (y * y).sum(axis=1).tolist()


def usable(vector: Column) -> Column:
    """True for a vector that is not null and holds neither null nor non-finite entries."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def _integers(column: pa.Array) -> np.ndarray:
    """The rows of a list column, all of one width, as integers."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    scaled = np.floor(SCALE * values)
    if len(scaled) and np.abs(scaled).max() >= 2.0**62:
        raise ValueError("an entry of a vector does not fit a 64-bit integer")
    return scaled.astype(np.int64).reshape(len(column), -1) + OFFSET


def _parts(batches: Iterator[pa.RecordBatch], width: int, most: int) -> Iterator[pa.RecordBatch]:
    """Batches of bounded size, so that the work on one fits in memory at any width."""
    rows = max(1, most // max(width, 1))
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def _square_sums(z: np.ndarray) -> list[int]:
    """Exact sums of squares of all columns, then of all sums of two columns i < j, by i."""
    largest = int(np.abs(z).max(initial=0))
    if 4 * largest * largest * max(1, len(z)) >= 2**62:
        z = z.astype(object)
    out = [int(v) for v in (z * z).sum(axis=0)]
    for i in range(z.shape[1] - 1):
        both = z[:, i + 1 :] + z[:, i : i + 1]
        out.extend(int(v) for v in (both * both).sum(axis=0))
    return out


def _exact_sums(df: DataFrame, width: int, vector: str, work) -> list[int]:
    """`work` gives a list of integers per batch; their sums over all batches, exact.

    Each task sends its totals once, so what is shuffled does not grow with the rows.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: list[int] = []
        for batch in _parts(batches, width, CELLS):
            found = work(_integers(batch.column(0)))
            totals = [a + b for a, b in zip(totals, found, strict=True)] if totals else found
        if totals:
            halves = [pa.array([t & ((1 << LIMB) - 1) for t in totals], pa.int64()), pa.array([t >> LIMB for t in totals], pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(totals)), pa.int32()), *halves], ["place", "low", "high"])

    found = df.select(vector).mapInArrow(task, "place int, low bigint, high bigint")
    wide = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("low", "high")]
    rows = found.groupBy("place").agg(*wide).collect()  # width * (width + 1) / 2 rows at most
    out = [0] * len(rows)
    for row in rows:
        out[row["place"]] = (int(row["high"]) << LIMB) + int(row["low"])
    return out


def covariance(n: int, rests: list[int], squares: list[int]) -> np.ndarray:
    """Covariances by polarisation, each the double nearest to the exact fraction.

    squares: sums of z^2 for all dimensions, then for all sums of two; rests: sums of z.
    """
    d = len(rests)
    own = [n * squares[i] - rests[i] ** 2 for i in range(d)]
    out = np.zeros((d, d))
    place = d
    for i in range(d):
        out[i, i] = Fraction(own[i], n * n)
        for j in range(i + 1, d):
            both = n * squares[place] - (rests[i] + rests[j]) ** 2
            out[i, j] = out[j, i] = Fraction(both - own[i] - own[j], 2 * n * n)
            place += 1
    return out


def fit_width(df: DataFrame, width: int, vector: str, components: int) -> Whitening:
    """The whitening of vectors that are all usable and of one width. Runs two jobs."""
    n, *sums = _exact_sums(df, width, vector, lambda x: [len(x), *map(int, x.sum(axis=0, dtype=object))])
    means = np.array([s // n for s in sums], dtype=np.int64)
    squares = _exact_sums(df, width, vector, lambda x: _square_sums(x - means))
    matrix = covariance(n, [s % n for s in sums], squares)
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(-values, kind="stable")[:components]
    values, vectors = np.maximum(values[order], 0), np.ascontiguousarray(vectors[:, order].T)
    values = np.where(values > LEAST * values.max(initial=0), values, 0)
    trace = np.trace(matrix)
    return Whitening(n, sums, matrix, values, vectors, values / trace if trace > 0 else values)


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> dict[int, Whitening]:
    """A whitening for each width of the usable vectors of `df`.

    Vectors of one width are a fit list of their own; the widths, a handful in a table of
    embeddings, are looped over. Empty vectors have no components. No rows give no models.
    """
    kept = df.filter(usable(F.col(vector))).select(F.col(vector))
    widths = [r["width"] for r in kept.select(F.size(vector).alias("width")).distinct().collect()]
    return {w: fit_width(kept.filter(F.size(vector) == w), w, vector, components) for w in sorted(widths) if w}


def identity_error(df: DataFrame, vector: str, width: int, model: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity.

    Measured on the rows, in two jobs: means, then products of centred values. Components
    without variance are left out; without any, the error is 0.
    """
    real = np.flatnonzero(model.values > 0)
    kept = df.filter(usable(F.col(vector)) & (F.size(vector) == width)).select(vector)

    def total(work) -> np.ndarray:
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = 0
            for batch in _parts(batches, width, CELLS):
                sums = sums + work(model.whiten(_integers(batch.column(0)))[:, real])
            if not np.isscalar(sums):
                yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array(sums)], ["place", "total"])

        rows = kept.mapInArrow(task, "place int, total double").groupBy("place").agg(F.sum("total").alias("total"))
        return np.array([r["total"] for r in sorted(rows.collect(), key=lambda r: r["place"])])

    if not len(real):
        return 0.0
    mean = total(lambda w: w.sum(axis=0)) / model.rows
    products = total(lambda w: ((w - mean).T @ (w - mean)).reshape(-1)) / model.rows
    return float(np.abs(products.reshape(len(real), -1) - np.eye(len(real))).max())


def transform(df: DataFrame, models: dict[int, Whitening], vector: str = "embedding") -> DataFrame:
    """The usable rows of `df` with n (rows of the fit list), deviation (decimal), whitened and
    explained (one entry per component, by falling eigenvalue).

    Rows whose vector is null or holds null or non-finite entries go. Empty vectors, and
    vectors of a width without a model, have a null n, a null deviation and no components. Equal vectors get equal
    results. Columns of the new names are replaced.
    """
    made = ["n", "deviation", "whitened", "explained"]
    kept = without(df, made)
    source = free_name(df, "_vector")
    rows = df.filter(usable(F.col(vector))).select(*kept, F.col(vector).cast("array<double>").alias(source))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _parts(iter([whole]), max([1, *models]), CELLS):
                column = batch.column(batch.num_columns - 1)
                width = np.diff(column.offsets.to_numpy())
                for w in np.unique(width):
                    part = batch.take(np.flatnonzero(width == w))
                    yield whitened(part, models.get(int(w)))

    def whitened(part: pa.RecordBatch, model: Whitening | None) -> pa.RecordBatch:
        count = part.num_rows
        if model is None:
            added = [pa.nulls(count, pa.int64()), pa.nulls(count, pa.decimal128(38, 0)), *[pa.array([[]] * count, pa.list_(pa.float64()))] * 2]
        else:
            x = _integers(part.column(part.num_columns - 1))
            cells = model.whiten(x)
            offsets = pa.array(np.arange(count + 1) * cells.shape[1], pa.int32())
            added = [
                pa.array(np.full(count, model.rows), pa.int64()),
                pa.array(model.deviations(x), pa.decimal128(38, 0)),
                pa.ListArray.from_arrays(offsets, pa.array(cells.reshape(-1))),
                pa.ListArray.from_arrays(offsets, pa.array(np.tile(model.explained, count))),
            ]
        return pa.RecordBatch.from_arrays([*part.columns[:-1], *added], [*part.schema.names[:-1], *made])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    schema = ", ".join([*fields, "n bigint", "deviation decimal(38,0)", "whitened array<double>", "explained array<double>"])
    return rows.mapInArrow(task, schema)
