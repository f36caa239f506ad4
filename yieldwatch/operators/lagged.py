"""Products of a row and the rows before it, summed per series.

Every linear model of a value on earlier values, changes, or residuals of such a model is a
linear map of the same few lagged terms. One pass sums the products of those terms; any
number of models is then solved from the sums, on the same rows, without reading them again.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldwatch.functions.scalars import null_if_nan
from yieldwatch.operators.halo import row_windows
from yieldwatch.operators.joins import join_summary

MOST_HELD = 1_000  # series whose sums a task holds at once


def lagged_products(
    df: DataFrame, key: str, order: str, value: str, lookback: int, daily: bool = False
) -> DataFrame:
    """(key, centre, gram): per series the mean of its values and, as a flat matrix, the sums
    of all products of (1, value before, this change, `lookback` - 1 earlier changes).

    Values are centred at the mean, and changes are used in place of values, which keeps the
    sums free of cancellation. Rows count whose value and `lookback` earlier ones are all
    known; a series without such a row is left out. A task adds up one matrix per series, a job stores the means.
    """
    size = lookback + 2

    def build(w) -> dict[str, Column]:
        def back(k: int) -> Column:
            return F.lag(value, k).over(w) if k else F.col(value)

        return {"_u0": back(1), **{f"_u{k + 1}": back(k) - back(k + 1) for k in range(lookback)}}

    means = df.groupBy(key).agg(F.avg(null_if_nan(F.col(value).cast("double"))).alias("centre"))
    centred = join_summary(df.select(key, order, value), means, [key])
    centred = centred.withColumn(value, null_if_nan(F.col(value).cast("double")) - F.col("centre"))
    rows = row_windows(centred, [key], order, lookback, build, daily)
    terms = [f"_u{k}" for k in range(lookback + 1)]
    known = rows.filter(reduce(lambda a, b: a & b, [F.col(t).isNotNull() for t in terms]))

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for batch in batches:
            for name, group in batch.groupby(["key", "centre"], dropna=False):
                x = np.column_stack([np.ones(len(group)), group[terms].to_numpy()])
                name = (None if pd.isna(name[0]) else name[0], name[1])
                held[name] = held[name] + x.T @ x if name in held else x.T @ x
            if len(held) > MOST_HELD:
                yield flat(held)
                held = {}
        if held:
            yield flat(held)

    def flat(held: dict) -> pd.DataFrame:
        names = list(held)
        return pd.DataFrame({"key": [n[0] for n in names], "centre": [n[1] for n in names], "gram": [g.ravel() for g in held.values()]})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(np.stack(group["gram"].to_numpy()), axis=0)
        return pd.DataFrame({"key": group["key"].iloc[:1], "centre": group["centre"].iloc[:1], "gram": [total]})

    kind = df.schema[key].dataType.simpleString()
    schema = f"key {kind}, centre double, gram array<double>"
    added = known.select(F.col(key).alias("key"), "centre", *terms).mapInPandas(sums, schema)
    # At most one row per series and task.
    whole = added.groupBy("key").applyInPandas(add, schema)
    assert size == len(terms) + 1
    return whole.select(F.col("key").alias(key), "centre", "gram")


class Lagged:
    """The terms of a Gram matrix as vectors: products of linear combinations of them."""

    def __init__(self, gram: np.ndarray) -> None:
        size = int(round(np.sqrt(len(gram))))
        self.gram = np.asarray(gram, dtype=float).reshape(size, size)
        self.unit = np.eye(size)
        self.one = self.unit[0]
        self.change = [self.unit[2 + k] for k in range(size - 2)]
        self.level = [self.unit[1] + self.unit[2]]
        for k in range(size - 2):
            self.level.append(self.level[-1] - self.change[k])

    @property
    def n(self) -> float:
        return float(self.gram[0, 0])

    def differenced(self, d: int) -> list[np.ndarray]:
        """The series of d-th differences, this row's first."""
        out = self.level
        for _ in range(d):
            out = [a - b for a, b in zip(out, out[1:], strict=False)]
        return out

    def regress(self, y: np.ndarray, design: list[np.ndarray]) -> tuple[np.ndarray, float]:
        """Least-squares weights of `design` for `y`, and the residual sum of squares."""
        yy = float(y @ self.gram @ y)
        if not design:
            return np.zeros(0), max(yy, 0.0)
        x = np.array(design)
        xx, xy = x @ self.gram @ x.T, x @ self.gram @ y
        weights = np.linalg.lstsq(xx, xy, rcond=None)[0]
        return weights, max(yy - float(weights @ xy), 0.0)
