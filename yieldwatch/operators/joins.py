"""Joins of summary tables with the rows they came from."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldwatch.sources.scratch import settle


def join_null_safe(rows: DataFrame, other: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, where NULL equals NULL: rows with a NULL key are a group of their own."""
    names = {c: f"_key_{i}" for i, c in enumerate(on)}
    renamed = other.select(*[F.col(c).alias(names.get(c, c)) for c in other.columns])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(k)) for c, k in names.items()])
    return rows.join(renamed, same, how).drop(*names.values())


def join_summary(
    rows: DataFrame, summary: DataFrame, on: Sequence[str], how: str = "inner", stored: bool = False
) -> DataFrame:
    """Join one-row-per-key `summary` to `rows`; NULL keys match.

    The summary is computed once into the shared folder (unless `stored` says that it reads
    a table already), which is a job. The planner then knows its size in bytes and chooses: a
    small one is broadcast, so that the rows are not shuffled; else AQE splits hot keys.
    """
    if not stored:
        summary = settle(summary)
    return join_null_safe(rows, summary, on, how)
