"""Collects the checked queries: a Spark callable and, where SQL can say it, the SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, digits: dict[str, int] | None = None):
    """Register a query. `digits` rounds double columns on both sides, for results whose last
    bits depend on the order of a sum."""

    def register(run: Query) -> Query:
        def rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_columns(run(spark, sf_dir), digits or {})

        QUERIES[name] = rounded
        if sql is not None:
            ORACLES[name] = round_sql(sql, digits or {})
        return run

    return register


def shift(digits: int) -> float:
    """A part of the last digit. Means of cents often lie exactly halfway between two
    rounded values, where the last bit decides; shifted on both sides they do not."""
    return 0.1234567 * 10.0**-digits


def round_columns(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    if not digits:
        return df
    # Adding zero turns a rounded -0.0 into 0.0.
    return df.withColumns({c: F.round(F.col(c) + shift(n), n) + 0.0 for c, n in digits.items()})


def round_sql(sql: str, digits: dict[str, int]) -> str:
    if not digits:
        return sql
    parts = ", ".join(f'round("{c}" + {shift(n)!r}, {n}) + 0e0 AS "{c}"' for c, n in digits.items())
    return f"SELECT * REPLACE ({parts}) FROM ({sql}) AS q"
