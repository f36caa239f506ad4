"""Column names that do not clash with those of the caller's table, and columns computed once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def computed_once(run: Callable, kind: str) -> Callable:
    """An Arrow UDF that filters and joins on its column do not run again.

    The planner copies a deterministic one into filters below the column, so that each task
    runs it twice, with two Python workers at a time.
    """
    return F.arrow_udf(run, kind).asNondeterministic()


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores in front until `df` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def without(df: DataFrame, names: list[str]) -> list[str]:
    """The columns of `df` except `names`, whatever their case."""
    dropped = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in dropped]


def beside(name: str, made: list[str]) -> str:
    """`name`, with underscores in front until it is none of the columns that an operator makes."""
    taken = {m.lower() for m in made}
    while name.lower() in taken:
        name = "_" + name
    return name
