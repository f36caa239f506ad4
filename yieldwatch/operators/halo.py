"""Row windows over long series without one task per series.

A window partitioned by series alone sends a whole series to one task. Here each series is
cut into time chunks, the rows that a window at the start of a chunk looks back on are
copied into it (the halo), the window runs per (series, chunk), and the copies are dropped.
Lags and bounded frames give the same result as over the uncut series.

A table can be stored in that form (`store_framed`), bucketed by series and chunk: window
features over it need no shuffle, and a hot series is as many buckets as it has chunks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yieldwatch.operators.joins import join_null_safe

CHUNK = "_chunk"
HALO = "_halo"


def chunk_of(df: DataFrame, order: str) -> Column:
    """The time chunk of a row: the year of a date, the day of a timestamp."""
    if isinstance(df.schema[order].dataType, T.DateType):
        return F.year(order)
    return F.to_date(order)


def row_windows(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    lookback: int,
    build: Callable[[WindowSpec], dict[str, Column]],
    daily: bool = False,
) -> DataFrame:
    """Add the columns `build(window)`, which may look back at most `lookback` rows.

    `(keys, order)` must be unique. A table of `store_framed` with these keys and a look-back at
    least as long is read as it lies, without a shuffle. With `daily=True` the caller states that every key has a
    row for each calendar day of its span, as the uniform calendar gives; the halo is then
    found from the date alone, in the same pass. Otherwise it is found by counting rows.
    """
    keys = list(keys)
    if _is_framed(df):
        held = df.schema[HALO].metadata
        fits = held.get("keys") == keys and held.get("order") == order and held.get("lookback", -1) >= lookback
        framed = df if fits else None
        df = df if fits else rows_of(df)
    else:
        framed = None
    if framed is None:
        framed = _daily_halo(df, order, lookback) if daily else _counted_halo(df, keys, order, lookback)
    window = Window.partitionBy(*keys, CHUNK).orderBy(order)
    columns = [expression.alias(name) for name, expression in build(window).items()]
    return framed.select("*", *columns).filter(~F.col(HALO)).drop(CHUNK, HALO)


def _is_framed(df: DataFrame) -> bool:
    return {CHUNK, HALO} <= set(df.columns)


def rows_of(df: DataFrame) -> DataFrame:
    """The rows of a framed table, each once; other tables as they are."""
    return df.filter(~F.col(HALO)).drop(CHUNK, HALO) if _is_framed(df) else df


def store_framed(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    order: str,
    lookback: int,
    buckets: int,
    daily: bool = False,
    path: str | None = None,
) -> DataFrame:
    """Write `df` as the catalog table `table`, laid out for windows of up to `lookback` rows,
    and return that table.

    Rows are bucketed by (keys, chunk) and sorted; the rows a chunk looks back on are stored
    with it, which is `lookback` rows per chunk more. `row_windows`, and the features built on
    it, then need no exchange. An existing table of that name is replaced. `path` keeps the
    files outside the warehouse. Other operators read `rows_of` the table.
    """
    keys = list(keys)
    framed = _daily_halo(df, order, lookback) if daily else _counted_halo(df, keys, order, lookback)
    marked = framed.withMetadata(HALO, {"keys": keys, "order": order, "lookback": lookback})
    cell = [*keys, CHUNK]
    # Dealt by the hash that buckets use: each bucket is one file.
    writer = marked.repartition(buckets, *cell).write.bucketBy(buckets, *cell).sortBy(*cell, order).mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def _daily_halo(df: DataFrame, order: str, lookback: int) -> DataFrame:
    own = F.year(order)
    seen_from = F.sequence(own, F.year(F.date_add(order, lookback)))
    return df.withColumn(CHUNK, F.explode(seen_from)).withColumn(HALO, F.col(CHUNK) != own)


def _counted_halo(df: DataFrame, keys: list[str], order: str, lookback: int) -> DataFrame:
    rows = df.withColumn(CHUNK, chunk_of(df, order))
    cell = [*keys, CHUNK]
    chunks_in_order = Window.partitionBy(*keys).orderBy(CHUNK)

    # One row per chunk: how many rows come before it, and the chunks whose windows reach
    # back into it, which is normally the next one only.
    per_chunk = (
        rows.groupBy(*cell)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_end", F.sum("_n").over(chunks_in_order))
        .withColumn("_start", F.col("_end") - F.col("_n"))
        .withColumn(
            "_later",
            F.collect_list(F.struct(CHUNK, "_start")).over(chunks_in_order.rowsBetween(1, max(lookback, 1))),
        )
        .select(
            *cell,
            "_end",
            F.filter("_later", lambda later: later["_start"] - F.col("_end") < lookback).alias("_later"),
        )
    )
    # The last rows of each chunk; the row_number limit is applied before the shuffle.
    from_end = F.row_number().over(Window.partitionBy(*cell).orderBy(F.col(order).desc()))
    tails = rows.withColumn("_from_end", from_end).filter(F.col("_from_end") <= lookback)
    position = F.col("_end") - F.col("_from_end")  # 0-based within the key
    copies = (
        join_null_safe(tails, per_chunk, cell)
        .withColumn("_to", F.explode(F.filter("_later", lambda later: later["_start"] - position <= lookback)))
        .select(*df.columns, F.col(f"_to.{CHUNK}").alias(CHUNK), F.lit(True).alias(HALO))
    )
    return rows.withColumn(HALO, F.lit(False)).unionByName(copies)
