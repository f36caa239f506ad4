"""Series on a daily calendar: as-of values at each midnight, and gap filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yieldwatch.functions.calendar import is_business_day
from yieldwatch.functions.scalars import null_if_nan
from yieldwatch.operators.halo import CHUNK, chunk_of
from yieldwatch.operators.joins import join_null_safe


def uniform_calendar(
    observations: DataFrame,
    key: str = "series_id",
    ts: str = "ts",
    value: str = "value",
    leading: str = "null",
) -> DataFrame:
    """One row (key, date, value) per calendar day from the first to the last observed day.

    The value of day d is the last observation at or before midnight of d. A series that
    starts after midnight has no value on its first day: NULL, or with
    `leading="backfill"` its first value. `(key, ts)` must be unique.

    All observations between two midnights fall together in a map-side aggregation, so the
    window below sees at most one row per series and calendar day, however many ticks a
    series has. Each of those rows then fills its own gap up to the next.
    """
    if leading not in ("null", "backfill"):
        raise ValueError("leading must be 'null' or 'backfill'")
    is_date = isinstance(observations.schema[ts].dataType, T.DateType)
    at = F.col(ts)
    day = at if is_date else F.to_date(at)
    midnight = day.cast(observations.schema[ts].dataType)
    next_midnight = day if is_date else F.when(at > midnight, F.date_add(day, 1)).otherwise(day)

    by_day = (
        observations.filter(null_if_nan(F.col(value)).isNotNull())
        .groupBy(key, next_midnight.alias("_day"))
        .agg(
            F.max_by(value, ts).alias(value),
            F.min(day).alias("_first"),
            F.max(day).alias("_last"),
        )
    )
    days = Window.partitionBy(key).orderBy("_day")
    bounded = by_day.select(
        key,
        "_day",
        value,
        F.when(F.lag("_day").over(days).isNull(), F.col("_first")).otherwise(F.col("_day")).alias("_from"),
        F.coalesce(F.date_sub(F.lead("_day").over(days), 1), F.col("_last")).alias("_to"),
    ).filter(F.col("_from") <= F.col("_to"))
    grid = bounded.withColumn("date", F.explode(F.sequence("_from", "_to")))
    if leading == "null":
        grid = grid.withColumn(value, F.when(F.col("date") >= F.col("_day"), F.col(value)))
    return grid.select(key, "date", value)


def fill_missing(
    df: DataFrame,
    keys: Sequence[str] = ("series_id",),
    order: str = "date",
    value: str = "value",
    leading: str = "backfill",
) -> DataFrame:
    """Replace NULL and NaN by the last earlier value; a leading gap by the first value.

    `leading="null"` leaves the leading gap, so that no value comes from the future. Each
    time chunk is filled on its own; what crosses a chunk border comes from a table with one
    row per chunk.
    """
    if leading not in ("null", "backfill"):
        raise ValueError("leading must be 'null' or 'backfill'")
    keys = list(keys)
    cell = [*keys, CHUNK]
    rows = df.withColumn(value, null_if_nan(F.col(value))).withColumn(CHUNK, chunk_of(df, order))
    observed_at = F.when(F.col(value).isNotNull(), F.col(order))
    chunks = Window.partitionBy(*keys).orderBy(CHUNK)
    earlier = chunks.rowsBetween(Window.unboundedPreceding, -1)
    whole = chunks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per_chunk = (
        rows.groupBy(*cell)
        .agg(F.max_by(value, observed_at).alias("_last"), F.min_by(value, observed_at).alias("_first"))
        .select(
            *cell,
            F.last("_last", ignorenulls=True).over(earlier).alias("_carried"),
            F.first("_first", ignorenulls=True).over(whole).alias("_first"),
        )
    )
    so_far = Window.partitionBy(*cell).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    running = rows.withColumn("_running", F.last(value, ignorenulls=True).over(so_far))
    sources = [F.col("_running"), F.col("_carried")]
    if leading == "backfill":
        sources.append(F.col("_first"))
    filled = F.coalesce(*sources).alias(value)
    return join_null_safe(running, per_chunk, cell).select(*[filled if c == value else F.col(c) for c in df.columns])


def business_days(df: DataFrame, order: str = "date") -> DataFrame:
    """Monday to Friday only."""
    return df.filter(is_business_day(F.col(order)))


def date_key_check(df: DataFrame, keys: Sequence[str] = ("series_id",), order: str = "date") -> DataFrame:
    """One row: how many rows have a NULL key, and how many keys and rows are duplicated."""
    has_null = F.lit(False)
    for column in [*keys, order]:
        has_null = has_null | F.col(column).isNull()
    per_key = df.groupBy(*keys, order).agg(F.count(F.lit(1)).alias("n"))
    duplicated = ~has_null & (F.col("n") > 1)
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(has_null, F.col("n"))), F.lit(0)).alias("null_key_rows"),
        F.count_if(duplicated).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(duplicated, F.col("n"))), F.lit(0)).alias("duplicate_key_rows"),
    )
