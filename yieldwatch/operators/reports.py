"""The standard table reports: counts, shares, ranges, samples and joins of two series."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"))


def union_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, count) for each table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("count")).select(F.lit(name).alias("table_name"), "count")
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def sample_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first n rows by key."""
    return df.orderBy(*order).limit(n)


def filter_event(df: DataFrame, event: str, order: Sequence[str], n: int = 10) -> DataFrame:
    """Rows with the event, first n by key."""
    return df.filter(F.col(event) == 1).orderBy(*order).limit(n)


def filter_threshold(df: DataFrame, value: str, threshold: float, order: Sequence[Column], n: int = 10) -> DataFrame:
    """Rows above a threshold, first n in the given order."""
    return df.filter(F.col(value) > threshold).orderBy(*order).limit(n)


def date_range_closed(
    df: DataFrame, first: datetime.date, last: datetime.date, order: Sequence[str], n: int = 10, date: str = "date"
) -> DataFrame:
    """Rows of a closed date range, first n in the given order."""
    return df.filter(F.col(date).between(F.lit(first), F.lit(last))).orderBy(*order).limit(n)


def date_from(df: DataFrame, first: datetime.date, order: Sequence[str], n: int = 10, date: str = "date") -> DataFrame:
    """Rows from a date on, first n in the given order."""
    return df.filter(F.col(date) >= F.lit(first)).orderBy(*order).limit(n)


def count_by_segment(df: DataFrame, segment: str) -> DataFrame:
    return df.groupBy(segment).agg(F.count(F.lit(1)).alias("count"))


def segment_share(df: DataFrame, segment: str) -> DataFrame:
    """Count and percentage (2 digits) per segment; the total comes from the counts."""
    counts = count_by_segment(df, segment)
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("percentage", F.round(100.0 * F.col("count") / total, 2).cast("double"))


def average_by_segment(df: DataFrame, segment: str, value: str, alias: str) -> DataFrame:
    return df.groupBy(segment).agg(F.avg(value).alias(alias))


def range_stats(
    df: DataFrame,
    first: datetime.date,
    before: datetime.date,
    keys: Sequence[str] = (),
    value: str = "value",
    date: str = "date",
) -> DataFrame:
    """count, min, max and mean over a half-open date range."""
    inside = df.filter((F.col(date) >= F.lit(first)) & (F.col(date) < F.lit(before)))
    return inside.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("count"),
        F.min(value).alias("min_rate"),
        F.max(value).alias("max_rate"),
        F.avg(value).alias("avg_rate"),
    )


def date_span(df: DataFrame, keys: Sequence[str] = (), date: str = "date") -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min(date).alias("min_date"), F.max(date).alias("max_date"), F.count(F.lit(1)).alias("count")
    )


def class_balance(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """(target, label, n, positive_rate_pct): class sizes of each label in one pass."""
    cells = F.array(*[F.struct(F.lit(c).alias("target"), F.col(c).alias("label")) for c in labels])
    counts = (
        df.select(F.explode(cells).alias("_c")).select("_c.*").groupBy("target", "label").agg(F.count("*").alias("n"))
    )
    rates = counts.groupBy("target").agg(
        (F.sum(F.col("label") * F.col("n")) / F.sum("n") * 100).alias("positive_rate_pct")
    )
    return counts.join(rates, "target").select("target", "label", "n", "positive_rate_pct")


def join_series(left: DataFrame, right: DataFrame, names: tuple[str, str], date: str = "date") -> DataFrame:
    """Inner join of two series tables (date, value) on the date."""
    a, b = names
    return left.select(date, F.col("value").alias(a)).join(right.select(date, F.col("value").alias(b)), date)


def join_series_recent(left: DataFrame, right: DataFrame, names: tuple[str, str], n: int = 10) -> DataFrame:
    """The newest n dates of the joined series."""
    return join_series(left, right, names).orderBy(F.desc("date")).limit(n)


def join_series_range(
    left: DataFrame, right: DataFrame, names: tuple[str, str], first: datetime.date, n: int = 10
) -> DataFrame:
    """The first n joined dates from a date on."""
    return join_series(left, right, names).filter(F.col("date") >= F.lit(first)).orderBy("date").limit(n)
