"""Scaling fitted on all rows of a table or of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldwatch.operators.joins import join_summary


def _unit(x: Column, low: Column, high: Column) -> Column:
    """0..1 between low and high; a constant column gives 0."""
    return F.when(x.isNotNull(), F.coalesce(F.try_divide(x - low, high - low), F.lit(0.0)))


def column_bounds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with one struct (low, high) per column."""
    return df.agg(
        *[
            F.struct(F.min(c).cast("double").alias("low"), F.max(c).cast("double").alias("high")).alias(c)
            for c in columns
        ]
    )


def minmax_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add `<c>_scaled`. The bounds come from a one-row subquery, so rows are not shuffled."""
    bounds = df.agg(
        F.array(
            *[
                F.struct(F.min(c).cast("double").alias("low"), F.max(c).cast("double").alias("high"))
                for c in columns
            ]
        )
    ).scalar()
    scaled = df.withColumn("_bounds", bounds)
    for i, c in enumerate(columns):
        low, high = F.col("_bounds")[i]["low"], F.col("_bounds")[i]["high"]
        scaled = scaled.withColumn(f"{c}_scaled", _unit(F.col(c).cast("double"), low, high))
    return scaled.drop("_bounds")


def minmax_inverse(scaled: Column, low: Column, high: Column) -> Column:
    return scaled * (high - low) + low


def normalize_series(df: DataFrame, keys: Sequence[str] = ("series_id",), value: str = "value") -> DataFrame:
    """Add `zscore` (sample deviation) and `minmax` of `value` within each key."""
    stats = df.groupBy(*keys).agg(
        F.avg(value).alias("_mean"),
        F.stddev_samp(value).alias("_std"),
        F.min(value).alias("_low"),
        F.max(value).alias("_high"),
    )
    x = F.col(value)
    return (
        join_summary(df, stats, keys)
        .withColumn("zscore", F.try_divide(x - F.col("_mean"), F.col("_std")))
        .withColumn("minmax", _unit(x, F.col("_low"), F.col("_high")))
        .drop("_mean", "_std", "_low", "_high")
    )
