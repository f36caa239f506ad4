"""Running totals over a global order, without one task per key.

Rows are dealt into ranges of (keys, order), summed per range, and the totals of the earlier
ranges are added to a running sum inside each range. Spark draws the ranges from a sample, as
many as the data and the number of shuffle partitions ask for, so a hot key gets its share;
they only spread the work, the sums are exact whatever the ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yieldwatch.operators.joins import join_null_safe
from yieldwatch.sources.scratch import settle

BUCKET = "_bucket"


def add_bucket(df: DataFrame, keys: Sequence[str], order: str, buckets: int | None = None) -> DataFrame:
    """Add the number of the row's range: it rises with `order` within each key.

    Rows with equal keys and order are in one range. Without `buckets`, there are as many as
    shuffle partitions, or fewer where AQE finds that the data need less. Runs a job: the rows
    are written to the shared folder, so that every later reader sees the same ranges.
    """
    dealt = df.repartitionByRange(*([buckets] if buckets else []), *keys, order)
    return settle(dealt.withColumn(BUCKET, F.spark_partition_id()))


def prefix_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    sums: Sequence[str],
    descending: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Add `before_x` (sum of x over earlier rows of the key) and `total_x` for each x.

    One row per (keys, order). Rows with a NULL key are a group of their own.
    """
    keys = list(keys)
    bucketed = add_bucket(df, keys, order, buckets)
    way = F.desc if descending else F.asc

    # One row per key and range from here on.
    in_order = Window.partitionBy(*keys).orderBy(way(BUCKET)).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    totals = bucketed.groupBy(*keys, BUCKET).agg(*[F.sum(x).alias(f"_sum_{x}") for x in sums])
    totals = totals.select(
        *keys,
        BUCKET,
        *[F.coalesce(F.sum(f"_sum_{x}").over(in_order), F.lit(0)).alias(f"_offset_{x}") for x in sums],
        *[F.sum(f"_sum_{x}").over(whole).alias(f"total_{x}") for x in sums],
    )

    inside = Window.partitionBy(*keys, BUCKET).orderBy(way(order)).rowsBetween(Window.unboundedPreceding, -1)
    running = bucketed.select("*", *[F.sum(x).over(inside).alias(f"_inside_{x}") for x in sums])
    joined = join_null_safe(running, totals, [*keys, BUCKET])
    return joined.select(
        *df.columns,
        *[
            (F.col(f"_offset_{x}") + F.coalesce(F.col(f"_inside_{x}"), F.lit(0))).alias(f"before_{x}")
            for x in sums
        ],
        *[f"total_{x}" for x in sums],
    )
