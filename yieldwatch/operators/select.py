"""The k-th smallest row of each group, without sorting or gathering a group.

Rows have a text key of hexadecimal digits. They are counted by the first digits of it, the
counts tell which prefix holds the k-th, and only rows with that prefix are counted by their
next digits, until few rows are left, which are ranked. A pass carries at most 16**DIGITS
counts per group and task, and reads a 16**DIGITS-th of the rows of the one before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yieldwatch.operators.joins import join_null_safe
from yieldwatch.sources.scratch import settle

DIGITS = 3
#: Rows of one prefix that are ranked together; more are counted by further digits.
FEW = 10_000


def kth_smallest(rows: DataFrame, groups: Sequence[str], key: str, length: int, wanted: DataFrame) -> DataFrame:
    """(groups, cut, keep, equal): the k-th smallest key of each group, how many rows with
    exactly that key are among the first k, and how many there are.

    `wanted` has (groups, k) with 1 <= k <= rows of the group. `key` has `length` digits,
    `rows` is read once per pass, so it should read a table. Runs a job per pass; equal keys
    in any number, such as a third of all rows, are counted and never ranked.
    """
    groups = list(groups)
    state = settle(wanted.select(*groups, F.col("k").cast("bigint").alias("_k"), F.lit("").alias("_prefix")))
    rows = rows.select(*groups, F.col(key).alias("_key"))
    done = 0
    while True:
        done = min(done + DIGITS, length)
        inside = join_null_safe(rows, state, groups).filter(F.startswith("_key", F.col("_prefix")))
        counts = inside.groupBy(*groups, "_k", F.substring("_key", 1, done).alias("_next")).agg(F.count("*").alias("_n"))
        # 16**DIGITS rows per group at most.
        running = F.sum("_n").over(Window.partitionBy(*groups).orderBy("_next"))
        before = F.col("_until") - F.col("_n")
        held = counts.withColumn("_until", running).filter((before < F.col("_k")) & (F.col("_k") <= F.col("_until")))
        state = settle(held.select(*groups, (F.col("_k") - before).alias("_k"), F.col("_next").alias("_prefix"), "_n"))
        most = state.agg(F.max("_n")).first()[0] or 0
        if done == length:
            return state.select(*groups, F.col("_prefix").alias("cut"), F.col("_k").alias("keep"), F.col("_n").alias("equal"))
        if most <= FEW:
            break
    inside = join_null_safe(rows, state.drop("_n"), groups).filter(F.startswith("_key", F.col("_prefix")))
    counts = inside.groupBy(*groups, "_k", "_key").agg(F.count("*").alias("_n"))
    running = F.sum("_n").over(Window.partitionBy(*groups).orderBy("_key"))
    before = F.col("_until") - F.col("_n")
    held = counts.withColumn("_until", running).filter((before < F.col("_k")) & (F.col("_k") <= F.col("_until")))
    return held.select(*groups, F.col("_key").alias("cut"), (F.col("_k") - before).alias("keep"), F.col("_n").alias("equal"))
