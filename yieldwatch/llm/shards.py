"""Reproducible shuffle into shards: a keyed permutation of global row numbers.

The rows are numbered in an order that only their keys decide. A Feistel network over
pairs (left, right), with `left * right` just above the number of rows, permutes the
numbers; a result beyond the last row is permuted again until it falls inside (cycle
walking). Position p goes to shard p mod n, slot p div n, so shard and slot of any row, and
the row of any slot, follow from the number of rows, the number of shards and the seed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yieldwatch.llm.columns import free_name, without
from yieldwatch.sources.scratch import settle

ROUNDS = 6
#: Steps of cycle walking. Fewer than sqrt(rows) + 1 numbers lie outside, so up to 4,000
#: rows no walk is longer; beyond, a longer one has a chance below 64**-64 and is an error.
WALK = 64
ROWS_IN_BUCKET = 1024
MOST_BUCKETS = 1 << 16


class Permutation:
    """A permutation of 0 .. rows - 1, as column expressions."""

    def __init__(self, rows: int, seed: int = 0) -> None:
        self.rows = max(rows, 1)
        self.left = math.isqrt(self.rows - 1) + 1
        self.right = -(-self.rows // self.left)
        self.seed = seed

    def _add(self, i: Column, half: Column, other: Column, size: int) -> Column:
        return F.pmod(half + F.pmod(F.xxhash64(F.lit(self.seed), i.cast("int"), other.cast("bigint")), F.lit(size)), F.lit(size))

    def _subtract(self, i: Column, half: Column, other: Column, size: int) -> Column:
        return F.pmod(half - F.pmod(F.xxhash64(F.lit(self.seed), i.cast("int"), other.cast("bigint")), F.lit(size)), F.lit(size))

    def _network(self, x: Column, backwards: bool) -> Column:
        """One pass over all rounds; even rounds change the left half, odd ones the right."""
        change = self._subtract if backwards else self._add

        def step(state: Column, i: Column) -> Column:
            left, right = state["l"], state["r"]
            new_left = F.when(i % 2 == 0, change(i, left, right, self.left)).otherwise(left)
            new_right = F.when(i % 2 == 1, change(i, right, left, self.right)).otherwise(right)
            return F.struct(new_left.alias("l"), new_right.alias("r"))

        numbers = range(ROUNDS - 1, -1, -1) if backwards else range(ROUNDS)
        start = F.struct(F.floor(x / self.right).cast("bigint").alias("l"), F.pmod(x, F.lit(self.right)).cast("bigint").alias("r"))
        return F.aggregate(F.array(*[F.lit(i) for i in numbers]), start, step, lambda s: s["l"] * self.right + s["r"])

    def _walk(self, x: Column, backwards: bool) -> Column:
        inside = F.lit(self.rows)
        again = F.sequence(F.lit(1), F.lit(WALK))
        walked = F.aggregate(
            again, self._network(x, backwards), lambda y, _: F.when(y < inside, y).otherwise(self._network(y, backwards))
        )
        return walked

    def position(self, row: Column) -> Column:
        """The place of a row number after the shuffle."""
        return self._walk(row.cast("bigint"), False)

    def row(self, position: Column) -> Column:
        """The row number at a place: the inverse of `position`."""
        return self._walk(position.cast("bigint"), True)


def number_rows(df: DataFrame, keys: list[str], rows: int, out: str) -> DataFrame:
    """`df` with the numbers 0 .. rows - 1 in `out`, in an order that the keys decide.

    Rows are spread over buckets by a hash of the keys, numbered inside their bucket and
    moved on by the sizes of the buckets before. Rows with equal keys are numbered in any order.
    """
    buckets = 1
    while buckets < MOST_BUCKETS and buckets * ROWS_IN_BUCKET < rows:
        buckets *= 2
    bucket, offset, inside = (free_name(df, n) for n in ("_bucket", "_offset", "_inside"))
    spread = df.withColumn(bucket, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    sizes = spread.groupBy(bucket).agg(F.count("*").alias(offset))
    # One row per bucket, MOST_BUCKETS at most.
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(bucket, F.coalesce(F.sum(offset).over(before), F.lit(0)).alias(offset))
    within = Window.partitionBy(bucket).orderBy(*keys)
    joined = spread.withColumn(inside, F.row_number().over(within) - 1).join(offsets, bucket)
    return joined.select(*without(df, [out]), (F.col(offset) + F.col(inside)).alias(out))


def assign_shards(df: DataFrame, keys: list[str], shards: int, seed: int = 0, stored: bool = False) -> DataFrame:
    """`df` with row_number, position, shard and slot.

    Shard sizes differ by one row at most and slots have no gaps. The same rows, shards and
    seed give the same result whatever the partitions. Keys may be null or repeated; no rows
    give no rows; columns of the new names are replaced. Runs a job that counts the rows;
    `df` is written to the shared folder first, unless `stored` says that it reads a table. Carry narrow columns: they are shuffled once.
    """
    made = ["row_number", "position", "shard", "slot"]
    df = df if stored else settle(df.select(*without(df, made)))
    rows = df.count()
    order = Permutation(rows, seed)
    numbered = number_rows(df, keys, rows, "row_number")
    placed = numbered.withColumn("position", order.position(F.col("row_number")))
    wrong = F.raise_error(F.lit("a walk of the permutation did not end; use another seed"))
    placed = placed.withColumn("position", F.when(F.col("position") < F.lit(order.rows), F.col("position")).otherwise(wrong.cast("bigint")))
    shard = F.pmod(F.col("position"), F.lit(shards)).cast("int")
    return placed.withColumns({"shard": shard, "slot": F.floor(F.col("position") / shards).cast("bigint")})
