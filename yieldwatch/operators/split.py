"""Train and test splits: by time, by a hash of the row's id, and with exact class shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yieldwatch.operators.halo import CHUNK, chunk_of
from yieldwatch.operators.joins import join_null_safe, join_summary
from yieldwatch.operators.select import kth_smallest
from yieldwatch.sources.scratch import settle


def split_dates(
    df: DataFrame, keys: Sequence[str] = ("series_id",), order: str = "date", test_size: float = 0.2
) -> DataFrame:
    """(keys, n_train, n_rows, cutoff): the first test date of each key.

    Found from row counts per time chunk; only the one chunk that holds the cut is ranked.
    `cutoff` is NULL when no row is left for the test.
    """
    keys = list(keys)
    cell = [*keys, CHUNK]
    rows = df.select(*keys, order).withColumn(CHUNK, chunk_of(df, order))
    chunks = Window.partitionBy(*keys).orderBy(CHUNK)
    counted = (
        rows.groupBy(*cell)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_end", F.sum("_n").over(chunks))
        .withColumn("n_rows", F.sum("_n").over(Window.partitionBy(*keys)))
        .withColumn("n_train", F.floor(F.col("n_rows") * F.lit(1 - test_size)))
    )
    cut = counted.filter(
        (F.col("n_train") >= F.col("_end") - F.col("_n")) & (F.col("n_train") < F.col("_end"))
    ).select(*cell, (F.col("n_train") - F.col("_end") + F.col("_n") + 1).alias("_rank"))
    ranked = join_null_safe(rows, cut, cell).withColumn(
        "_row", F.row_number().over(Window.partitionBy(*cell).orderBy(order))
    )
    first_test = ranked.filter(F.col("_row") == F.col("_rank")).select(*keys, F.col(order).alias("cutoff"))
    sizes = counted.groupBy(*keys).agg(F.max("n_train").alias("n_train"), F.max("n_rows").alias("n_rows"))
    if not keys:
        return sizes.withColumn("cutoff", first_test.scalar())
    return join_null_safe(sizes, first_test, keys, "left")


def chrono_split(
    df: DataFrame, keys: Sequence[str] = ("series_id",), order: str = "date", test_size: float = 0.2
) -> DataFrame:
    """Add `split`: 'train' for the first int(n * (1 - test_size)) rows by date, else 'test'.

    With keys, a job stores the cut of each key.
    """
    cuts = split_dates(df, keys, order, test_size)
    if keys:
        rows = join_summary(df, cuts.select(*keys, F.col("cutoff").alias("_cutoff")), keys)
    else:
        rows = df.withColumn("_cutoff", cuts.select("cutoff").scalar())
    is_test = F.col(order) >= F.col("_cutoff")
    return rows.withColumn("split", F.when(is_test, "test").otherwise("train")).drop("_cutoff")


def hash_split(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Add `split` from a hash of the id.

    Needs no shuffle, gives the same answer on every run, and keeps the class ratio in
    expectation, since the hash does not depend on the label.
    """
    limit = format(int((1 - test_size) * 2**32), "08x")
    digest = _digest(key, seed)
    return df.withColumn("split", F.when(F.substring(digest, 1, 8) < limit, "train").otherwise("test"))


def _digest(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def _hex(number: Column) -> Column:
    return F.lpad(F.lower(F.hex(number)), 16, "0")


def stratified_split(
    df: DataFrame, key: str, label: str, test_size: float = 0.2, seed: int = 42, stored: bool = False
) -> DataFrame:
    """Add `split` with exact shares: of each class's n rows, floor(n * (1 - test_size)) train.

    The rows of a class are ordered by a hash of the id, and a class's cut is found by counting
    (`kth_smallest`); no class is gathered or sorted. The result does not depend on the
    partitions. Rows with a NULL label are a class, rows with a NULL id are ordered by a hash
    of the whole row. Repeated rows that meet at the cut are split between both sides. Runs
    jobs; `df` is written to the shared folder first, unless `stored` says that it reads a table.
    """
    if not stored:
        df = settle(df)
    # The id's digest decides; rows of one id are ordered by their other columns.
    whole = F.xxhash64(*[F.col(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()])
    order = F.concat(F.coalesce(_digest(key, seed), F.lit("0" * 32)), _hex(whole))
    shares = df.groupBy(label).agg(F.floor(F.count("*") * F.lit(1 - test_size)).alias("k"))
    cuts = settle(kth_smallest(df.withColumn("_key", order), [label], "_key", 48, shares.filter("k > 0")))
    if cuts.filter("keep < equal").isEmpty():
        rows = df.withColumn("_key", order)
    else:
        # Rows that cannot be told apart meet at a cut: number them.
        numbered = settle(df.withColumn("_number", F.monotonically_increasing_id()))
        rows = numbered.withColumn("_key", F.concat(order, _hex(F.col("_number")))).drop("_number")
        cuts = settle(kth_smallest(rows, [label], "_key", 64, shares.filter("k > 0")))
    marked = join_null_safe(rows, cuts.select(label, F.col("cut").alias("_cut")), [label], "left")
    train = F.coalesce(F.col("_key") <= F.col("_cut"), F.lit(False))
    return marked.withColumn("split", F.when(train, "train").otherwise("test")).drop("_key", "_cut")
