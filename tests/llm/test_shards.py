import pytest
from pyspark.sql import functions as F

from yieldwatch.llm import shards


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 16, 17, 1000, 4097])
def test_permutation_and_its_inverse(spark, rows):
    order = shards.Permutation(rows, seed=3)
    df = spark.range(rows).select("id", order.position(F.col("id")).alias("p"))
    got = df.select("id", "p", order.row(F.col("p")).alias("back")).collect()
    assert sorted(r["p"] for r in got) == list(range(rows))
    assert all(r["back"] == r["id"] for r in got)


def placed(df, n=8, seed=1):
    return {(r["k"], r["row_number"]): (r["shard"], r["slot"]) for r in shards.assign_shards(df, ["k"], n, seed).collect()}


def test_shards_are_even_and_do_not_depend_on_partitions(spark):
    df = spark.range(5003).select((F.col("id") * 7).alias("k"))
    one, other = placed(df.repartition(3)), placed(df.repartition(11, "k"))
    assert one == other and len(one) == 5003
    slots = {s: sorted(slot for shard, slot in one.values() if shard == s) for s in range(8)}
    assert all(v == list(range(len(v))) for v in slots.values())
    sizes = [len(v) for v in slots.values()]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == 5003
    assert placed(df, seed=2) != one
    # A shuffle, not the old order in turn.
    assert sum(row % 8 == shard for (_, row), (shard, _) in one.items()) < 1000


def test_null_and_repeated_keys_and_clashing_columns(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (5, 3), (5, 3)], "k int, slot int").withColumn("_bucket", F.lit("x"))
    out = shards.assign_shards(df, ["k"], 3)
    assert out.columns == ["k", "_bucket", "row_number", "position", "shard", "slot"]
    rows = out.collect()
    assert sorted(r["row_number"] for r in rows) == [0, 1, 2, 3] and {r["_bucket"] for r in rows} == {"x"}
    assert shards.assign_shards(df.limit(0), ["k"], 3).count() == 0
