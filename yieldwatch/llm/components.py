"""Connected components of a graph given by its edges, by alternating star rounds.

Each round hangs larger neighbours on the smallest neighbour known (large star), then joins
the smaller ones to it (small star), until every node hangs on its component's smallest
node. A node's neighbours are never gathered: a round needs their minimum, which is summed
up before the shuffle, and a join in which AQE splits the rows of a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldwatch.sources.scratch import settle


def _directed(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller node, without loops."""
    ends = edges.filter(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
    return ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    larger = both.join(least, "u").filter(F.col("v") > F.col("u"))
    return _directed(larger.select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _directed(others.unionByName(least.select("u", F.col("m").alias("v"))))


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, source: str, target: str) -> DataFrame:
    """(node, root) for every node of an edge between different nodes; root is the smallest
    node of its component. Runs jobs; a round's edges are written to the shared folder.

    Null ends, loops and repeated edges count for nothing; no edges give no rows.
    """
    current = settle(_directed(edges.select(F.col(source).alias("u"), F.col(target).alias("v"))))
    mark = _fingerprint(current)
    while mark[0]:
        following = settle(_small_star(_large_star(current)))
        previous, mark = mark, _fingerprint(following)
        current = following
        if mark == previous:
            break
    # Every edge now leads from a node to its root.
    roots = current.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
