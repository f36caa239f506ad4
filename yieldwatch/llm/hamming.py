"""Nearest neighbours by inner product: multi-index hashing of learned binary codes.

Vectors get one more component that makes their lengths equal, so that the largest inner
product is the smallest angle. Learned rotations of a bounded sample turn a vector into a
code of bits. Codes are cut into substrings, each with its own index: if two codes differ
in at most r bits, then one of m substrings differs in at most r / m, so probing every
substring within that distance meets every code within radius r. Codes met this way are
compared whole, and those within the radius are ranked by the true product of the original vectors.

The radius comes from the sample. A query that finds fewer than k is asked again with all
bits, where every code is a candidate.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yieldwatch.llm.columns import beside
from yieldwatch.llm.jaccard import small_batches
from yieldwatch.sources.scratch import settle

#: Bound of the sample that rotations and radius are learned from.
SAMPLE = 8000
ROTATIONS = 3  # each gives one bit for every dimension
STEPS = 20
SUBSTRING = 32  # bits
#: Share of the sample's nearest neighbours that the radius must hold.
SHARE = 0.95
#: The index is copied once for each block of queries, and the queries once for each block of it.
ROWS_OF_BLOCK = 10_000
QUERIES_OF_BLOCK = 8_000


@dataclass(frozen=True)
class Codes:
    """Rotation (dimensions + 1, bits) of the codes, largest length of a vector, search radius."""

    rotation: np.ndarray
    longest: float
    radius: int

    def lengthen(self, rows: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest**2 - np.square(rows).sum(axis=1), 0))
        return np.column_stack([rows, rest])

    def encode(self, rows: np.ndarray, query: bool = False) -> np.ndarray:
        """A row of substrings (32-bit numbers) for each vector. The added component of a query is 0."""
        longer = np.column_stack([rows, np.zeros(len(rows))]) if query else self.lengthen(rows)
        return np.packbits(longer @ self.rotation > 0, axis=1, bitorder="little").view("<u4")


def learn(rows: np.ndarray, longest: float, k: int) -> Codes:
    """Rotations by iterative quantisation from random starts, and the radius."""
    random = np.random.default_rng(8)
    longer = Codes(np.zeros((rows.shape[1] + 1, SUBSTRING)), longest, 0).lengthen(rows)
    # The origin stays the centre: signs then tell angles, which is what is asked for.
    width = longer.shape[1]
    bits = max(SUBSTRING, ROTATIONS * width // SUBSTRING * SUBSTRING)
    turns = []
    for _ in range(-(-bits // width)):
        turn, _ = np.linalg.qr(random.normal(size=(width, width)))
        for _ in range(STEPS):
            signs = np.where(longer @ turn > 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(signs.T @ longer)
            turn = (left @ right).T
        turns.append(turn)
    rotation = np.hstack(turns)[:, :bits]
    codes = Codes(rotation, longest, 0)
    asked = np.arange(0, len(rows), max(1, len(rows) // 200))
    products = rows[asked] @ rows.T
    products[np.arange(len(asked)), asked] = -np.inf
    nearest = np.argsort(-products, axis=1)[:, : min(k, max(len(rows) - 1, 0))]
    own, others = codes.encode(rows[asked], query=True), codes.encode(rows)
    differing = np.bitwise_count(own[:, None, :] ^ others[nearest]).sum(axis=2, dtype=np.int64)
    radius = int(np.quantile(differing, SHARE)) if differing.size else bits
    return Codes(rotation, longest, radius)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def usable(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is neither null nor zero nor holds a null or a number that is not finite."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    return df.filter(F.coalesce(good & some, F.lit(False)))


class Block:
    """The codes of some vectors, with an index of each substring."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        self.tables = []
        for values in codes.T:
            order = np.argsort(values, kind="stable")
            distinct, begins = np.unique(values[order], return_index=True)
            self.tables.append((order, distinct, begins, np.diff(np.append(begins, len(values)))))

    def _probe(self, substring: int, value: np.uint32, reach: int) -> np.ndarray:
        """Rows whose substring differs from `value` in at most `reach` bits."""
        order, distinct, begins, sizes = self.tables[substring]
        masks = _masks(reach)
        if masks is not None and len(masks) < len(distinct):
            wanted = masks ^ value
            at = np.minimum(np.searchsorted(distinct, wanted), len(distinct) - 1)
            hit = np.unique(at[distinct[at] == wanted])
        else:  # more probes than there are values: look at these
            hit = np.flatnonzero(np.bitwise_count(distinct ^ value) <= reach)
        sizes = sizes[hit]
        within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return order[np.repeat(begins[hit], sizes) + within]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose code is within `radius`. With radius = m r + a, a code that differs by
        more than r in the first a + 1 substrings and by more than r - 1 in the others lies outside."""
        count = self.codes.shape[1]
        reach, more = divmod(radius, count)
        met = np.zeros(len(self.codes), dtype=bool)
        for substring in range(count):
            own = reach if substring <= more else reach - 1
            if own >= 0:
                met[self._probe(substring, code[substring], min(own, SUBSTRING))] = True
        rows = np.flatnonzero(met)
        return rows[np.bitwise_count(self.codes[rows] ^ code).sum(axis=1, dtype=np.int64) <= radius]


@cache
def _masks(reach: int) -> np.ndarray | None:
    """All substrings with at most `reach` bits set, where these are few."""
    if reach > 3:
        return None
    bits = [sum(1 << b for b in chosen) for n in range(reach + 1) for chosen in combinations(range(SUBSTRING), n)]
    return np.array(bits, dtype=np.uint32)


def _best(vectors: np.ndarray, ids: list[list[int]], rows: np.ndarray, query: np.ndarray, k: int) -> tuple[list[int], list[float]]:
    """Ids and products of the k + 1 best rows, with all rows tied with the last of them."""
    scores = np.einsum("ij,j->i", vectors[rows], query)
    if len(rows) > k + 1:
        least = np.partition(scores, len(rows) - k - 1)[len(rows) - k - 1]
        chosen = np.flatnonzero(scores >= least)
    else:
        chosen = np.arange(len(rows))
    found = [(-scores[c], i) for c in chosen.tolist() for i in ids[rows[c]]]
    found = sorted(found)[: k + 1]  # a query's own row may be one of them
    return [i for _, i in found], [float(-s) for s, _ in found]


def _search(index: DataFrame, asked: DataFrame, radius: int, k: int) -> DataFrame:
    """(name, ids, scores): the best of each block of the index, for each query vector."""

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        names, ids_out, scores_out = [], [], []
        if left.num_rows and right.num_rows:
            block = Block(np.vstack([np.frombuffer(c, dtype="<u4") for c in left["code"].to_pylist()]))
            vectors, ids = _matrix(left["vector"].combine_chunks()), left["ids"].to_pylist()
            queries = _matrix(right["vector"].combine_chunks())
            for name, code, query in zip(right["name"].to_pylist(), right["code"].to_pylist(), queries):
                rows = block.within(np.frombuffer(code, dtype="<u4"), radius)
                if len(rows):
                    best, scores = _best(vectors, ids, rows, query, k)
                    names.append(name)
                    ids_out.append(best)
                    scores_out.append(scores)
        return pa.table(
            {
                "name": pa.array(names, pa.int64()),
                "ids": pa.array(ids_out, pa.list_(pa.int64())),
                "scores": pa.array(scores_out, pa.list_(pa.float64())),
            }
        )

    groups = ["block", "part"]
    return index.groupBy(*groups).cogroup(asked.groupBy(*groups)).applyInArrow(search, "name bigint, ids array<bigint>, scores array<double>")


def nearest_neighbours(df: DataFrame, queries: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, key, score): for each row that `queries` selects, the k rows with the
    largest inner product, nearest first, ties to the smaller key; the query's own is left out.

    The search returns all rows within a Hamming radius and ranks these exactly, so a
    neighbour outside the radius can be missed; no row is left out of the index. Rows with a
    null key, and vectors that are null, zero or not finite, take no part; a query is compared
    with the vectors of its own length, each length having codes of its own. Repeated
    (key, vector) rows count once. Equal vectors are one entry of the index with its k + 1
    smallest keys, which is all that a query can need, and one query, however many rows ask
    it. A key column named like one of the others gets an underscore in front. Runs jobs.
    """
    spark = df.sparkSession
    rows = usable(df, vector).filter(F.col(key).isNotNull())
    rows = rows.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("vector"), queries.alias("asks"))
    rows = settle(rows.withColumn("name", F.xxhash64("vector")).dropDuplicates(["id", "name"]))
    # A table of embeddings has a handful of lengths, of the models that made them.
    lengths = sorted(r["n"] for r in rows.select(F.size("vector").alias("n")).distinct().collect())
    found = [_neighbours(rows.filter(F.size("vector") == n), k) for n in lengths]
    if not found:
        found = [spark.createDataFrame([], "query_id bigint, rank int, id bigint, score double")]
    named = reduce(DataFrame.unionByName, found)
    return named.withColumnRenamed("id", beside(key, ["query_id", "rank", "score"]))


def _neighbours(rows: DataFrame, k: int) -> DataFrame:
    """nearest_neighbours of (id, vector, asks, name) rows with vectors of one length, stored."""
    spark = rows.sparkSession
    order = Window.partitionBy("name").orderBy("id")
    smallest = rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
    vectors = settle(smallest.groupBy("name").agg(F.first("vector").alias("vector"), F.sort_array(F.collect_list("id")).alias("ids")))

    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    stats = vectors.agg(F.max(F.sqrt(squares)).alias("longest"), F.count("*").alias("n"), F.sum(F.size("ids")).alias("ids")).first()
    sample = vectors.select("vector").orderBy(F.xxhash64("name"), "name").limit(SAMPLE).toArrow()
    codes = learn(_matrix(sample["vector"].combine_chunks()), stats["longest"], k)
    shared = spark.sparkContext.broadcast(codes)

    def coder(query: bool):
        def code(vectors: pa.Array) -> pa.Array:
            return pa.array([row.tobytes() for row in shared.value.encode(_matrix(vectors), query)], pa.binary())

        return F.arrow_udf(code, "binary")

    blocks = -(-stats["n"] // ROWS_OF_BLOCK)
    asks = settle(rows.filter("asks").select("name", F.col("id").alias("query_id")))
    asked = vectors.join(asks.select("name").distinct(), "name", "left_semi")
    parts = max(1, -(-asked.count() // QUERIES_OF_BLOCK))
    index = vectors.select("name", "vector", "ids", coder(False)("vector").alias("code"))
    index = settle(index.withColumn("block", F.pmod(F.xxhash64("name", F.lit(1)), F.lit(blocks)).cast("int")))
    asked = asked.select("name", "vector", coder(True)("vector").alias("code"))
    asked = settle(asked.withColumn("part", F.pmod(F.xxhash64("name", F.lit(2)), F.lit(parts)).cast("int")))
    every_part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")

    def answers(some: DataFrame, radius: int) -> DataFrame:
        """(name, id, score): the best k + 1 of each query vector in `some`, stored."""
        found = _search(index.select("block", "vector", "ids", "code", every_part), some.select("*", every_block), radius, k)
        each = found.select("name", F.inline(F.arrays_zip(F.col("ids").alias("id"), F.col("scores").alias("score"))))
        # k + 1, as one of them may be the row that asks.
        best = Window.partitionBy("name").orderBy(F.desc("score"), "id")
        return settle(each.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1).drop("place"))

    with small_batches(spark):
        bits = codes.rotation.shape[1]
        first = answers(asked, codes.radius)
        # A vector is certain to have enough if it met k others, or all there are.
        full = first.groupBy("name").count().filter(F.col("count") >= min(k + 1, stats["ids"]))
        again = settle(asked.join(full, "name", "left_anti"))
        if codes.radius < bits and again.limit(1).count():
            first = settle(first.join(again.select("name"), "name", "left_anti").unionByName(answers(again, bits)))
    own = asks.join(first, "name").filter(F.col("query_id") != F.col("id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = own.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")
