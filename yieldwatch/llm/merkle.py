"""A Merkle manifest: binary hash trees over ordered leaves, with a proof for every leaf.

Each group of rows (a tree) orders its leaves; two consecutive nodes become their digest,
the last one alone where the count is odd, until one node is left. The remaining nodes of
all trees, ordered by tree, are joined to one root in the same way.

A node carries the interval [lo, hi) of leaf ranks that it covers, so ancestry is containment
of intervals and the siblings of a node are what its parent's interval holds besides its own.
Levels are handled in strata of LEVELS, and ranks in buckets of one subtree of that height:
nodes of a stratum are made bucket by bucket, written as a table, and joined by containment
with the nodes below them within (tree, bucket). A bucket has at most 2**LEVELS rows
whatever the size of its tree, so a tree that holds most rows is many buckets. Strata are
proved from the top down, so what stands above a bucket is one row that joins its leaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yieldwatch.llm.columns import free_name, without
from yieldwatch.sources.scratch import settle

#: Height of the subtree that one bucket holds.
LEVELS = 8
FANOUT = 2
HEX = 64
STEPS = "array<struct<left:string,right:string>>"

_NODE = "tree string, size bigint, bucket bigint, level int, lo bigint, hi bigint, digest string"


def encode_field(column: str | Column) -> Column:
    """`-` for null, else the UTF-8 byte count, a colon and the value."""
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: Sequence[str | Column]) -> Column:
    """Lowercase hex sha256 of the encoded columns, one after the other."""
    return F.sha2(F.concat(*[encode_field(c) for c in columns]).cast("binary"), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf digest and its proof lead to."""
    return F.aggregate(proof, leaf, lambda digest, step: F.sha2(F.concat(step["left"], digest, step["right"]).cast("binary"), 256))


def proof_digest(proof: Column) -> Column:
    """sha256 of all sibling digests of a proof, level by level, left to right."""
    siblings = F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), "")
    return F.sha2(siblings.cast("binary"), 256)


@dataclass(frozen=True)
class Manifest:
    """leaves: the caller's columns with rank, subroot, root and proof.
    nodes: a row for each inner node: tree, level, lo, hi, digest. Trees are named `+value`,
    a null one `!`, and the one that joins their last nodes is ''."""

    leaves: DataFrame
    nodes: DataFrame


def rank_rows(df: DataFrame, tree: str, order: Sequence[str], rank: str, size: str) -> DataFrame:
    """Gapless `rank` from 0 by `order` within each tree, and the tree's `size`.

    Rows are dealt into ranges of (tree, order) and numbered inside them; the ranges' counts
    give the offsets, one row per range and tree. Rows that tie are told apart by a number of
    their own, so a third of all rows may be equal and still be split. Runs a job.
    """
    tie, place, part, first = (free_name(df, n) for n in ("_tie", "_place", "_part", "_first"))
    numbered = settle(df.withColumn(tie, F.monotonically_increasing_id()))
    dealt = numbered.repartitionByRange(tree, *order, tie).sortWithinPartitions(tree, *order, tie)
    dealt = settle(dealt.drop(tie).withColumn(place, F.monotonically_increasing_id()))
    dealt = dealt.withColumn(part, F.shiftright(place, 33))
    ranges = dealt.groupBy(tree, part).agg(F.min(place).alias(first), F.count("*").alias(size))
    before = Window.partitionBy(tree).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        tree,
        part,
        (F.coalesce(F.sum(size).over(before), F.lit(0)) - F.col(first)).alias(first),
        F.sum(size).over(Window.partitionBy(tree)).alias(size),
    )
    joined = dealt.join(settle(ranges), [tree, part])
    return joined.select(*without(df, [rank, size]), (F.col(place) + F.col(first)).alias(rank), size)


def _digests(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.array(array.to_pylist(), dtype=f"S{HEX}")


def _strings(cells: np.ndarray) -> pa.Array:
    """Arrow strings of an array of digests, where b'' is the empty string."""
    lengths = np.where(cells == b"", 0, HEX)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    data = cells[lengths > 0].tobytes()
    return pa.StringArray.from_buffers(len(cells), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data))


def _sorted(table: pa.Table, by: str) -> pa.Table:
    return table.take(np.argsort(table[by].to_numpy(), kind="stable"))


def _parents(table: pa.Table) -> pa.Table:
    """All nodes above the base nodes of one bucket, up to the bucket's or the tree's top."""
    table = _sorted(table, "lo")
    tree, size, bucket = (table[c][0].as_py() for c in ("tree", "size", "bucket"))
    level = table["level"][0].as_py()
    lo, hi = table["lo"].to_numpy(), table["hi"].to_numpy()
    digest = [d.encode() for d in table["digest"].to_pylist()]
    levels, los, his, digests = [], [], [], []
    for step in range(1, LEVELS + 1):
        if len(lo) == 1 and hi[0] - lo[0] == size:
            break  # the tree's last node
        digest = [hashlib.sha256(b"".join(digest[i : i + FANOUT])).hexdigest().encode() for i in range(0, len(digest), FANOUT)]
        hi = np.append(hi[FANOUT - 1 : len(hi) - 1 : FANOUT], hi[-1])[: len(digest)]
        lo = lo[::FANOUT]
        levels += [level + step] * len(lo)
        los.append(lo)
        his.append(hi)
        digests += digest
    n = len(levels)
    numbers = [np.concatenate(x) if n else np.zeros(0, dtype=np.int64) for x in (los, his)]
    return pa.table(
        {
            "tree": pa.array([tree] * n, pa.string()),
            "size": pa.array([size] * n, pa.int64()),
            "bucket": pa.array([bucket] * n, pa.int64()),
            "level": pa.array(levels, pa.int32()),
            "lo": pa.array(numbers[0], pa.int64()),
            "hi": pa.array(numbers[1], pa.int64()),
            "digest": pa.array([d.decode() for d in digests], pa.string()),
        }
    )


def _siblings(lo: np.ndarray, hi: np.ndarray, level: dict, parents: dict) -> tuple[np.ndarray, np.ndarray]:
    """For base nodes [lo, hi): the digests left and right of their ancestor in `level`,
    within the interval of the parent that contains them. b'' where there is none."""
    parent = np.searchsorted(parents["lo"], lo, side="right") - 1
    own = np.searchsorted(level["lo"], lo, side="right") - 1
    if (parents["hi"][parent] < hi).any() or (level["hi"][own] < hi).any():
        raise ValueError("an interval of ranks is not inside its parent's")
    first = np.searchsorted(level["lo"], parents["lo"][parent])
    last = np.searchsorted(level["lo"], parents["hi"][parent]) - 1
    left = np.where(first < own, level["digest"][first], b"")
    right = np.where(last > own, level["digest"][last], b"")
    return left, right


def _attach(base: pa.Table, above: pa.Table) -> pa.Table:
    """The base rows of one bucket with the siblings on their way up. `above`: the bucket's
    nodes, and a row of level -1 with the steps, subroot and root above the bucket."""
    lo, hi = base["lo"].to_numpy(), base["hi"].to_numpy()
    order = np.argsort(lo, kind="stable")
    start = {"lo": lo[order], "hi": hi[order], "digest": _digests(base["digest"])[order]}
    number = above["level"].to_numpy()
    outer = above.take([int(np.flatnonzero(number == -1)[0])]).to_pylist()[0]
    way = [start]
    for step in sorted(set(number.tolist()) - {-1}):
        rows = _sorted(above.take(np.flatnonzero(number == step)), "lo")
        way.append({"lo": rows["lo"].to_numpy(), "hi": rows["hi"].to_numpy(), "digest": _digests(rows["digest"])})
    found = [_siblings(lo, hi, level, parents) for level, parents in zip(way, way[1:], strict=False)]
    for step in outer["steps"]:
        found.append(tuple(np.full(len(lo), step[side].encode(), dtype=f"S{HEX}") for side in ("left", "right")))
    n, height = len(lo), len(found)
    sides = [np.column_stack([f[side] for f in found]).reshape(-1) if height else np.zeros(0, f"S{HEX}") for side in (0, 1)]
    steps = pa.StructArray.from_arrays([_strings(s.astype(f"S{HEX}")) for s in sides], ["left", "right"])
    proof = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * height, pa.int32()), steps)
    columns = [base[c] for c in base.column_names if c not in ("bucket", "level", "hi")]
    names = [c for c in base.column_names if c not in ("bucket", "level", "hi")]
    ends = [pa.array([outer[c]] * n, pa.string()) for c in ("subroot", "root")]
    return pa.table([*columns, proof, *ends], names=[*names, "proof", "subroot", "root"])


def _in_buckets(nodes: DataFrame, level: int) -> DataFrame:
    """Base nodes of a level with the bucket of the stratum that they are the base of."""
    return nodes.withColumn("bucket", F.shiftright("lo", level + LEVELS)).withColumn("level", F.lit(level))


def _strata(leaves: DataFrame, largest: int) -> list[tuple[DataFrame, DataFrame]]:
    """(base, nodes) of each stratum, from the leaves up, both written."""
    base, level, out = leaves, 0, []
    while True:
        base = _in_buckets(base, level)
        narrow = base.select("tree", "size", "bucket", "level", "lo", "hi", "digest")
        nodes = settle(narrow.groupBy("tree", "bucket").applyInArrow(_parents, _NODE))
        out.append((base, nodes))
        level += LEVELS
        if FANOUT**level >= largest:
            return out
        top = F.col("level") == level
        unfinished = F.col("hi") - F.col("lo") < F.col("size")
        base = nodes.filter(top & unfinished).select("tree", "size", "lo", "hi", "digest")


def _prove(strata: list[tuple[DataFrame, DataFrame]], tops: DataFrame) -> DataFrame:
    """Base rows of the lowest stratum with proof, subroot and root.

    tops: tree, size, steps, subroot, root: what stands above each tree's last node.
    """
    proved = None
    for number in range(len(strata) - 1, -1, -1):
        base, nodes = strata[number]
        least, most = FANOUT ** (number * LEVELS), FANOUT ** ((number + 1) * LEVELS)
        ends = (F.col("size") <= most) & ((F.col("size") > least) | F.lit(number == 0))
        above = ["tree", "bucket", "steps", "subroot", "root"]
        here = tops.filter(ends).withColumn("bucket", F.lit(0).cast("bigint")).select(*above)
        if proved is not None:
            shift = F.shiftright("lo", number * LEVELS + LEVELS)
            here = here.unionByName(proved.select("tree", shift.alias("bucket"), F.col("proof").alias("steps"), "subroot", "root"))
        joined = nodes.drop("size").unionByName(here.withColumn("level", F.lit(-1)), allowMissingColumns=True)
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema if f.name not in ("bucket", "level", "hi")]
        schema = ", ".join([*fields, f"proof {STEPS}", "subroot string", "root string"])
        proved = base.groupBy("tree", "bucket").cogroup(joined.groupBy("tree", "bucket")).applyInArrow(_attach, schema)
        if number:
            proved = settle(proved)
    return proved


def _last_nodes(leaves: DataFrame, strata: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """tree, size and digest of the one node that is left of each tree."""
    whole = (F.col("lo") == 0) & (F.col("hi") == F.col("size"))
    found = [leaves, *[nodes for _, nodes in strata]]
    return reduce(DataFrame.unionByName, [f.filter(whole).select("tree", "size", "digest") for f in found])


def build(df: DataFrame, tree: str, order: Sequence[str], digest: str) -> Manifest:
    """The manifest of rows with a leaf digest (lowercase hex) in `digest`.

    `tree` names the column of the trees' names, `order` the columns that order a tree's
    leaves; ties are ordered by digest. Trees are ordered by name, null first, by UTF-8 bytes.
    Nulls in `order` come first. Equal rows are leaves of their own. Without rows both tables
    are empty. A null digest is an error. Columns of `df` named rank, subroot, root or proof
    are replaced, all others are returned. Runs jobs: tables are written to the shared folder.
    """
    made = ["rank", "subroot", "root", "proof"]
    # Internal names beside the caller's columns, which travel in a struct.
    kept = without(df, made)
    name = F.coalesce(F.concat(F.lit("+"), F.col(tree).cast("string")), F.lit("!"))
    rows = df.select(
        name.alias("tree"),
        F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)]).alias("sort"),
        F.coalesce(F.col(digest), F.raise_error(F.lit("a leaf has no digest"))).alias("digest"),
        F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(kept)]).alias("row"),
    )
    ranked = rank_rows(rows, "tree", ["sort", "digest"], "lo", "size")
    leaves = settle(ranked.select("tree", "size", "lo", (F.col("lo") + 1).alias("hi"), "digest", "row"))
    largest = leaves.agg(F.max("size")).first()[0] or 0
    strata = _strata(leaves, largest)

    last = _last_nodes(leaves, strata).withColumnRenamed("tree", "of").withColumn("tree", F.lit(""))
    last = rank_rows(last.withColumnRenamed("size", "leaves"), "tree", ["of"], "lo", "size")
    trees = settle(last.select("tree", "size", "lo", (F.col("lo") + 1).alias("hi"), "digest", "of", "leaves"))
    count = trees.count()
    above = _strata(trees, count)
    none = F.lit(None).cast("string")
    root = _last_nodes(trees, above).select(
        "tree", "size", F.array().cast(STEPS).alias("steps"), none.alias("subroot"), F.col("digest").alias("root")
    )
    joined = _prove(above, root)
    tops = settle(joined.select(F.col("of").alias("tree"), F.col("leaves").alias("size"), F.col("proof").alias("steps"), F.col("digest").alias("subroot"), "root"))

    proved = _prove(strata, tops)
    columns = [F.col(f"row.c{i}").alias(c) for i, c in enumerate(kept)]
    nodes = reduce(DataFrame.unionByName, [n.drop("size", "bucket") for _, n in [*strata, *above]])
    return Manifest(proved.select(*columns, F.col("lo").alias("rank"), "subroot", "root", "proof"), nodes)
