"""Similarity join of word shingles by adaptive multi-match prefixes.

Two texts link when the Jaccard similarity of their sets of five-word shingles is 0.75 or
more. Shingles have one global order, rare ones first: their counts in a sketch of fixed
size rank the sketch's cells, and the rank takes the place of the cell in the shingle's
hash, so that hashes sort by rarity. Sets that link share a shingle among the first n - ceil(0.75 n) + 1
of the larger and the first n - ceil(6/7 n) + 1 of the smaller; prefixes longer by l - 1 must share l. Each text takes the l
that makes its postings and expected candidates cheapest. Texts that share too few shingles
of their prefixes with texts of a fitting size are dropped before any set is moved and compared.

Equal sets are one class and take part once. Texts that share a prefix shingle form a list.
Lists are put together by their most usual member, the pivot, and compared there, block by block;
only a tree of the links leaves a block, never its pairs. In a group of several blocks each set is
first compared with the pivot alone: those that link with it are one component already, and
only the others are compared with the group. No link between different sets is
lost, and components are exact.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from yieldwatch.llm import bloom
from yieldwatch.llm.columns import beside, computed_once, free_name
from yieldwatch.llm.components import connected_components
from yieldwatch.llm.words import mix, shingles_of, words_of
from yieldwatch.sources.scratch import settle

NEED = 75  # per cent
CELL_BITS = 20
CELLS = 1 << CELL_BITS
BLOCK = 1 << 14  # cells of the sketch that one task adds up
MOVE = 16  # to deal out one posting costs as much as this many comparisons
POSTINGS = 1_000_000  # postings of a bucket, about
HELD_POSTINGS = 500_000  # postings that a task holds before it deals them out
PER_SALT = 1 << 16  # a list expected to be longer is spread over several buckets
MOST_SETS = 256  # sets of a block, about
MOST_TOKENS = 1 << 20  # shingles of all sets of a block, about
MANY = 1024  # pairs that share a shingle; above, matrices count them
BATCH_BYTES = 16 << 20
PACKED = ["tokens", "inner", "at", "classes", "sizes", "least"]  # of the postings of one bucket

_LOW = np.uint64((1 << (64 - CELL_BITS)) - 1)
_SHIFT = np.uint64(64 - CELL_BITS)


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Within this block, Arrow batches hold BATCH_BYTES at most, or one row that has more."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def needed(n: np.ndarray) -> np.ndarray:
    """Shingles that a set of n shares with any set that links with it."""
    return (NEED * n + 99) // 100


def needed_of_longer(n: np.ndarray) -> np.ndarray:
    """Shingles that a set of n shares with any set at least as large that links with it."""
    return (2 * NEED * n + 99 + NEED) // (100 + NEED)


def distinct_sets(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct hashes between offsets, and their offsets."""
    hashes = hashes.copy()
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        hashes[a:b].sort()
    if not len(hashes):
        return hashes, np.zeros(len(offsets), dtype=np.int64)
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = hashes[1:] != hashes[:-1]
    new[offsets[:-1][offsets[:-1] < len(hashes)]] = True
    before = np.concatenate([[0], np.cumsum(new)])
    return hashes[new], before[offsets]


def set_classes(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit name for each set; equal sets have equal names, an empty set has 0."""
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)))])
    sums = total[offsets[1:]] - total[offsets[:-1]]
    sizes = np.diff(offsets).astype(np.uint64)
    return np.where(sizes > 0, mix(sums + sizes * np.uint64(0x14057B7EF767814F)), np.uint64(0)).view(np.int64)


def _sets(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first, last, distinct shingles, their offsets, classes) for ranges of texts."""
    for first, last, words in words_of(texts):
        hashes, offsets = distinct_sets(*shingles_of(words))
        yield first, last, hashes, offsets, set_classes(hashes, offsets)


def _once(classes: np.ndarray, seen: set[int]) -> np.ndarray:
    """Which classes are neither empty nor already seen by this task."""
    fresh = np.zeros(len(classes), dtype=bool)
    for i, c in enumerate(classes.tolist()):
        if c and c not in seen:
            seen.add(c)
            fresh[i] = True
    return fresh


def describe(df: DataFrame, text: str, key: str) -> DataFrame:
    """A stored table of (key, n_shingles, class) rows and of the blocks of each task's sketch."""
    kind = df.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, seen, count = np.zeros(CELLS, dtype=np.int64), set(), 0
        for batch in batches:
            for first, last, hashes, offsets, classes in _sets(batch.column(1)):
                sizes = np.diff(offsets)
                fresh = np.repeat(_once(classes, seen), sizes)
                cells += np.bincount((hashes[fresh] >> _SHIFT).astype(np.int64), minlength=CELLS)
                count += last - first
                none = pa.nulls(last - first, pa.binary())
                block = pa.array(np.full(last - first, -1, dtype=np.int32))
                columns = [batch.column(0).slice(first, last - first), pa.array(sizes), pa.array(classes), block, none]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "n_shingles", "class", "block", "cells"])
        if count:
            at = pa.array(np.arange(CELLS // BLOCK, dtype=np.int32))
            blocks = [x.astype("<u4").tobytes() for x in np.minimum(cells, 2**32 - 1).reshape(-1, BLOCK)]
            none = pa.nulls(len(at), pa.int64())
            key_column = pa.nulls(len(at), pa_type)
            yield pa.RecordBatch.from_arrays([key_column, none, none, at, pa.array(blocks, pa.binary())], names=["key", "n_shingles", "class", "block", "cells"])

    pa_type = to_arrow_type(kind)
    schema = f"key {kind.simpleString()}, n_shingles bigint, class bigint, block int, cells binary"
    return settle(df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema))


def _add_blocks(table: pa.Table) -> pa.Table:
    total = np.zeros(BLOCK, dtype=np.uint64)
    for cells in table["cells"].to_pylist():
        total += np.frombuffer(cells, dtype="<u4")
    summed = np.minimum(total, 2**32 - 1).astype("<u4").tobytes()
    return pa.table({"block": table["block"].slice(0, 1), "cells": pa.array([summed], pa.binary())})


def cell_counts(described: DataFrame) -> np.ndarray:
    """The sum of all tasks' sketches; its fixed size reaches the driver. Added up in two
    steps, so that no task gathers the sketches of very many."""
    blocks = described.filter("block >= 0").select("block", "cells", (F.spark_partition_id() % 64).alias("part"))
    for keys in (["block", "part"], ["block"]):
        blocks = blocks.groupBy(*keys).applyInArrow(_add_blocks, "block int, cells binary")
    total = np.zeros((CELLS // BLOCK, BLOCK), dtype=np.int64)
    for row in blocks.collect():
        total[row["block"]] = np.frombuffer(row["cells"], dtype="<u4")
    return total.ravel()


class Order:
    """The global order of shingles: rank of the cell, then the rest of the hash."""

    def __init__(self, counts: np.ndarray) -> None:
        by_count = np.argsort(counts, kind="stable")
        rank = np.empty(CELLS, dtype=np.uint64)
        rank[by_count] = np.arange(CELLS, dtype=np.uint64)
        self.rank = rank
        # Counts above the level that unrelated shingles of a cell add up to.
        self.expected = np.maximum(counts[by_count] - int(np.median(counts)), 1)

    def sort(self, hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The shingles renamed so that they sort by rarity, sorted in each set."""
        out = (self.rank[(hashes >> _SHIFT).astype(np.int64)] << _SHIFT) | (hashes & _LOW)
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            out[a:b].sort()
        return out

    def lists(self, tokens: np.ndarray) -> np.ndarray:
        """Expected length of the list of each (renamed) shingle."""
        return self.expected[(tokens >> _SHIFT).astype(np.int64)]

    def required(self, tokens: np.ndarray) -> int:
        """The l of one set: shared shingles to require, where the postings of the prefix and
        the comparisons with candidates, at most list lengths / l, are cheapest together."""
        n = len(tokens)
        base = n - int(needed(np.int64(n)))
        most = max(1, min(n - base, n // 2))
        lists = np.cumsum(self.lists(tokens[: base + most]))[base:]
        return int(np.argmin(lists * (MOVE + n / np.arange(1, most + 1)))) + 1


def _salts(lists: np.ndarray) -> np.ndarray:
    return lists // PER_SALT + 1


def _least_in(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The smallest of values[low:high] for each pair of bounds, which are not empty."""
    longest = int((high - low).max()) if len(low) else 1
    table = [values]
    while (1 << len(table)) <= longest:
        step, last = 1 << (len(table) - 1), table[-1].copy()
        last[:-step] = np.minimum(last[:-step], table[-1][step:])
        table.append(last)
    level = np.log2(high - low).astype(np.int64)
    levels = np.stack(table)
    return np.minimum(levels[level, low], levels[level, high - (1 << level)])


def active_lists(df: DataFrame, text: str, order, buckets: int) -> DataFrame:
    """Stored (list, class, size, inner): classes that share shingles of their prefixes, as
    many as needed. inner: the shingle is in the prefix that meets larger sets.

    A posting counts for its class if another one of the same shingle belongs to a set of a
    size that can link. A class stays if it has as many such postings as it must share with
    a partner. Lists with the same members are one, and lists are cut where sizes are too far
    apart. Lists expected to be very long are spread over buckets and passed on as they are.
    """

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple[np.ndarray, ...]] = []
        count = 0

        def flush() -> pa.RecordBatch:
            tokens, inner, classes, sizes, least, postings = (np.concatenate(x) for x in zip(*held))
            owner = np.repeat(np.arange(len(classes)), postings)
            salts = _salts(order.value.lists(tokens)).astype(np.uint64)
            salt = mix(classes.view(np.uint64))[owner] % salts
            bucket = (mix(tokens + salt * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(buckets)).astype(np.int32)
            by = np.argsort(bucket, kind="stable")
            tokens, inner, owner, bucket = tokens[by], inner[by], owner[by], bucket[by]
            begins = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            columns: list[list[bytes]] = [[], [], [], [], [], []]
            for a, b in zip(begins.tolist(), np.append(begins[1:], len(bucket)).tolist()):
                own, at = np.unique(owner[a:b], return_inverse=True)
                rows = (tokens[a:b], inner[a:b], at.astype("<u4"), classes[own], sizes[own].astype("<u4"), least[own].astype("<u4"))
                for column, row in zip(columns, rows):
                    column.append(row.tobytes())
            packed = [pa.array(column, pa.binary()) for column in columns]
            return pa.RecordBatch.from_arrays([pa.array(bucket[begins]), *packed], names=["bucket", *PACKED])

        for batch in batches:
            for _, _, hashes, offsets, classes in _sets(batch.column(0)):
                fresh = np.flatnonzero(_once(classes, seen))
                tokens = order.value.sort(hashes, offsets)
                sizes = np.diff(offsets)[fresh]
                least = np.array([order.value.required(tokens[offsets[i] : offsets[i + 1]]) for i in fresh], dtype=np.int64)
                postings = sizes - needed(sizes) + least
                begin = offsets[:-1][fresh]
                place = np.arange(postings.sum()) - np.repeat(np.cumsum(postings) - postings, postings)
                at = place + np.repeat(begin, postings)
                inner = place < np.repeat(sizes - needed_of_longer(sizes) + least, postings)
                held.append((tokens[at], inner, classes[fresh], sizes, least, postings))
                count += len(at)
                if count >= HELD_POSTINGS:
                    yield flush()
                    held, count = [], 0
        if count:
            yield flush()

    def gather(table: pa.Table) -> pa.Table:
        parts = []
        for tokens, inner, at, classes, sizes, least in zip(*(table[c].to_pylist() for c in PACKED)):
            own = np.frombuffer(at, dtype="<u4")
            columns = [np.frombuffer(classes, dtype=np.int64), np.frombuffer(sizes, dtype="<u4"), np.frombuffer(least, dtype="<u4")]
            parts.append((np.frombuffer(tokens, dtype=np.uint64), np.frombuffer(inner, dtype=bool), *(c[own].astype(np.int64) for c in columns)))
        rows = [np.concatenate(x) for x in zip(*parts)]
        by = np.lexsort((rows[2], rows[3], rows[0]))  # token, size, class
        rows = [x[by] for x in rows]
        fresh = np.concatenate([[True], (rows[0][1:] != rows[0][:-1]) | (rows[2][1:] != rows[2][:-1])])
        tokens, inner, classes, sizes, least = (x[fresh] for x in rows)
        spread = _salts(order.value.lists(tokens)) > 1
        # Members whose size lets them link, between 3/4 and 4/3 of the own size: low to high.
        number = np.cumsum(np.concatenate([[0], tokens[1:] != tokens[:-1]])).astype(np.int64) << 32
        key = number + sizes
        low = np.searchsorted(key, number + (NEED * sizes + 99) // 100)
        high = np.searchsorted(key, number + 100 * sizes // NEED, side="right")
        # A pair counts where the smaller set has the shingle in its inner prefix.
        inner_before = np.concatenate([[0], np.cumsum(inner)])
        smaller = inner_before[np.searchsorted(key, key, side="right")] - inner_before[low]
        larger = high - np.searchsorted(key, key)
        kept = spread | np.where(inner, (smaller > 1) | (larger > 1), smaller > 0)
        least = np.where(spread, 1, _least_in(least, low, high))
        tokens, inner, classes, sizes, least, spread = (x[kept] for x in (tokens, inner, classes, sizes, least, spread))
        if not len(tokens):
            return pa.table({"list": classes, "class": classes, "size": classes, "inner": inner, "postings": classes, "least": classes})
        new = np.ones(len(tokens), dtype=bool)
        apart = (100 * sizes[:-1] < NEED * sizes[1:]) & ~spread[1:]
        new[1:] = (tokens[1:] != tokens[:-1]) | apart
        begins = np.flatnonzero(new)
        members = np.diff(np.append(begins, len(tokens)))
        names = mix(np.add.reduceat(mix(classes.view(np.uint64) + inner.astype(np.uint64)), begins) + members.astype(np.uint64))
        names[spread[begins]] = tokens[begins][spread[begins]]
        _, one, times = np.unique(names, return_index=True, return_counts=True)
        postings = np.zeros(len(begins), dtype=np.int64)
        postings[one] = times
        chosen = np.repeat(postings, members) > 0
        out = {"list": np.repeat(names, members).view(np.int64), "class": classes, "size": sizes, "inner": inner, "postings": np.repeat(postings, members), "least": least}
        return pa.table({name: column[chosen] for name, column in out.items()})

    posted = df.select(text).mapInArrow(post, "bucket int, " + ", ".join(f"{c} binary" for c in PACKED))
    gathered = posted.groupBy("bucket").applyInArrow(gather, "list bigint, class bigint, size bigint, inner boolean, postings bigint, least bigint")
    lists = settle(
        gathered.groupBy("list", "class", "size").agg(F.max("inner").alias("inner"), F.sum("postings").alias("postings"), F.min("least").alias("least"))
    )
    enough = lists.groupBy("class").agg(F.sum("postings").alias("n"), F.min("least").alias("l")).filter("n >= l")
    strong = lists.join(settle(enough.select("class")), "class", "left_semi").select("list", "class", "size", "inner")
    shared = strong.groupBy("list").agg(F.count("*").alias("n"), F.max("inner").alias("inner")).filter("n > 1 AND inner").select("list")
    return settle(strong.join(settle(shared), "list", "left_semi"))


def candidate_sets(df: DataFrame, text: str, order, bits) -> DataFrame:
    """Stored (class, tokens) of the classes that the filter lets through, once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for _, _, hashes, offsets, classes in _sets(batch.column(0)):
                fresh = bloom.contains(bits.value, classes.view(np.uint64)) & _once(classes, seen)
                if not fresh.any():
                    continue
                tokens = order.value.sort(hashes, offsets)
                sets = [tokens[offsets[i] : offsets[i + 1]] for i in np.flatnonzero(fresh)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(classes[fresh]),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    names=["class", "tokens"],
                )

    return settle(df.select(text).mapInArrow(run, "class bigint, tokens binary").dropDuplicates(["class"]))


def _columns(tokens: list[np.ndarray], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(column, set) of all tokens that are in `wanted` (sorted), by column."""
    every = np.concatenate(tokens)
    owner = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
    at = np.minimum(np.searchsorted(wanted, every), len(wanted) - 1)
    found = wanted[at] == every
    column, owner = at[found], owner[found]
    by = np.argsort(column, kind="stable")
    return column[by], owner[by]


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Shared shingles of each set on the left with each on the right.

    Shingles of many sets are columns of matrices, which are multiplied; those of few are
    counted pair by pair.
    """
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    wanted = np.intersect1d(np.concatenate(left), np.concatenate(right))
    if not len(wanted):
        return out
    (col_l, own_l), (col_r, own_r) = _columns(left, wanted), _columns(right, wanted)
    n_l, n_r = np.bincount(col_l, minlength=len(wanted)), np.bincount(col_r, minlength=len(wanted))
    many = n_l * n_r > MANY
    for dense in np.array_split(np.flatnonzero(many), max(1, int(many.sum()) // 1024)):
        if len(dense):
            sides = []
            for column, owner, rows in ((col_l, own_l, len(left)), (col_r, own_r, len(right))):
                low, high = np.searchsorted(column, [dense[0], dense[-1] + 1])
                at = np.searchsorted(dense, column[low:high])
                inside = dense[np.minimum(at, len(dense) - 1)] == column[low:high]
                matrix = np.zeros((rows, len(dense)), dtype=np.float32)
                matrix[owner[low:high][inside], at[inside]] = 1
                sides.append(matrix)
            out += sides[0] @ sides[1].T
    few = ~many[col_l]
    column, rows = col_l[few], own_l[few]
    times = n_r[column]
    begin = (np.cumsum(n_r) - n_r)[column]
    place = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    cells = np.repeat(rows, times) * len(right) + own_r[np.repeat(begin, times) + place]
    return out + np.bincount(cells, minlength=out.size).reshape(out.shape)


def _tree(classes: np.ndarray, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node of a link to one node of its component, for links u - v."""
    label = np.arange(len(classes))
    while True:
        new = label.copy()
        np.minimum.at(new, u, label[v])
        np.minimum.at(new, v, label[u])
        new = new[new]
        if (new == label).all():
            break
        label = new
    far = np.flatnonzero(label != np.arange(len(classes)))
    return classes[far], classes[label[far]]


def _sets_of(table: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(packed, dtype=np.uint64) for packed in table["tokens"].to_pylist()]


def _links(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Whether each set on the left links with each on the right."""
    both = overlaps(left, right).astype(np.float64)
    n, m = (np.array([len(s) for s in sets], dtype=np.float64) for sets in (left, right))
    return 100 * both >= NEED * (n[:, None] + m[None, :] - both)


def _link(table: pa.Table) -> pa.Table:
    """Links between all sets of one block, as a spanning tree."""
    classes, sets = table["class"].to_numpy(), _sets_of(table)
    u, v = np.nonzero(_links(sets, sets))
    a, b = _tree(classes, u, v)
    return pa.table({"a": a, "b": b})


def _link_with_pivot(table: pa.Table) -> pa.Table:
    """(pivot, a, b): each set of a block with its pivot if they link, else with null."""
    classes, sets = table["class"].to_numpy(), _sets_of(table)
    pivot = table["pivot"][0].as_py()
    first = int(np.flatnonzero(classes == pivot)[0])
    others = np.flatnonzero(classes != pivot)
    linked = _links([sets[first]], [sets[i] for i in others.tolist()])[0] if len(others) else np.zeros(0, dtype=bool)
    ends = pa.array([pivot if yes else None for yes in linked.tolist()], pa.int64())
    return pa.table({"pivot": pa.array([pivot] * len(others), pa.int64()), "a": classes[others], "b": ends})


def _link_across(table: pa.Table) -> pa.Table:
    """Links between the unsettled sets of a block and the sets of another, as a spanning tree."""
    unsettled = table["unsettled"].to_numpy(zero_copy_only=False)
    classes, sets = table["class"].to_numpy(), _sets_of(table)
    left, right = np.flatnonzero(unsettled), np.flatnonzero(~unsettled)
    if not len(left) or not len(right):
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    u, v = np.nonzero(_links([sets[i] for i in left.tolist()], [sets[i] for i in right.tolist()]))
    a, b = _tree(classes, left[u], right[v])
    # A class that stands on both sides is one node.
    some = a != b
    return pa.table({"a": a[some], "b": b[some]})


def _blocks_of(count: Column, size: Column) -> Column:
    return F.greatest(F.ceil(count / MOST_SETS), F.ceil(size / MOST_TOKENS)).cast("int")


def linked_classes(lists: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, root) of all classes that link with another.

    The pivot of a list is the member that is in most lists: of near copies, the one with
    the fewest changes of its own. All lists with the same pivot are one group, so a class is
    in few groups, and two classes with a common list have a common group. A group of one block
    of bounded size is compared in one task. A larger one is compared with its pivot, block by
    block; sets that link with it need no comparison among themselves, and each block of the
    others meets each block of the group. Tasks return trees of the links they find and never the pairs.
    """
    usual = settle(lists.groupBy("class").agg(F.count("*").alias("usual")))
    lists = settle(lists.join(usual, "class"))
    pivots = settle(lists.groupBy("list").agg(F.max(F.struct("usual", "class"))["class"].alias("pivot")))
    members = settle(lists.join(pivots, "list").select("pivot", "class", "size").distinct())
    sizes = members.groupBy("pivot").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    groups = settle(sizes.filter("n > 1").select("pivot", _blocks_of(F.col("n"), F.col("size")).alias("blocks")))
    block = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int").alias("block")
    dealt = members.join(groups, "pivot").select("pivot", "class", "size", "blocks", block)

    small = dealt.filter("blocks = 1").select("pivot", "class")
    links = small.join(sets, "class").groupBy("pivot").applyInArrow(_link, "a bigint, b bigint")

    large = dealt.filter("blocks > 1")
    # The pivot's set goes to each block of its group.
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    pivot_sets = groups.filter("blocks > 1").select("pivot", F.col("pivot").alias("class"), every)
    rows = large.filter("class <> pivot").select("pivot", "class", "block").unionByName(pivot_sets)
    star = rows.join(sets, "class").groupBy("pivot", "block").applyInArrow(_link_with_pivot, "pivot bigint, a bigint, b bigint")
    star = settle(star)
    links = links.unionByName(star.filter("b IS NOT NULL").select("a", "b"))

    open_ = star.filter("b IS NULL").select("pivot", F.col("a").alias("class"))
    if not open_.isEmpty():
        open_ = settle(open_.join(members, ["pivot", "class"]))
        counts = open_.groupBy("pivot").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
        counts = settle(counts.select("pivot", _blocks_of(F.col("n"), F.col("size")).alias("parts")))
        part = F.pmod(F.xxhash64("class", F.lit(1)), F.col("parts")).cast("int")
        blocks = groups.select("pivot", "blocks")
        unsettled = open_.join(counts, "pivot").join(blocks, "pivot").select(
            "pivot", "class", part.alias("part"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(True).alias("unsettled")
        )
        whole = large.join(counts, "pivot").select(
            "pivot", "class", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "block", F.lit(False).alias("unsettled")
        )
        across = unsettled.unionByName(whole).join(sets, "class").groupBy("pivot", "part", "block")
        links = links.unionByName(across.applyInArrow(_link_across, "a bigint, b bigint"))
    return settle(connected_components(settle(links.distinct()), "a", "b"))


def text_class(text: str | Column) -> Column:
    """The class of a text: equal for equal sets of shingles, 0 for a text without words."""

    def run(texts: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([c for *_, c in _sets(texts)] + [np.zeros(0, dtype=np.int64)]), pa.int64())

    return computed_once(run, "bigint")(text)


def _classes(df: DataFrame, text: str, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows (key, n_shingles, class), and a stored (class, root, least key)."""
    spark = df.sparkSession
    with small_batches(spark):
        described = describe(df, text, key)
        rows = described.filter("block = -1").select("key", "n_shingles", "class")
        total = rows.agg(F.sum("n_shingles")).first()[0] or 0
        order = spark.sparkContext.broadcast(Order(cell_counts(described)))  # CELLS numbers
        buckets = max(64, total // 3 // POSTINGS)
        lists = active_lists(df, text, order, buckets)
        bits = spark.sparkContext.broadcast(bloom.build(lists, "class"))
        sets = candidate_sets(df, text, order, bits)
        roots = linked_classes(lists, sets)
    least = rows.filter("n_shingles > 0").groupBy("class").agg(F.min("key").alias("least"))
    grouped = least.join(roots.select(F.col("node").alias("class"), "root"), "class", "left")
    return rows, settle(grouped.select("class", "least", F.coalesce("root", "class").alias("root")))


def similarity_components(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_shingles, component_id) for every row of `df`.

    component_id is the smallest key reachable by links, the row's own included. A null or
    empty text, or one without words, has no shingles and links with nothing; a text with
    one to four words is one shingle. Equal texts, and other texts with equal sets, are in
    one component; rows with a null key take part, their own component may be null.
    Repeated rows stay repeated. No rows give no rows. A key named like one of the other
    columns gets an underscore in front. Runs jobs; what they keep goes to the
    shared folder. Sets are named by 64-bit hashes of 64-bit shingle hashes.
    """
    rows, grouped = _classes(df, text, key)
    smallest = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = settle(grouped.join(smallest, "root").select("class", "component_id"))
    return rows.join(by_class, "class", "left").select(
        F.col("key").alias(beside(key, ["n_shingles", "component_id"])),
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("key")).alias("component_id"),
    )


def keep_one(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of `df` without near-duplicates: of each component one row stays, that with
    the smallest key (a null key only where all are null). Texts without words all stay. All
    columns are kept, whatever their names; an equal row that is repeated stays once.
    """
    rows, grouped = _classes(df, text, key)
    order = F.struct(F.col("least").isNull().alias("none"), F.col("least"), F.col("class"))
    first = grouped.groupBy("root").agg(F.min(order).alias("f"))
    kept = settle(first.select(F.col("f.class").alias("_class"), F.col("f.least").alias("_key")))
    name, again = free_name(df, "_class"), free_name(df, "_again")
    named = df.withColumn(name, text_class(F.col(text)))
    bare = named.filter(F.col(name) == 0)
    same = (F.col(f"d.{name}") == F.col("k._class")) & F.col(f"d.{key}").eqNullSafe(F.col("k._key"))
    chosen = named.filter(F.col(name) != 0).alias("d").join(kept.alias("k"), same, "left_semi")
    repeats = Window.partitionBy(name, key).orderBy(text)
    once = chosen.withColumn(again, F.row_number().over(repeats)).filter(F.col(again) == 1)
    return once.select(*df.columns).unionByName(bare.select(*df.columns))
