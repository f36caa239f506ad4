"""Passages of a benchmark in training texts, found with spaced seeds.

A seed is a fixed mask over successive words that looks at some positions and ignores
the others, so a changed word spoils only the seeds that look at it. The hashes of all
seeds of the benchmark are joined with those of the texts; a hit places an item against a
text, and there the words are compared one by one: a match counts 1, a changed word
costs PENALTY, and the best stretch must reach the needed score.

No stretch that reaches it is without a hit. Of items with SPACED_FROM words or more, every
row of matches and changes that avoids all MASKS stays below the needed score (shown over
all such rows, of any length, in the tests). A shorter item cannot afford a changed word,
as n - 1 - PENALTY < SHARE * n, so its seeds are runs of as many words as it needs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from yieldwatch.llm import bloom
from yieldwatch.llm.columns import beside, computed_once, free_name
from yieldwatch.llm.jaccard import small_batches
from yieldwatch.llm.words import Words, mix, power, words_of
from yieldwatch.sources.scratch import settle

# 1 marks a position that counts. Each mask looks at five words.
MASKS = ["110010101", "111001001", "11010100001", "11000010011", "11110001"]
#: Items with fewer words are looked up by runs of words.
SPACED_FROM = 10
#: An item with fewer words is too short to say anything and matches nothing.
SHORTEST = 5
PENALTY = 1.5
NEEDED = 10.0
#: The needed score of an item is at most this share of its words.
SHARE = 0.75


def run_of(count: int) -> int:
    """The words in a row that an item with `count` words, fewer than SPACED_FROM, needs."""
    return math.ceil(SHARE * count)


def masks_for(short_lengths: list[int]) -> list[np.ndarray]:
    """The positions of all masks, and of the runs for items of these lengths below SPACED_FROM."""
    spaced = [np.flatnonzero([c == "1" for c in m]) for m in MASKS]
    return spaced + [np.arange(n) for n in sorted({run_of(n) for n in short_lengths})]


def seeds_of(words: Words, masks: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes, first words) of each mask at every place where its span fits inside a text."""
    end = np.repeat(words.offsets[1:], words.counts)
    at = np.arange(len(words.hashes))
    for mask in masks:
        places = at[at + int(mask[-1]) < end]
        powers = power(len(mask) + 1)
        name = sum(1 << int(offset) for offset in mask)
        total = np.full(len(places), np.uint64(name * 0x2545F4914F6CDD1D % 2**64))
        for k, offset in enumerate(mask):
            total += words.hashes[places + offset] * powers[k + 1]
        yield mix(total), places


def text_names(words: Words) -> np.ndarray:
    """A 64-bit name for the words of each text in their order; 0 for a text without words."""
    counts = words.counts
    if not len(words.hashes):
        return np.zeros(len(counts), dtype=np.int64)
    place = np.arange(len(words.hashes)) - np.repeat(words.offsets[:-1], counts)
    values = mix(words.hashes + (place.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9FB21C651E98DF25))
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(values)])
    sums = total[words.offsets[1:]] - total[words.offsets[:-1]]
    return np.where(counts > 0, mix(sums + counts.astype(np.uint64)), np.uint64(0)).view(np.int64)


def item_table(benchmark: DataFrame, text: str, key: str) -> DataFrame:
    """Stored (item, item_key, tokens), one row for each different item long enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, words in words_of(batch.column(1)):
                names = text_names(words)
                long = np.flatnonzero(words.counts >= SHORTEST)
                tokens = [words.hashes[words.offsets[i] : words.offsets[i + 1]].tobytes() for i in long]
                keys = batch.column(0).slice(first, last - first).take(pa.array(long))
                yield pa.RecordBatch.from_arrays([pa.array(names[long]), keys, pa.array(tokens, pa.binary())], names=["item", "item_key", "tokens"])

    kind = benchmark.schema[key].dataType.simpleString()
    rows = benchmark.select(key, text).mapInArrow(run, f"item bigint, item_key {kind}, tokens binary")
    return settle(rows.groupBy("item").agg(F.min("item_key").alias("item_key"), F.first("tokens").alias("tokens")))


def _words_of_tokens(tokens: list[bytes]) -> Words:
    rows = [np.frombuffer(t, dtype=np.uint64) for t in tokens]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    none = np.zeros(0, dtype=np.int64)
    return Words(np.concatenate(rows) if rows else np.zeros(0, dtype=np.uint64), offsets, none, none)


def seed_table(items: DataFrame, masks: list[np.ndarray]) -> DataFrame:
    """Stored (hash, item, item_at) of all seeds of the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = _words_of_tokens(batch.column(1).to_pylist())
            item = batch.column(0).to_numpy()
            owner = words.text_of_word()
            needs = np.array([run_of(n) if n < SPACED_FROM else 0 for n in words.counts.tolist()], dtype=np.int64)
            for number, (hashes, places) in enumerate(seeds_of(words, masks)):
                own = needs[owner[places]] == (len(masks[number]) if number >= len(MASKS) else 0)
                hashes, places = hashes[own], places[own]
                at = (places - words.offsets[owner[places]]).astype(np.int32)
                columns = [pa.array(hashes.view(np.int64)), pa.array(item[owner[places]]), pa.array(at)]
                yield pa.RecordBatch.from_arrays(columns, names=["hash", "item", "item_at"])

    found = items.select("item", "tokens").mapInArrow(run, "hash bigint, item bigint, item_at int")
    return settle(found.distinct())


def scan(df: DataFrame, text: str, key: str, masks: list[np.ndarray], bits) -> DataFrame:
    """Stored rows (key, name) of all texts, and (name, tokens, hashes, places) of texts with hits.

    Equal texts have one name; their hits are kept once for each task.
    """
    kind = df.schema[key].dataType
    key_type = to_arrow_type(kind)
    names_out = ["key", "name", "tokens", "hashes", "places"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for first, last, words in words_of(batch.column(1)):
                names = text_names(words)
                count = last - first
                none = pa.nulls(count, pa.binary())
                keys = batch.column(0).slice(first, count)
                yield pa.RecordBatch.from_arrays([keys, pa.array(names), none, none, none], names=names_out)
                found_hashes, found_places = [], []
                for hashes, places in seeds_of(words, masks):
                    hit = bloom.contains(bits.value, hashes)
                    found_hashes.append(hashes[hit])
                    found_places.append(places[hit])
                hashes, places = np.concatenate(found_hashes), np.concatenate(found_places)
                if not len(hashes):
                    continue
                owner = np.searchsorted(words.offsets, places, side="right") - 1
                by = np.argsort(owner, kind="stable")
                hashes, places, owner = hashes[by], places[by], owner[by]
                rows = []
                for group in np.split(np.arange(len(by)), np.flatnonzero(np.diff(owner)) + 1):
                    t = int(owner[group[0]])
                    if int(names[t]) in seen:
                        continue
                    seen.add(int(names[t]))
                    begin = words.offsets[t]
                    tokens = words.hashes[begin : words.offsets[t + 1]].tobytes()
                    rows.append((int(names[t]), tokens, hashes[group].tobytes(), (places[group] - begin).astype("<i4").tobytes()))
                if rows:
                    name, tokens, hit_hashes, hit_places = zip(*rows)
                    columns = [pa.nulls(len(rows), key_type), pa.array(name, pa.int64())]
                    columns += [pa.array(x, pa.binary()) for x in (tokens, hit_hashes, hit_places)]
                    yield pa.RecordBatch.from_arrays(columns, names=names_out)

    schema = f"key {kind.simpleString()}, name bigint, tokens binary, hashes binary, places binary"
    return settle(df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema))


def _hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, hashes, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            rows = np.frombuffer(hashes, dtype=np.int64)
            columns = [pa.array(np.full(len(rows), name)), pa.array(rows), pa.array(np.frombuffer(places, dtype="<i4"))]
            yield pa.RecordBatch.from_arrays(columns, names=["name", "hash", "place"])


def overlap(text: np.ndarray, item: np.ndarray, shift: int) -> tuple[float, int, int, int]:
    """(score, matched, first, last) of the best stretch with the item laid at text[shift]."""
    low, high = max(0, -shift), min(len(item), len(text) - shift)
    if high <= low:
        return 0.0, 0, 0, 0
    same = text[low + shift : high + shift] == item[low:high]
    total = np.concatenate([[0.0], np.cumsum(np.where(same, 1.0, -PENALTY))])
    least = np.minimum.accumulate(total)
    end = int(np.argmax(total - least))
    begin = int(np.argmin(total[: end + 1]))
    return float(total[end] - total[begin]), int(same[begin:end].sum()), begin + low + shift, end + low + shift


def _verify(text: pa.Array, item: pa.Array, shift: pa.Array) -> pa.Array:
    rows = []
    for t, i, s in zip(text, item, shift.to_pylist()):
        words = np.frombuffer(i.as_buffer(), dtype=np.uint64)
        found = overlap(np.frombuffer(t.as_buffer(), dtype=np.uint64), words, s)
        rows.append((*found, found[0] >= min(NEEDED, SHARE * len(words))))
    score, matched, first, last, bad = zip(*rows) if rows else ([], [], [], [], [])
    return pa.StructArray.from_arrays(
        [pa.array(score, pa.float64()), pa.array(matched, pa.int32()), pa.array(first, pa.int32()), pa.array(last, pa.int32()), pa.array(bad, pa.bool_())],
        names=["score", "matched", "first", "last", "contaminated"],
    )


def _verdicts(df: DataFrame, benchmark: DataFrame, text: str, key: str, item_text: str, item_key: str) -> tuple[DataFrame, DataFrame]:
    """The stored scan, and a stored (name, best) of the contaminated texts."""
    spark = df.sparkSession
    with small_batches(spark):
        items = item_table(benchmark, item_text, item_key)
        lengths = items.select((F.octet_length("tokens") / 8).cast("int").alias("n")).filter(F.col("n") < SPACED_FROM).distinct()
        masks = masks_for(sorted(row["n"] for row in lengths.collect()))  # fewer than SPACED_FROM rows
        seeds = seed_table(items, masks)
        bits = spark.sparkContext.broadcast(bloom.build(seeds, "hash"))
        scanned = scan(df, text, key, masks, bits)
        hit = scanned.filter(F.col("tokens").isNotNull()).dropDuplicates(["name"])
        texts = settle(hit.select("name", "tokens", "hashes", "places"))
        hits = texts.select("name", "hashes", "places").mapInArrow(_hits, "name bigint, hash bigint, place int")
        laid = hits.join(seeds, "hash").select("name", "item", (F.col("place") - F.col("item_at")).alias("shift")).distinct()
        pairs = settle(laid).join(texts.select("name", "tokens"), "name")
        pairs = pairs.join(items.select("item", "item_key", F.col("tokens").alias("item_tokens")), "item")
        verify = computed_once(_verify, "struct<score:double,matched:int,first:int,last:int,contaminated:boolean>")
        checked = pairs.select("name", "item_key", verify("tokens", "item_tokens", "shift").alias("r"))
        checked = checked.filter("r.contaminated")
        best = F.struct("r.score", F.col("item_key"), "r.matched", "r.first", "r.last")
        # The best score; of equal ones the smallest key.
        order = F.struct((-F.col("r.score")).alias("s"), F.col("item_key"), F.col("r.first"))
        return scanned, settle(checked.groupBy("name").agg(F.min_by(best, order).alias("best")))


def find_overlaps(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    item_text: str = "text",
    item_key: str = "item_id",
) -> DataFrame:
    """(key, contaminated, item, score, matched, first_word, last_word) for every row of `df`.

    The item with the best score stands for all (ties: the smaller key); nulls where there is
    no overlap of the needed score. Null and empty texts, and items of fewer than SHORTEST
    words, overlap with nothing. Items and texts may be repeated. A key named like another
    column of the result gets an underscore in front. Runs jobs.
    """
    scanned, verdicts = _verdicts(df, benchmark, text, key, item_text, item_key)
    rows = scanned.filter(F.col("tokens").isNull()).select("key", "name")
    made = ["contaminated", "score", "matched", "first_word", "last_word"]
    own = beside(key, made)
    return rows.join(verdicts, "name", "left").select(
        F.col("key").alias(own),
        F.col("best").isNotNull().alias("contaminated"),
        F.col("best.item_key").alias(beside(item_key, [*made, own])),
        F.col("best.score").alias("score"),
        F.col("best.matched").alias("matched"),
        F.col("best.first").alias("first_word"),
        F.col("best.last").alias("last_word"),
    )


def text_name(text: str | Column) -> Column:
    """Equal for texts with the same words in the same order; 0 without words."""

    def run(texts: pa.Array) -> pa.Array:
        names = [text_names(words) for _, _, words in words_of(texts)]
        return pa.array(np.concatenate(names + [np.zeros(0, dtype=np.int64)]), pa.int64())

    return computed_once(run, "bigint")(text)


def drop_contaminated(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    item_text: str = "text",
    item_key: str = "item_id",
) -> DataFrame:
    """The rows of `df` whose text overlaps with no item, with all their columns."""
    _, verdicts = _verdicts(df, benchmark, text, key, item_text, item_key)
    name = free_name(df, "_name")
    bad = verdicts.select(F.col("name").alias(name))
    return df.withColumn(name, text_name(F.col(text))).join(bad, name, "left_anti").select(*df.columns)
