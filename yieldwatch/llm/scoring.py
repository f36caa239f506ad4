"""Log-probabilities of texts under a weighted backoff automaton learned from the corpus.

States are the root, every word of the training texts, and every two successive words that
occur there at least STATE_LEAST times. From the state of history h, every word w seen after
h has an arc with the smoothed probability (1 - f) c(h w) / c(h) + f p(w | h'), where h' is h
without its first word; other words take the failure arc, which has the weight f and leads
to h', and go on from there. Failure arcs so lead from two words to one and on to the root,
where p(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)). The weight f is that of Witten and Bell,
t / (c(h) + t), with t the number of different words expected among c(h) tokens of the corpus;
it follows from c(h) and a histogram of the words' counts. All arcs of a state sum to 1.

A text is read once from left to right and carries its state: the longest history of the
words read so far that is a state, at the start the closing token's. The weights of the arcs
that its tokens take add up, as logarithms.

Neither counts nor states are gathered in one place. Texts are written once, in blocks of
bounded bytes. A block sends the words and pairs it needs, with the times it has them itself in training
texts, to buckets, which add up the counts and send the sums back; then it does the same with the triples that
follow a state of two words. The table of blocks is bucketed by block, so no pass moves the texts.
Words, pairs and triples are 64-bit hashes, sent in order as differences.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yieldwatch.llm.columns import beside
from yieldwatch.llm.jaccard import small_batches
from yieldwatch.llm.words import END, mix, words_of
from yieldwatch.sources.scratch import scratch_path, settle

#: Times that two successive words occur in the training texts for them to be a state.
STATE_LEAST = 2
#: Bytes of text of a block, and about so many of all texts for each bucket of counts. A longer text is a block of its own.
BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20
LEAST_GROUPS = 64
MOST_FILES = 20_000  # that the table of blocks is dealt into
WORDS, PAIRS, HISTOGRAM, TRIPLES = range(4)
MADE = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]


@dataclass(frozen=True)
class Tokens:
    """Tokens of texts in a row; every text ends with END. begins: where each text starts.

    pairs: of each token with the one before it, END at the start. triples: of each token with the two before
    it, which the first token of a text has not.
    """

    hashes: np.ndarray
    begins: np.ndarray
    pairs: np.ndarray
    triples: np.ndarray

    @property
    def inner(self) -> np.ndarray:
        """False for the first token of a text."""
        out = np.ones(len(self.hashes), dtype=bool)
        out[self.begins] = False
        return out

    def per_text(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.begins) if len(self.begins) else np.zeros(0)

    def spread(self, values: np.ndarray) -> np.ndarray:
        """A value of each text, repeated for its tokens."""
        return np.repeat(values, np.diff(np.append(self.begins, len(self.hashes))))


def tokens_of(texts: pa.Array) -> Tokens:
    hashes, begins, count = [], [], 0
    for _, _, words in words_of(texts):
        sizes = words.counts + 1
        starts = np.cumsum(sizes) - sizes
        part = np.full(int(sizes.sum()), END, dtype=np.uint64)
        inside = np.ones(len(part), dtype=bool)
        inside[starts + sizes - 1] = False
        part[inside] = words.hashes
        hashes.append(part)
        begins.append(starts + count)
        count += len(part)
    every = np.concatenate(hashes)
    first = np.concatenate(begins)
    prev = np.roll(every, 1)
    prev[first] = END
    spread = mix(every)
    pairs = mix(prev * np.uint64(0x9E3779B97F4A7C15) + spread)
    triples = mix(np.roll(pairs, 1) * np.uint64(0xC2B2AE3D27D4EB4F) + spread)
    return Tokens(every, first, pairs, triples)


def _sum_by_key(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    by = np.argsort(keys, kind="stable")
    keys, counts = keys[by], counts[by]
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[begins], (np.add.reduceat(counts, begins) if len(begins) else counts)


def _dealt(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """For sorted keys: the buckets that occur and where each begins (and the end). A bucket
    is a range of hashes, so its keys stand together and lie near each other."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    begins = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    return bucket[begins].astype(np.int32), np.append(begins, len(keys))


def _packed(keys: np.ndarray) -> bytes:
    """Sorted keys as the first one and differences of as few bytes as the largest needs."""
    steps = np.diff(keys)
    width = max(1, (int(steps.max(initial=0)).bit_length() + 7) // 8)
    body = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + keys[:1].astype("<u8").tobytes() + body.tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    body = np.frombuffer(packed, dtype=np.uint8, offset=9).reshape(-1, packed[0])
    steps = np.zeros((len(body) + 1, 8), dtype=np.uint8)
    steps[0] = np.frombuffer(packed, dtype=np.uint8, count=8, offset=1)
    steps[1:, : packed[0]] = body
    return np.cumsum(steps.reshape(-1).view("<u8"), dtype=np.uint64)


def _narrow(counts: np.ndarray) -> bytes:
    """Counts as the narrowest unsigned integers that hold them."""
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0)))).tobytes()


def _widened(packed: bytes, count: int) -> np.ndarray:
    """`count` integers that _narrow has packed."""
    return np.frombuffer(packed, dtype=f"<u{len(packed) // count}").astype(np.int64)


def _asks(block: int, kind: int, keys: np.ndarray, own: np.ndarray, buckets: int) -> pa.Table:
    """A row for each bucket that has some of the sorted keys; own: the block's counts of them."""
    bucket, at = _dealt(keys, buckets)
    spans = list(zip(at[:-1].tolist(), at[1:].tolist()))
    return pa.table(
        {
            "bucket": pa.array(bucket, pa.int32()),
            "block": pa.array(np.full(len(bucket), block), pa.int64()),
            "kind": pa.array(np.full(len(bucket), kind), pa.int32()),
            "keys": pa.array([_packed(keys[a:b]) for a, b in spans], pa.binary()),
            "counts": pa.array([_narrow(own[a:b]) for a, b in spans], pa.binary()),
        }
    )


ASKS = "bucket int, block bigint, kind int, keys binary, counts binary"
ANSWERS = "block bigint, kind int, bucket int, counts binary"


def answer(asked: pa.Table) -> pa.Table:
    """The sums of what the blocks have of one bucket's keys, for each block in the order of
    its keys; and of the words, the histogram of their sums, as block -1."""
    out = []
    bucket = asked["bucket"][0].as_py()
    kinds = asked["kind"].to_numpy()
    for kind in np.unique(kinds).tolist():
        rows = asked.take(np.flatnonzero(kinds == kind))
        keys = [_unpacked(k) for k in rows["keys"].to_pylist()]
        own = [_widened(c, len(k)) for c, k in zip(rows["counts"].to_pylist(), keys)]
        known, sums = _sum_by_key(np.concatenate(keys), np.concatenate(own))
        for block, wanted in zip(rows["block"].to_pylist(), keys):
            out.append((block, kind, bucket, _narrow(sums[np.searchsorted(known, wanted)])))
        if kind == WORDS:
            values = sums[sums > 0]
            step = np.round(np.log2(values) * 16).astype(np.int64)
            number, total = np.bincount(step), np.bincount(step, weights=values).astype(np.int64)
            some = np.flatnonzero(number)
            out.append((-1, HISTOGRAM, bucket, np.stack([some, number[some], total[some]]).astype("<i8").tobytes()))
    columns = list(zip(*out))
    kinds_out = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds_out)], names=["block", "kind", "bucket", "counts"])


@dataclass(frozen=True)
class Automaton:
    """What all tasks know of the model: totals, and the histogram of the words' counts.

    means: the mean count of the words of each step; sizes: how many words it has.
    """

    tokens: int
    words: int
    means: np.ndarray
    sizes: np.ndarray

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.5) / (self.tokens + 0.5 * (self.words + 1))

    def failure_of(self, counts: np.ndarray) -> np.ndarray:
        """The failure weights of histories with these counts."""
        distinct, at = np.unique(counts, return_inverse=True)
        # Different words expected among c tokens drawn from the corpus.
        expected = np.zeros(len(distinct))
        for mean, size in zip(self.means, self.sizes):
            expected += size * -np.expm1(distinct * np.log1p(-min(mean / self.tokens, 1 - 1e-12)))
        return (expected / np.maximum(distinct + expected, 1e-12))[at]

    def traverse(self, tokens: Tokens, words: np.ndarray, pairs: np.ndarray, triples: np.ndarray) -> np.ndarray:
        """log10 of each token's weight, from the counts of the token, its pair and its triple.

        The state before a token has the two words before it, or the one, or none.
        """
        one, two = histories(tokens, words, pairs)
        state = np.where(two >= STATE_LEAST, 2, np.where(one > 0, 1, 0))
        weight = self.unigram(words)
        for order, history, seen in ((1, one, pairs), (2, two, triples)):
            failure = self.failure_of(history)
            arc = (1 - failure) * seen / np.maximum(history, 1) + failure * weight
            weight = np.where(state >= order, arc, weight)
        return np.log10(weight)


def histories(tokens: Tokens, words: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Before each token: the counts of the word before it and of the two words before it.

    A word that was never learned is no history; nor are two words where the second was not.
    """
    one, two = np.roll(words, 1), np.roll(pairs, 1)
    # A text starts in the state of the closing token, which ends every text.
    closing = np.flatnonzero(tokens.hashes == END)[:1]
    one[tokens.begins] = words[closing]
    two[tokens.begins] = 0
    return one, two


def fit(answers: DataFrame) -> Automaton:
    """The model of the stored answers. Runs a job; a histogram of counts reaches the driver."""

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                rows = np.frombuffer(packed, dtype="<i8").reshape(3, -1)
                yield pa.RecordBatch.from_arrays([pa.array(r) for r in rows], names=["step", "words", "tokens"])

    found = answers.filter(F.col("kind") == HISTOGRAM).select("counts").mapInArrow(steps, "step bigint, words bigint, tokens bigint")
    spectrum = found.groupBy("step").agg(F.sum("words").alias("words"), F.sum("tokens").alias("tokens")).orderBy("step").collect()
    sizes = np.array([r["words"] for r in spectrum], dtype=np.int64)
    totals = np.array([r["tokens"] for r in spectrum], dtype=np.int64)
    return Automaton(int(totals.sum()), int(sizes.sum()), totals / np.maximum(sizes, 1), sizes)


def write_blocks(rows: DataFrame, buckets: int) -> DataFrame:
    """`rows` (which end with text, train) with a `block`, as a table bucketed by block.

    A block is successive rows of one task, of BLOCK_BYTES of text or one longer text; rows do not move.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
            numbers = []
            for size in sizes:
                if held and held + size > BLOCK_BYTES:
                    block, held = block + 1, 0
                held += size + 1
                numbers.append(block)
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), *batch.columns], names=["block", *batch.schema.names])

    schema = T.StructType([T.StructField("block", T.LongType()), *rows.schema.fields])
    path = scratch_path(rows.sparkSession, "blocks")
    name = "blocks_" + path[-32:]
    dealt = rows.mapInArrow(deal, schema)
    dealt.write.bucketBy(buckets, "block").option("compression", "zstd").option("path", path).saveAsTable(name)
    return rows.sparkSession.table(name)


def score_texts(df: DataFrame, train: Column, text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(keys, n_tokens, n_known, train_tokens, base_score, score) for every row of `df`.

    The model learns from the rows for which `train` holds (null: not). A null text is
    empty and has the closing token alone; repeated rows count as often as they occur.
    Without training rows every token has the same small weight. No rows give no rows. A key
    named like another column of the result gets an underscore in front. Runs jobs; the closing result is computed when it is asked for.
    """
    spark = df.sparkSession
    names = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)],
        F.col(text).alias("text"),
        F.coalesce(train, F.lit(False)).alias("train"),
    )
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(LEAST_GROUPS, -(-total // BUCKET_BYTES))
    with small_batches(spark):
        blocks = write_blocks(rows, min(max(LEAST_GROUPS, -(-total // BLOCK_BYTES)), MOST_FILES))

    def looked_up(keys_: np.ndarray, answers: pa.Table, kind: int) -> np.ndarray:
        """The answered counts of the block's sorted keys of one kind."""
        own = answers.filter(pc.equal(answers["kind"], kind)).sort_by("bucket")
        sizes = np.diff(_dealt(keys_, buckets)[1]).tolist()
        found = [_widened(packed, n) for packed, n in zip(own["counts"].to_pylist(), sizes, strict=True)]
        return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)

    def read(table: pa.Table, answers: pa.Table) -> tuple[Tokens, np.ndarray, np.ndarray, np.ndarray]:
        """The tokens of a block, the counts of each token and its pair, and which tokens have a
        triple that may have been learned: a state of two words before them, and a known pair."""
        tokens = tokens_of(table["text"].combine_chunks())
        counts = []
        for values, kind in ((tokens.hashes, WORDS), (tokens.pairs, PAIRS)):
            distinct, at = np.unique(values, return_inverse=True)
            counts.append(looked_up(distinct, answers, kind)[at])
        _, two = histories(tokens, *counts)
        return tokens, *counts, (two >= STATE_LEAST) & (counts[1] > 0)

    def ask(table: pa.Table) -> pa.Table:
        tokens = tokens_of(table["text"].combine_chunks())
        return pa.concat_tables([own_counts(table, tokens, v, k) for v, k in ((tokens.hashes, WORDS), (tokens.pairs, PAIRS))])

    def ask_triples(table: pa.Table, answers: pa.Table) -> pa.Table:
        tokens, _, _, some = read(table, answers)
        return own_counts(table, tokens, tokens.triples, TRIPLES, some)

    def own_counts(table: pa.Table, tokens: Tokens, values: np.ndarray, kind: int, some=slice(None)) -> pa.Table:
        learned = tokens.spread(table["train"].combine_chunks().to_numpy(zero_copy_only=False))
        distinct, at = np.unique(values[some], return_inverse=True)
        own = np.bincount(at, weights=learned[some], minlength=len(distinct)).astype(np.int64)
        return _asks(table["block"][0].as_py(), kind, distinct, own, buckets)

    def score(table: pa.Table, answers: pa.Table) -> pa.Table:
        model = shared.value
        tokens, words, pairs, some = read(table, answers)
        triples = np.zeros(len(words), dtype=np.int64)
        distinct, at = np.unique(tokens.triples[some], return_inverse=True)
        triples[some] = looked_up(distinct, answers, TRIPLES)[at]
        steps = model.traverse(tokens, words, pairs, triples)
        columns = {n: table[n] for n in names}
        columns["n_tokens"] = pa.array(np.diff(np.append(tokens.begins, len(tokens.hashes))))
        columns["n_known"] = pa.array(tokens.per_text((words > 0).astype(np.int64)))
        columns["train_tokens"] = pa.array(np.full(table.num_rows, model.tokens))
        columns["base_score"] = pa.array(tokens.per_text(np.log10(model.unigram(words))))
        columns["score"] = pa.array(tokens.per_text(steps))
        return pa.table(columns)

    asked = blocks.groupBy("block").applyInArrow(ask, ASKS)
    answers = settle(asked.groupBy("bucket").applyInArrow(answer, ANSWERS))
    shared = spark.sparkContext.broadcast(fit(answers))
    first = answers.filter("block >= 0")
    triples = blocks.groupBy("block").cogroup(first.groupBy("block")).applyInArrow(ask_triples, ASKS)
    second = triples.groupBy("bucket").applyInArrow(answer, ANSWERS)
    schema = T.StructType([T.StructField(n, rows.schema[n].dataType) for n in names])
    for name in MADE:
        schema.add(name, T.DoubleType() if name.endswith("score") else T.LongType())
    every = first.unionByName(second).groupBy("block")
    scored = blocks.groupBy("block").cogroup(every).applyInArrow(score, schema)
    return scored.select(*[F.col(n).alias(beside(k, MADE)) for n, k in zip(names, keys)], *MADE)
