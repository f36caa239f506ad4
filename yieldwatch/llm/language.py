"""Language of texts: nearest of several centroids per language, by cosine.

A text is a vector of hashed byte pairs and triples (lower-cased, other ASCII signs as
blanks), weighted by how few texts have them. The weights come from all training texts;
the centroids are clusters of a bounded sample of them. A text far from every centroid of
its language, compared with that sample, is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldwatch.llm.columns import free_name, without
from yieldwatch.llm.words import parts, text_buffer
from yieldwatch.operators.select import kth_smallest
from yieldwatch.sources.scratch import settle

DIMENSIONS = 4096
#: Bound of the sample that the clusters of one language are fitted to.
SAMPLE = 400
CLUSTERS = 4
#: Languages of one model, for the size of what all tasks are given.
MOST_LANGUAGES = 1_000
STEPS = 12
#: A text is rejected below the sample's mean cosine less this many deviations.
DEVIATIONS = 4.0
UNKNOWN = "und"
TEXTS_AT_ONCE = 256

_FOLD = np.full(256, 32, dtype=np.uint8)
_FOLD[128:] = np.arange(128, 256)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def _place(keys: np.ndarray) -> np.ndarray:
    spread = (keys.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return (spread >> np.uint64(64 - 12)).astype(np.int64)


_TRIPLES: np.ndarray | None = None


def _triple_places() -> np.ndarray:
    """The dimension of every byte triple; pairs are looked up with a zero byte in front. Filled
    bit by bit, which needs little memory."""
    global _TRIPLES
    if _TRIPLES is None:
        _TRIPLES = np.empty(1 << 24, dtype=np.uint16)
        for low in range(0, 1 << 24, 1 << 18):
            _TRIPLES[low : low + (1 << 18)] = _place(np.arange(low, low + (1 << 18)))
    return _TRIPLES


def gram_counts(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first, last, counts): for ranges of texts, a row of DIMENSIONS counts for each."""
    data, offsets = text_buffer(texts)
    places = _triple_places()
    for low, high in parts(offsets, 1 << 20):
        for first in range(low, high, TEXTS_AT_ONCE):
            last = min(first + TEXTS_AT_ONCE, high)
            count = last - first
            size = np.diff(offsets[first : last + 1])
            # A blank before and after each text, so that pairs and triples never span two.
            text = np.repeat(np.arange(count), size)
            padded = np.full(int(size.sum()) + 2 * count, 32, dtype=np.int32)
            padded[np.arange(len(text)) + 1 + 2 * text] = _FOLD[data[offsets[first] : offsets[last]]]
            owner = np.repeat(np.arange(count), size + 2)
            pairs = (padded[:-1] << 8) | padded[1:]
            triples = (pairs[:-1] << 8) | padded[2:]
            out = np.zeros(count * DIMENSIONS)
            for keys, reach in ((pairs, 1), (triples, 2)):
                inside = owner[:-reach] == owner[reach:]
                if reach == 1:
                    inside &= keys != 0x2020
                else:
                    inside &= (keys & 0xFFFF) != 0x2020
                cells = owner[:-reach][inside] * DIMENSIONS + places[keys[inside]]
                out += np.bincount(cells, minlength=count * DIMENSIONS)
            yield first, last, out.reshape(count, DIMENSIONS)


def vectors(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Rows of length 1, or zeros."""
    out = np.log1p(counts) * weights
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1)


def text_weights(texts: DataFrame, text: str = "text") -> np.ndarray:
    """Inverse document frequency of each dimension over all rows. One job; DIMENSIONS rows reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(DIMENSIONS, dtype=np.int64), 0
        for batch in batches:
            for first, last, counts in gram_counts(batch.column(0)):
                seen += (counts > 0).sum(axis=0)
                rows += last - first
        places = np.arange(DIMENSIONS + 1, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(np.append(seen, rows))], names=["place", "texts"])

    summed = texts.select(text).mapInArrow(count, "place int, texts bigint").groupBy("place").agg(F.sum("texts").alias("texts"))
    seen = np.zeros(DIMENSIONS + 1)
    for row in summed.collect():
        seen[row["place"]] = row["texts"]
    return np.log((1 + seen[-1]) / (1 + seen[:-1])) + 1


def cluster(rows: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of length 1 and the cosine below which a text is rejected, for each cluster.

    The first centroid is the mean, each next one starts at the row farthest from all.
    """
    mean = rows.mean(axis=0)
    centres = [mean / max(np.linalg.norm(mean), 1e-12)]
    while len(centres) < min(count, len(rows)):
        nearest = (rows @ np.array(centres).T).max(axis=1)
        centres.append(rows[int(nearest.argmin())])
    found = np.array(centres)
    for _ in range(STEPS):
        chosen = (rows @ found.T).argmax(axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, chosen, rows)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        found = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), found)
    cosines = rows @ found.T
    chosen, best = cosines.argmax(axis=1), cosines.max(axis=1)
    floors = np.zeros(len(found))
    for c in range(len(found)):
        own = best[chosen == c]
        floors[c] = own.mean() - DEVIATIONS * own.std() if len(own) else 0
    return found, floors


class Centroids:
    """Languages, their centroids, and the weights of the dimensions."""

    def __init__(self, languages: list[str], centres: np.ndarray, floors: np.ndarray, weights: np.ndarray) -> None:
        self.languages, self.centres, self.floors, self.weights = languages, centres, floors, weights

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        names: list[str] = []
        scores, rejected = np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
        for first, last, counts in gram_counts(texts):
            if not self.languages:
                names.extend([UNKNOWN] * (last - first))
                continue
            cosines = vectors(counts, self.weights) @ self.centres.T
            best = cosines.argmax(axis=1)
            names.extend(self.languages[b] for b in best)
            scores[first:last] = np.clip(cosines[np.arange(last - first), best], 0, 1)
            rejected[first:last] = scores[first:last] < self.floors[best]
        return names, scores, rejected


def fit(texts: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = SAMPLE) -> Centroids:
    """Learn from the rows with a text and a language. The weights count all of them; the
    clusters use, for each language, the `sample` distinct rows whose key and text have the
    lowest hashes, whatever the partitions. Runs jobs; CLUSTERS vectors per language reach the
    driver, 128 KB, and more than MOST_LANGUAGES values of the language are an error."""
    known = texts.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    known = known.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    weights = text_weights(known)
    # A row is known by its id and text; equal rows are one, so repeated or null ids count
    # for no more than the sample's bound.
    row = F.concat(*[F.lpad(F.hex(F.xxhash64(c)), 16, "0") for c in ("key", "text")]).alias("row")
    distinct = settle(known.select("lang", row).distinct())
    sizes = distinct.groupBy("lang").agg(F.least(F.count("*"), F.lit(sample)).alias("k"))
    # The cut is found by counting, so no language's rows are ranked in one task.
    cuts = settle(kth_smallest(distinct, ["lang"], "row", 32, sizes).select("lang", "cut"))
    if cuts.count() > MOST_LANGUAGES:
        raise ValueError(f"{lang} has more than {MOST_LANGUAGES} values; it does not name languages")
    drawn = settle(distinct.join(cuts, "lang").filter(F.col("row") <= F.col("cut")).select("lang", "row"))
    texts_drawn = known.select("lang", "text", row).join(drawn, ["lang", "row"])
    # One of equal rows: at most `sample` rows of a language go on.
    rows = texts_drawn.groupBy("lang", "row").agg(F.min("text").alias("text"))

    def centres(batches: pa.Table) -> pa.Table:
        batches = batches.sort_by("row")
        data = np.vstack([vectors(c, weights) for _, _, c in gram_counts(batches["text"].combine_chunks())])
        found, floors = cluster(data, CLUSTERS)
        names = [batches["lang"][0].as_py()] * len(found)
        return pa.table({"lang": names, "centre": pa.array(found.tolist(), pa.list_(pa.float64())), "floor": floors})

    fitted = rows.groupBy("lang").applyInArrow(centres, "lang string, centre array<double>, floor double")
    learned = sorted(fitted.collect(), key=lambda r: (r["lang"], r["centre"]))
    matrix = np.array([r["centre"] for r in learned]).reshape(len(learned), DIMENSIONS)
    return Centroids([r["lang"] for r in learned], matrix, np.array([r["floor"] for r in learned]), weights)


def predict(df: DataFrame, model: Centroids, text: str = "text") -> DataFrame:
    """`df` with lang_pred, score (cosine, 0 to 1) and rejected; columns of these names are replaced.

    A null text, or one without a letter, is `und` with score 0; so is every text if nothing
    was learned. Of equally near languages the first by name is taken.
    """

    shared = df.sparkSession.sparkContext.broadcast(model)  # CLUSTERS vectors per language

    @F.arrow_udf("struct<lang:string,score:double,rejected:boolean>")
    def run(texts: pa.Array) -> pa.Array:
        names, scores, rejected = shared.value.predict(texts)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores), pa.array(rejected)], names=["lang", "score", "rejected"])

    has_letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    found, letter = free_name(df, "_found"), free_name(df, "_letter")
    named = df.withColumns({found: run(F.col(text)), letter: has_letter})
    return named.select(
        *without(df, ["lang_pred", "score", "rejected"]),
        F.when(F.col(letter), F.col(found)["lang"]).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col(letter), F.col(found)["score"]).otherwise(0.0).alias("score"),
        F.when(F.col(letter), F.col(found)["rejected"]).otherwise(True).alias("rejected"),
    )
