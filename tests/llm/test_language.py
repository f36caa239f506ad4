"""The language model against a plain recomputation: grams, weights, sample, nearest centroid."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from yieldwatch.llm import language, queries

random.seed(21)
PARTS = {"de": ["sch", "ung", "ein", "ü"], "en": ["th", "ing", "er", "wh"], "fr": ["é", "que", "eau", "oi"]}


def sentence(lang, words):
    return " ".join("".join(random.choices(PARTS[lang], k=random.randint(1, 4))) for _ in range(words))


def fold(text):
    """Lower-case ASCII letters and bytes beyond ASCII stay; all else is blank."""
    return [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in (text or "").encode()]


def place(key):
    return (((key + 1) * 0x9E3779B97F4A7C15) % 2**64) >> 52


def plain_counts(text):
    padded = [32, *fold(text), 32]
    counts = Counter()
    for a, b in zip(padded, padded[1:]):
        if (a, b) != (32, 32):
            counts[place(a << 8 | b)] += 1
    for a, b, c in zip(padded, padded[1:], padded[2:]):
        if (b, c) != (32, 32):
            counts[place(a << 16 | b << 8 | c)] += 1
    return counts


def corpus(n=150):
    return [(i, sentence(lang, random.randint(4, 30)), lang) for i, lang in enumerate(random.choices(list(PARTS), k=n))]


SCHEMA = "doc_id bigint, text string, lang string"


def test_weights_and_nearest_centroid_equal_a_plain_search(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    model = language.fit(df)
    seen = Counter(p for _, text, _ in rows for p in plain_counts(text))
    for p in range(language.DIMENSIONS):
        assert model.weights[p] == pytest.approx(math.log((1 + len(rows)) / (1 + seen[p])) + 1)

    texts = [text for _, text, _ in rows[:20]] + [sentence("fr", 200), "Ü", "é 1 é", "x"]
    found = {r["doc_id"]: r for r in language.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), model).collect()}
    for i, text in enumerate(texts):
        vector = {p: math.log1p(c) * model.weights[p] for p, c in plain_counts(text).items()}
        length = math.sqrt(sum(v * v for v in vector.values()))
        cosines = [sum(v * centre[p] for p, v in vector.items()) / length for centre in model.centres]
        best = max(range(len(cosines)), key=lambda c: (cosines[c], -c))
        assert found[i]["score"] == pytest.approx(min(max(cosines[best], 0), 1), abs=1e-9)
        near = {model.languages[c] for c, v in enumerate(cosines) if v > cosines[best] - 1e-9}
        assert found[i]["lang_pred"] in near and found[i]["rejected"] == (found[i]["score"] < model.floors[best])


def test_each_text_is_in_the_cluster_of_its_nearest_centroid():
    """The centroids are what the last step of Lloyd's rounds leaves: means of their own rows."""
    rng = np.random.default_rng(2)
    rows = np.abs(rng.normal(size=(90, 12))) + np.repeat(np.eye(3, 12) * 6, 30, axis=0)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    centres, floors = language.cluster(rows, 3)
    nearest = (rows @ centres.T).argmax(axis=1)
    for c in range(3):
        mean = rows[nearest == c].sum(axis=0)
        np.testing.assert_allclose(centres[c], mean / np.linalg.norm(mean), atol=1e-9)
        own = (rows @ centres.T).max(axis=1)[nearest == c]
        assert floors[c] == pytest.approx(own.mean() - language.DEVIATIONS * own.std())


def test_sample_is_bounded_and_the_same_at_any_partitioning(spark, monkeypatch):
    rows = [(None, sentence("de", 6), "de") for _ in range(3000)] + [(7, sentence("en", 6), "en") for _ in range(900)]
    rows += [(8, "same text", "fr")] * 800
    df = spark.createDataFrame(rows, SCHEMA)
    one, other = (language.fit(df.repartition(n), sample=40) for n in (2, 9))
    np.testing.assert_array_equal(one.centres, other.centres)
    np.testing.assert_array_equal(one.floors, other.floors)
    assert one.languages == other.languages and one.languages.count("fr") == 1
    # The centroids of 40 rows of the null ids: those with the lowest hashes.
    prints = df.filter("lang = 'de'").select("text", F.lpad(F.hex(F.xxhash64("text")), 16, "0").alias("h")).distinct().orderBy("h").limit(40).collect()
    data = np.vstack([language.vectors(c, one.weights) for _, _, c in language.gram_counts(__import__("pyarrow").array([r["text"] for r in prints]))])
    want, _ = language.cluster(data, language.CLUSTERS)
    got = one.centres[[i for i, name in enumerate(one.languages) if name == "de"]]
    np.testing.assert_allclose(np.sort(got, axis=0), np.sort(want, axis=0), atol=1e-12)


def test_too_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGUAGES", 2)
    with pytest.raises(ValueError, match="does not name languages"):
        language.fit(spark.createDataFrame(corpus(30), SCHEMA))


def test_query_columns(spark, tmp_path):
    import zlib

    rows = corpus(60) + [(900, None, "de"), (901, "12 34", "de"), (None, "thing where", None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.QUERIES["op2_centroid_language"](spark, str(tmp_path)).collect()
    assert len(found) == 63
    for r in found:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["lang_pred"] in {*PARTS, "und"}
    named = {r["doc_id"]: r["lang_pred"] for r in found}
    assert named[900] == named[901] == "und"
    truth = {i: lang for i, _, lang in rows[:60]}
    assert np.mean([named[i] == truth[i] for i in truth]) > 0.95


def test_ties_take_the_first_language_by_name(spark):
    df = spark.createDataFrame([(1, "thing", "b"), (2, "thing", "a")], SCHEMA)
    model = language.fit(df)
    assert language.predict(df, model).select("lang_pred").distinct().collect()[0][0] == "a"
