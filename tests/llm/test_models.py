import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from yieldwatch.llm import language, quality

random.seed(14)
ALPHABETS = {"aa": ["th", "ing", "er", "on", "an", "re"], "bb": ["sch", "ung", "ein", "ü", "ich", "tz"], "cc": ["ção", "que", "os", "ar", "ê", "lh"]}


def sentence(lang, words):
    return " ".join("".join(random.choices(ALPHABETS[lang], k=random.randint(1, 4))) for _ in range(words))


def test_languages_are_told_apart(spark):
    rows = [(i, sentence(lang, random.randint(5, 60)), lang) for i, lang in enumerate(random.choices(list(ALPHABETS), k=240))]
    df = spark.createDataFrame(rows + [(900, "x", None), (901, None, "aa"), (5, rows[5][1], rows[5][2])], "doc_id int, text string, lang string")
    model = language.fit(df.filter("doc_id % 3 <> 1"))
    assert set(model.languages) == set(ALPHABETS)
    odd = [(1000, None), (1001, ""), (1002, "12 34 !"), (1003, "漢字かな交じり文"), (1004, "é"), (1005, sentence("bb", 40_000))]
    test = df.filter("doc_id % 3 = 1").select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id int, text string"))
    out = {r["doc_id"]: r for r in language.predict(test.withColumns({"score": F.lit("old"), "_found": F.lit(1)}), model).collect()}
    truth = {i: lang for i, _, lang in rows if i % 3 == 1}
    assert np.mean([out[i]["lang_pred"] == lang for i, lang in truth.items()]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["_found"] == 1 for r in out.values())
    assert [out[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3
    assert out[1003]["lang_pred"] in ALPHABETS and out[1003]["rejected"] and out[1005]["lang_pred"] == "bb"


def test_language_without_training_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "abc", None)], "doc_id int, text string, lang string")
    model = language.fit(df)
    assert language.predict(df, model).first()["lang_pred"] == "und"
    assert language.predict(df.limit(0), model).count() == 0


def test_gram_counts_of_ranges_do_not_depend_on_the_range():
    import pyarrow as pa

    texts = [sentence("aa", n) for n in range(30)] + [None, "", "a"]
    whole = np.vstack([c for _, _, c in language.gram_counts(pa.array(texts))])
    single = np.vstack([c for t in texts for _, _, c in language.gram_counts(pa.array([t], pa.string()))])
    assert (whole == single).all() and whole[-1].sum() > 0 and whole[-2].sum() == 0


def documents():
    good = [". ".join(sentence("aa", 12).capitalize() for _ in range(random.randint(1, 9))) for _ in range(150)]
    bad = [" ".join([sentence("aa", 1)] * 60) for _ in range(25)] + [sentence("aa", 40).upper().replace(" ", "!! ") for _ in range(25)]
    return [(i, t, int(i < 150)) for i, t in enumerate(good + bad)]


def test_quality_is_learned(spark):
    rows = documents()
    df = spark.createDataFrame(rows + [(1000, "junk label", 7), (1001, "no label", None), (1002, None, 1)], "doc_id int, text string, label int")
    known = df.withColumn("statistics", quality.text_statistics("text"))
    model = quality.fit(known.filter("doc_id % 3 <> 1"))
    out = {r["doc_id"]: r for r in known.select("doc_id", model.score("text").alias("s"), model.score_statistics("statistics").alias("t")).collect()}
    held = [(out[i]["s"] >= 0.5) == bool(y) for i, _, y in rows if i % 3 == 1]
    assert np.mean(held) > 0.95
    assert all(0 <= r["s"] <= 1 and r["s"] == r["t"] for r in out.values())


def test_discriminant_is_the_density_ratio():
    rng = np.random.default_rng(1)
    width = len(quality.STATISTICS)
    sums, rows = np.zeros((2, width + 1, width + 1)), []
    for c in (0, 1):
        x = rng.normal(c, 1 + c, size=(300 + 100 * c, width))
        ones = np.column_stack([np.ones(len(x)), x])
        sums[c] = ones.T @ ones
        rows.append(x)
    model = quality.solve(sums, 0.1)
    pooled = np.diag(sum(len(x) * np.cov(x.T, bias=True) for x in rows)) / 700
    log = []
    for x in rows:
        weight = max(0.1, width / (width + len(x)))
        cov = (1 - weight) * np.cov(x.T, bias=True) + weight * np.diag(pooled) + quality.FLOOR * np.eye(width)
        d = rows[0][:5] - x.mean(axis=0)
        log.append(np.log((len(x) + 1) / 702) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d))
    assert model.scores(rows[0][:5]) == pytest.approx(1 / (1 + np.exp(log[0] - log[1])), abs=1e-9)


@pytest.mark.parametrize("labels, low, high", [([], 0.49, 0.51), ([1] * 20, 0.9, 1.0), ([0] * 20, 0.0, 0.1)])
def test_quality_with_missing_classes(spark, labels, low, high):
    rows = [(f"some text {i}", y) for i, y in enumerate(labels)]
    df = spark.createDataFrame(rows, "text string, label int").withColumn("statistics", quality.text_statistics("text"))
    model = quality.fit(df)
    texts = spark.createDataFrame([("some text",), (None,), ("",), ("A " * 50_000,)], "text string")
    scores = [r["s"] for r in texts.select(model.score("text").alias("s")).collect()]
    assert all(low <= s <= high for s in scores)


def test_statistics_of_odd_texts(spark):
    import pyarrow as pa

    rows = quality.statistics_of(pa.array([None, "", " ", "a", "Aa!! Aa!!\n", "é" * 10]))
    assert rows.shape == (6, len(quality.STATISTICS)) and np.isfinite(rows).all() and (rows[0] == 0).all() and (rows[1] == 0).all()
    assert quality.statistics_of(pa.array([], pa.string())).shape == (0, len(quality.STATISTICS))


def plain_statistics(text):
    import math

    import plain

    data, words = (text or "").encode(), [w.encode() for w in plain.words(text)]
    n, points = len(words), len(text or "")
    stops = set(b".,;:?'\"-")
    symbols = {c for c in range(33, 127) if not chr(c).isalnum() and c not in stops}

    def share(part, whole):
        return math.asin(math.sqrt(min(max(part / max(whole, 1), 0), 1)))

    triples = [tuple(words[i : i + 3]) for i in range(n - 2)] or [tuple(words)] * bool(words)
    return [
        math.log1p(len(data)),
        math.log1p(n),
        math.log1p(sum(map(len, words)) / max(n, 1)),
        share(sum(65 <= b <= 90 for b in data), points),
        share(sum(48 <= b <= 57 for b in data), points),
        share(sum(b in stops for b in data), n),
        share(sum(b in symbols for b in data), points),
        share(data.count(b"\n"), n),
        share(len(set(words)), n),
        share(max((words.count(w) for w in set(words)), default=0), n),
        share(sum(a == b for a, b in zip(words, words[1:])), n),
        share(sum(w[-1] in symbols for w in words), n),
        share(sum(len(w) <= 3 for w in words), n),
        share(len(set(triples)), len(triples)),
        share(sum(len(w) >= 14 for w in words), n),
    ]


def test_statistics_equal_plain_ones():
    import pyarrow as pa

    texts = [sentence(lang, n) for lang in ALPHABETS for n in (1, 2, 3, 40)] + ["Aa!! Aa!! 12-3\n\n\nx x x", "é 😀 漢字漢字漢字", "a" * 99, "!!!", None, ""]
    got = quality.statistics_of(pa.array(texts, pa.string()))
    for row, text in zip(got, texts):
        assert row.tolist() == pytest.approx(plain_statistics(text), abs=1e-12), text
