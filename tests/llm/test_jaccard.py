import random

import plain
import pytest
from pyspark.sql import functions as F

from yieldwatch.llm import jaccard

WORDS = [f"w{i}" for i in range(4000)]


def plain_components(rows):
    sets = [plain.shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    named = sorted((str(k), len(s), str(least.get(find(i), None) if s else k)) for i, ((k, _), s) in enumerate(zip(rows, sets)))
    return named, len({find(i) for i, s in enumerate(sets) if s})


def got(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = jaccard.similarity_components(df).collect()
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in out)


def text(n):
    return random.choices(WORDS, k=n)


def changed(words, times):
    words = list(words)
    for _ in range(times):
        words[random.randrange(len(words))] = random.choice(WORDS)
    return words


def corpus():
    random.seed(11)
    rows = []
    passage, line = text(60), text(12)
    bases = [text(n) for n in (5, 6, 8, 20, 60, 150, 400)]
    for base in bases:
        rows += [changed(base, k) for k in (0, 0, 1, 2, 3, 5, 8) for _ in range(3)]
    # A chain: neighbours link, the ends do not.
    chain = text(120)
    for _ in range(10):
        chain = chain[6:] + text(6)
        rows.append(chain)
    # One large group of near copies, and unrelated texts that share a passage or a line.
    base = text(100)
    rows += [changed(base, random.choice([1, 1, 2, 9])) for _ in range(120)]
    rows += [passage + text(random.choice([2, 8, 30, 90])) for _ in range(40)]
    rows += [line + text(random.choice([1, 3, 6])) for _ in range(40)]
    rows += [["a"] * 30, ["a"] * 31, ["a", "b"] * 20, ["a"], ["a", "b"], ["A", "b"]]
    texts = [" ".join(r) for r in rows] + [None, "", " \t", " ".join(text(30_000))]
    random.shuffle(texts)
    out = [(3 * i + 5, t) for i, t in enumerate(texts)]
    return out + [out[0], (out[1][0], out[2][1]), (None, out[3][1]), (None, " ".join(text(9)))]


@pytest.fixture(scope="module")
def rows():
    return corpus()


def test_components_are_those_of_all_pairs(spark, rows):
    assert got(spark, rows) == plain_components(rows)[0]


def test_small_limits_change_no_result(spark, rows, monkeypatch):
    # Several blocks for every group, and more buckets.
    monkeypatch.setattr(jaccard, "MOST_SETS", 7)
    monkeypatch.setattr(jaccard, "POSTINGS", 500)
    assert got(spark, rows) == plain_components(rows)[0]


def test_empty_tables(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, None), (2, "")]) == [("1", 0, "1"), ("2", 0, "2")]


def test_one_row_of_each_component_stays_with_all_its_columns(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"_class": F.lit(1), "class": F.lit("c"), "_again": F.lit(2)})
    out = jaccard.keep_one(df)
    assert out.columns == df.columns
    kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert len([k for k, t in kept if plain.words(t)]) == plain_components(rows)[1]
    sets = [plain.shingles(t) for _, t in kept]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    assert links == []
    assert sum(not s for s in sets) == sum(not plain.words(t) for _, t in rows)


def test_overlaps_are_those_of_sets(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 300, size=n).astype(np.uint64)) for n in rng.integers(1, 80, size=60)]
    expected = [[len(set(a.tolist()) & set(b.tolist())) for b in sets[20:]] for a in sets[:20]]
    for many in (0, 20, 10**9):
        monkeypatch.setattr(jaccard, "MANY", many)
        assert jaccard.overlaps(sets[:20], sets[20:]).tolist() == expected


@pytest.mark.parametrize("limit", [5, 10**9])
def test_families_are_settled_by_their_pivot_or_compared(spark, monkeypatch, limit):
    """Near copies of one text, some too far from it that link with each other only."""
    monkeypatch.setattr(jaccard, "MOST_SETS", limit)
    random.seed(12)
    base = text(80)
    far = changed(base, 3)[:-6] + text(9)
    rows = [" ".join(changed(base, random.choice([0, 1, 2]))) for _ in range(60)]
    rows += [" ".join(changed(far, random.choice([0, 1, 3, 6]))) for _ in range(30)]
    rows = list(enumerate(rows))
    assert got(spark, rows) == plain_components(rows)[0]


def test_a_key_named_like_a_made_column(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f")], "component_id bigint, text string")
    out = jaccard.similarity_components(df, key="component_id")
    assert out.columns == ["_component_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, out.collect())) == [(1, 2, 1), (2, 2, 1)]
