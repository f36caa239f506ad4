import random

import numpy as np
import plain
import pyarrow as pa

from yieldwatch.llm import words
from yieldwatch.llm.components import connected_components


def test_words_and_shingles_are_those_of_a_plain_split():
    random.seed(1)
    signs = ["a", "B", "Zz", " ", "\t", "\n", "\x0b", "é", "\u00a0", "漢", ".", "x1"]
    texts = [None, "", " ", "one", "a b c d", "a b c d e"] + ["".join(random.choices(signs, k=random.randint(0, 40))) for _ in range(500)]
    names = {}
    for first, last, found in words.words_of(pa.array(texts)):
        for i in range(first, last):
            own = found.hashes[found.offsets[i - first] : found.offsets[i - first + 1]]
            expected = plain.words(texts[i])
            assert len(own) == len(expected)
            for h, w in zip(own.tolist(), expected):
                assert names.setdefault(w, h) == h
        hashes, offsets = words.shingles_of(found)
        for i in range(first, last):
            assert len(set(hashes[offsets[i - first] : offsets[i - first + 1]].tolist())) == len(plain.shingles(texts[i]))
    assert len(set(names.values())) == len(names)


def test_sliced_arrays_and_large_texts():
    texts = pa.array(["skip me", "a b", None, "x " * (words.PART_BYTES // 2 + 10), "c"])
    counts = np.concatenate([w.counts for _, _, w in words.words_of(texts.slice(1))])
    assert counts.tolist() == [2, 0, words.PART_BYTES // 2 + 10, 1]


def components(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_components_of_chains_stars_and_random_edges(spark):
    random.seed(2)
    edges = [(i, i + 1) for i in range(100, 140)] + [(200, x) for x in range(201, 260)]
    edges += [(random.randint(300, 400), random.randint(300, 400)) for _ in range(60)]
    edges += [(None, 5), (7, 7), (101, 100), (100, 101)]
    found = connected_components(spark.createDataFrame(edges, "a int, b int"), "a", "b").collect()
    assert len(found) == len({r["node"] for r in found})
    assert {r["node"]: r["root"] for r in found} == components(edges)


def test_no_edges_have_no_components(spark):
    assert connected_components(spark.createDataFrame([(1, 1)], "a int, b int"), "a", "b").count() == 0
