import numpy as np
import pytest
from pyspark.sql import functions as F

from yieldwatch.llm import hamming

SCHEMA = "vec_id bigint, embedding array<float>"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows], SCHEMA)


def brute(rows, k):
    ids = np.array([i for i, _ in rows])
    matrix = np.array([v for _, v in rows], dtype=np.float32).astype(float)
    out = {}
    for q in np.flatnonzero(ids % 20 == 0):
        others = ids != ids[q]
        scores = matrix[others] @ matrix[q]
        order = np.lexsort((ids[others], -scores))[:k]
        out[int(ids[q])] = [(int(ids[others][o]), scores[o]) for o in order]
    return out


def search(spark, rows, k=20):
    out: dict = {}
    for r in hamming.nearest_neighbours(frame(spark, rows), F.col("vec_id") % 20 == 0, k).collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(v) for q, v in out.items()}


@pytest.mark.parametrize("scale", [False, True])
def test_recall_and_exact_scores(spark, scale):
    rng = np.random.default_rng(15)
    centres = rng.normal(size=(10, 32))
    matrix = centres[rng.integers(0, 10, 1500)] + rng.normal(size=(1500, 32))
    if scale:  # lengths differ
        matrix *= rng.uniform(0.5, 2, size=(1500, 1))
    rows = list(enumerate(matrix.astype(np.float32)))
    expected, got = brute(rows, 20), search(spark, rows)
    assert set(expected) == set(got)
    hits = 0
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 21))
        exact = {i: float(matrix[i].astype(np.float32).astype(float) @ matrix[q].astype(np.float32).astype(float)) for _, i, _ in found}
        assert all(s == pytest.approx(exact[i], abs=1e-9) for _, i, s in found)
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        hits += len({i for _, i, _ in found} & {i for i, _ in expected[q]})
    assert hits / (20 * len(got)) >= 0.9


def test_copies_ties_and_vectors_that_take_no_part(spark):
    rng = np.random.default_rng(16)
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(100)] + [(i, rng.normal(size=4).astype(np.float32)) for i in range(100, 160)]
    odd = [(200, None), (220, [0.0] * 4), (240, [1.0, None, 1.0, 1.0]), (260, [float("nan")] * 4), (280, [float("inf")] * 4), (300, [1.0, 2.0]), (None, [9.0] * 4)]
    odd += [(301, [2.0, 1.0]), (302, [0.5, 0.5]), (303, [])]
    expected, got = brute(rows, 20), search(spark, rows + odd + [rows[0], rows[130]])
    # A vector of another length is compared with those of its own.
    assert [i for _, i, _ in got.pop(300)] == [301, 302]
    assert set(got) == set(expected)
    for q in range(0, 100, 20):  # the copies with the smallest ids, without the query itself
        assert [i for _, i, _ in got[q]] == [i for i in range(22) if i != q][:20] == [i for i, _ in expected[q]]


def test_few_rows_and_no_rows(spark):
    rows = [(20, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])]
    assert [(i, s) for _, i, s in search(spark, rows)[20]] == [(1, 0.5), (2, -1.0)]
    assert search(spark, [(20, [1.0, 0.0])]) == {}
    assert search(spark, []) == search(spark, [(20, None)]) == {}


def test_probing_meets_every_code_within_the_radius():
    rng = np.random.default_rng(17)
    codes = rng.integers(0, 2**32, size=(400, 3), dtype=np.uint32)
    codes[200:] = codes[:200] ^ (np.uint32(1) << rng.integers(0, 32, size=(200, 3), dtype=np.uint32))
    block = hamming.Block(codes)
    for radius in (0, 1, 3, 5, 8, 20, 45, 96):
        for code in codes[::40]:
            apart = np.bitwise_count(codes ^ code).sum(axis=1, dtype=np.int64)
            assert block.within(code, radius).tolist() == np.flatnonzero(apart <= radius).tolist()


def test_many_rows_ask_with_one_vector(spark):
    rng = np.random.default_rng(19)
    rows = [(i, [1.0, 0.5, 0.0]) for i in range(0, 4000, 20)] + [(i, rng.normal(size=3).astype(np.float32)) for i in range(1, 200, 20)]
    expected, got = brute(rows, 20), search(spark, rows)
    assert {q: [i for _, i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in expected.items()}


@pytest.mark.parametrize("key", ["score", "rank", "query_id", "vector"])
def test_key_names_that_clash(spark, key):
    df = frame(spark, [(20, [1.0, 0.0]), (1, [0.5, 0.5])]).withColumnRenamed("vec_id", key)
    out = hamming.nearest_neighbours(df, F.col(key) % 20 == 0, key=key)
    assert out.columns == ["query_id", "rank", key if key == "vector" else f"_{key}", "score"]
    assert tuple(out.first()) == (20, 1, 1, 0.5)
