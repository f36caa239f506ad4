"""Whitening against plain numpy and exact fractions."""

from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from yieldwatch.llm import queries, whitening


def integers(vectors):
    return np.floor(64 * np.asarray(vectors, dtype=np.float64)).astype(np.int64) + 1_000_000


def table(spark, rows, extra=""):
    return spark.createDataFrame(rows, f"vec_id bigint, embedding array<float>{extra}")


def run_query(spark, tmp_path, rows):
    table(spark, rows).write.parquet(str(tmp_path / "embeddings.parquet"))
    return queries.QUERIES["op11_polarisation_whitening"](spark, str(tmp_path))


def test_query_equals_numpy(spark, tmp_path):
    random = np.random.default_rng(3)
    vectors = (random.normal(size=(400, 40)) @ random.normal(size=(40, 40)) / 6 + 3).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    bad = [(900, None), (901, [None] + [0.5] * 39), (902, [float("nan")] * 40), (903, [float("inf")] * 40)]
    out = run_query(spark, tmp_path, rows + bad).toPandas().sort_values(["vec_id", "component"])
    assert len(out) == 400 * 32 and set(out["vec_id"]) == set(range(400)) and (out["n"] == 400).all()

    x = integers(vectors)
    sums = x.sum(axis=0)
    centred = x - sums / 400
    values, axes = np.linalg.eigh(centred.T @ centred / 400)
    values, axes = values[::-1], axes[:, ::-1]
    want = centred @ axes[:, :32] / np.sqrt(values[:32])
    got = out["whitened"].to_numpy().reshape(400, 32)
    assert np.abs(np.abs(want) - np.abs(got)).max() < 1e-8
    assert np.allclose(out["explained"].to_numpy()[:32], values[:32] / values.sum(), rtol=1e-9)
    assert out["deviation"].to_numpy()[::32].tolist() == ((400 * x - sums) ** 2).sum(axis=1).tolist()
    assert out["identity_error"].nunique() == 1 and out["identity_error"].iloc[0] < 1e-9


def test_covariance_is_the_nearest_double_of_the_exact_fraction(spark):
    random = np.random.default_rng(5)
    vectors = random.normal(size=(97, 5))
    model = whitening.fit(table(spark, [(i, v.tolist()) for i, v in enumerate(vectors)]))[5]
    x = integers(vectors.astype(np.float32)).tolist()
    n = len(x)
    for i in range(5):
        for j in range(5):
            si, sj = sum(r[i] for r in x), sum(r[j] for r in x)
            exact = sum((r[i] - Fraction(si, n)) * (r[j] - Fraction(sj, n)) for r in x) / n
            assert model.covariance[i, j] == float(exact)


def test_sums_stay_exact_beyond_64_bits():
    z = np.array([[2**40, -(2**41)], [2**40 + 1, 5]], dtype=np.int64)
    want = [sum(int(v) ** 2 for v in z[:, k]) for k in (0, 1)] + [sum((int(a) + int(b)) ** 2 for a, b in z)]
    assert whitening._square_sums(z) == want
    model = whitening.Whitening(10**9, [3, 4], np.eye(2), np.ones(2), np.eye(2), np.ones(2))
    assert model.deviations(z) == [sum((10**9 * int(v) - s) ** 2 for v, s in zip(row, (3, 4))) for row in z]


def test_ties_constants_and_more_dimensions_than_rows(spark, tmp_path):
    rows = [(1, [1.0, 2.0, 3.0]), (1, [1.0, 2.0, 3.0]), (2, [1.0, 5.0, 3.0])]
    out = run_query(spark, tmp_path, rows).toPandas()
    assert len(out) == 9 and sorted(out["component"].unique()) == [1, 2, 3]
    first = out[out["component"] == 1]
    assert np.allclose(sorted(np.abs(first["whitened"])), sorted([2**-0.5, 2**-0.5, 2**0.5])) and (first["explained"] == 1).all()
    rest = out[out["component"] > 1]
    assert (rest["whitened"] == 0).all() and (rest["explained"] == 0).all() and (out["identity_error"] < 1e-12).all()


def test_one_row_no_rows_other_widths_and_clashing_columns(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    assert run_query(spark, tmp_path / "a", []).count() == 0
    one = run_query(spark, tmp_path / "b", [(1, [1.0, 2.0])]).collect()
    assert [(r["whitened"], r["deviation"], r["identity_error"]) for r in one] == [(0, 0, 0)] * 2
    rows = [(1, [1.0, 2.0], 5, 6), (2, [4.0, 2.5], 7, 8), (3, [1.0], 9, 9), (4, [2.0], 9, 9), (5, [], 9, 9)]
    df = table(spark, rows, ", n int, _vector int")
    models = whitening.fit(df)
    assert sorted(models) == [1, 2]
    out = {r["vec_id"]: r for r in whitening.transform(df, models).collect()}
    assert out[1].asDict().keys() == {"vec_id", "embedding", "_vector", "n", "deviation", "whitened", "explained"}
    assert (out[1]["n"], out[3]["n"], out[5]["n"], out[5]["whitened"], out[2]["_vector"]) == (2, 2, None, [], 8)
    assert whitening.transform(df.filter(F.lit(False)), {}).count() == 0
