"""ARMA and bent-trend forecasts, unit-root and drift tests, profiles, rows with NULL keys."""

import datetime as dt
import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from yieldwatch.operators import arma, audit, drift, evaluate, forecast, profile
from yieldwatch.operators.lagged import Lagged, lagged_products
from yieldwatch.plans import training

D = dt.date


def daily(spark, **series):
    rows = [
        (None if s == "null" else s, D(2018, 1, 1) + dt.timedelta(i), None if v is None else float(v))
        for s, values in series.items()
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, "series_id string, date date, value double")


def horizons(spark, **days):
    return spark.createDataFrame([(None if k == "null" else k, n) for k, n in days.items()], "series_id string, horizon int")


# --- ARMA -------------------------------------------------------------------------------


def arma_series(n, phi, theta, seed, constant=0.0):
    rng = np.random.default_rng(seed)
    e, y = rng.normal(size=n + 200), np.zeros(n + 200)
    for t in range(1, n + 200):
        y[t] = constant + phi * y[t - 1] + e[t] + theta * e[t - 1]
    return y[200:]


def fitted(spark, values, orders, long=arma.LONG, period=arma.PERIOD):
    lookback = arma.rows_back(orders, long, period)
    row = lagged_products(daily(spark, s=values), "series_id", "date", "value", lookback, True).first()
    return arma.fit(np.array(row["gram"]), orders, long, period)


def test_an_arma_process_is_recovered(spark):
    y = arma_series(6000, 0.7, 0.5, 3)
    model = fitted(spark, y, [arma.Order(1, 0, 1)])
    assert model.values[0] == pytest.approx(0.7, abs=0.04) and model.residuals[0] == pytest.approx(0.5, abs=0.04)
    chosen = fitted(spark, y, arma.all_orders()).order
    assert chosen.q >= 1 or chosen.p >= 4  # a pure autoregression of few rows does not fit it
    moving = fitted(spark, arma_series(6000, 0.0, 0.8, 4), [arma.Order(p, 0, q) for p in range(3) for q in range(3)])
    assert moving.order.q >= 1 and moving.residuals[0] == pytest.approx(0.8, abs=0.15)


def test_both_regressions_equal_direct_least_squares(spark):
    y = arma_series(500, 0.5, 0.4, 5, constant=2.0)
    order, long = arma.Order(2, 0, 2), 6
    model = fitted(spark, y, [order], long)
    back = arma.rows_back([order], long, arma.PERIOD)
    z = y - y.mean()
    rows = np.arange(back, len(z))
    x = np.column_stack([np.ones(len(rows)), *[z[rows - i] for i in range(1, long + 1)]])
    w = np.linalg.lstsq(x, z[rows], rcond=None)[0]

    def shock(t):
        return z[t] - w[0] - sum(w[i] * z[t - i] for i in range(1, long + 1))

    x = np.column_stack([np.ones(len(rows)), z[rows - 1], z[rows - 2], shock(rows - 1), shock(rows - 2)])
    want = np.linalg.lstsq(x, z[rows], rcond=None)[0]
    np.testing.assert_allclose([model.constant, *model.values, *model.residuals], want, atol=1e-8)


def test_a_season_of_rows_is_found(spark):
    rng = np.random.default_rng(6)
    y = np.tile(rng.normal(scale=5, size=12), 60) + rng.normal(scale=0.1, size=720)
    got = arma.forecast_arma(daily(spark, s=y[:708]), horizons(spark, s=12), daily=True).orderBy("step").toPandas()
    assert (got["seasonal"] == 1).all()
    assert np.abs(got["predicted"].to_numpy() - y[708:]).max() < 0.6
    plain = forecast.forecast_ar(daily(spark, s=y[:708]), horizons(spark, s=12), daily=True).orderBy("step").toPandas()
    assert np.abs(got["predicted"].to_numpy() - y[708:]).mean() < np.abs(plain["predicted"].to_numpy() - y[708:]).mean()


def test_without_residuals_the_forecast_is_the_autoregression(spark):
    y = arma_series(400, 0.6, 0.0, 8, constant=3.0)
    df, wanted = daily(spark, s=y, null=y + 1), horizons(spark, s=20, null=20)
    fixed = arma.Order(2, 1)
    got = arma.forecast_arma(df, wanted, daily=True, fixed=fixed).toPandas()
    assert got["series_id"].isna().sum() == 20
    # The autoregression of the older operator reads seven rows back; the same rows here.
    z = np.diff(y)
    rows = np.arange(2, len(z))
    x = np.column_stack([np.ones(len(rows)), z[rows - 1], z[rows - 2]])
    w = np.linalg.lstsq(x, z[rows], rcond=None)[0]
    first = y[-1] + w[0] + w[1] * z[-1] + w[2] * z[-2]
    one = got[(got["series_id"] == "s") & (got["step"] == 1)]["predicted"].iloc[0]
    assert one == pytest.approx(first, abs=1e-6)


def test_short_constant_and_unknown_series(spark):
    df = daily(spark, short=[1.0, 2.0], flat=[4.0] * 300, gone=[None] * 50)
    got = arma.forecast_arma(df, horizons(spark, short=3, flat=3, gone=3), daily=True).toPandas()
    assert got[got["series_id"] == "short"]["predicted"].tolist() == [2.0] * 3
    assert got[got["series_id"] == "flat"]["predicted"].to_numpy() == pytest.approx([4.0] * 3)
    assert set(got["series_id"]) == {"short", "flat"}
    assert arma.forecast_arma(df.limit(0), horizons(spark, short=3), daily=True).count() == 0


# --- bent trend ---------------------------------------------------------------------------


def test_a_bent_line_is_recovered(spark):
    t = np.arange(1000)
    y = np.where(t < 400, 0.02 * t, 0.02 * 400 - 0.05 * (t - 400))
    df = daily(spark, s=y[:900])
    bent = forecast.forecast_trend_season(df, horizons(spark, s=100), yearly=0, weekly=0, changepoints=20, penalty=0.001)
    straight = forecast.forecast_trend_season(df, horizons(spark, s=100), yearly=0, weekly=0)
    bent, straight = (f.orderBy("step").toPandas()["predicted"].to_numpy() for f in (bent, straight))
    assert np.abs(bent - y[900:]).max() < 1.0 and np.abs(straight - y[900:]).max() > 8


def test_a_high_penalty_gives_the_straight_trend(spark):
    rng = np.random.default_rng(9)
    df = daily(spark, s=rng.normal(size=700).cumsum(), null=rng.normal(size=500).cumsum())
    wanted = horizons(spark, s=30, null=30)
    straight = forecast.forecast_trend_season(df, wanted).toPandas().sort_values(["series_id", "step"])
    stiff = forecast.forecast_trend_season(df, wanted, changepoints=25, penalty=1.0).toPandas().sort_values(["series_id", "step"])
    assert len(stiff) == 60
    np.testing.assert_allclose(stiff["predicted"], straight["predicted"], atol=1e-6)


def test_descent_reaches_the_least_priced_error():
    rng = np.random.default_rng(10)
    x, y = rng.normal(size=(200, 7)), rng.normal(size=200)
    gram = x.T @ np.column_stack([x, y])
    alone, _ = forecast.solve_changes(gram, 3, 2.0)
    np.testing.assert_allclose(alone, np.linalg.lstsq(x[:, :3], y, rcond=None)[0], atol=1e-9)
    weights, changes = forecast.solve_changes(gram, 3, 0.3)
    rest = x[:, 3:] - x[:, :3] @ np.linalg.lstsq(x[:, :3], x[:, 3:], rcond=None)[0]
    price = 0.3 * np.abs(rest.T @ y).max()

    def cost(w, c):
        return 0.5 * np.square(y - x @ np.concatenate([w, c])).sum() + price * np.abs(c).sum()

    least = cost(weights, changes)
    for _ in range(300):
        assert least <= cost(weights + rng.normal(scale=1e-3, size=3), changes + rng.normal(scale=1e-3, size=4)) + 1e-12


# --- unit root ----------------------------------------------------------------------------


def direct_adf(y, lags, back):
    """(aic, t) of the level with that many earlier changes, on rows that have `back` before them."""
    dy = np.diff(y)
    rows = np.arange(back, len(y))
    x = np.column_stack([y[rows - 1], np.ones(len(rows)), *[dy[rows - 1 - i] for i in range(1, lags + 1)]])
    target = dy[rows - 1]
    w = np.linalg.lstsq(x, target, rcond=None)[0]
    rss = np.square(target - x @ w).sum()
    error = math.sqrt(rss / (len(rows) - x.shape[1]) * np.linalg.inv(x.T @ x)[0, 0])
    return len(rows) * math.log(rss / len(rows)) + 2 * x.shape[1], w[0] / error


def test_lags_are_those_of_the_least_aic(spark):
    rng = np.random.default_rng(12)
    walk = rng.normal(size=400).cumsum() + 50
    swing = np.zeros(400)
    for t in range(3, 400):
        swing[t] = 0.5 * swing[t - 1] - 0.3 * swing[t - 3] + rng.normal()
    got = {r["series_id"]: r for r in evaluate.unit_root_test(daily(spark, walk=walk, swing=swing, null=walk * 2), daily=True, max_lags=8).collect()}
    for name, y in (("walk", walk), ("swing", swing), (None, walk * 2)):
        found = [direct_adf(y, k, 9) for k in range(9)]
        best = min(range(9), key=lambda k: found[k][0])
        assert (got[name]["lags"], got[name]["n"]) == (best, 391)
        assert got[name]["t_stat"] == pytest.approx(found[best][1], rel=1e-6)
    assert got["swing"]["stationary"] and not got["walk"]["stationary"]


def test_p_values_of_the_published_surface():
    # Published critical values with a constant: 1 %, 5 %, 10 %.
    for t, p in ((-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10)):
        assert evaluate.dickey_fuller_p(t) == pytest.approx(p, abs=0.002)
    assert evaluate.dickey_fuller_p(3) == 1 and evaluate.dickey_fuller_p(-19) == 0
    # The two polynomials meet but for the last digits of what was published.
    assert evaluate.dickey_fuller_p(-1.6101) == pytest.approx(evaluate.dickey_fuller_p(-1.6099), abs=1e-2)


def test_unit_root_of_short_and_constant_series(spark):
    got = {r["series_id"]: r for r in evaluate.unit_root_test(daily(spark, short=[1.0, 2.0], flat=[3.0] * 100), daily=True, max_lags=2).collect()}
    assert got["short"]["t_stat"] is None and got["flat"]["t_stat"] is None and got["flat"]["stationary"] is None


# --- exact test of drift --------------------------------------------------------------------


def counted_p(n, m, distance):
    """The share of all orders of n and m values whose distance is at least `distance` / (n m)."""
    far = 0
    for first in itertools.combinations(range(n + m), n):
        chosen, i, most = set(first), 0, 0
        for k in range(n + m):
            i += k in chosen
            most = max(most, abs(i * m - (k + 1 - i) * n))
        far += most >= distance
    return far / math.comb(n + m, n)


@pytest.mark.parametrize("n, m", [(1, 1), (1, 6), (3, 3), (4, 6), (5, 7), (8, 4)])
def test_exact_p_equals_counted_paths(n, m):
    for distance in range(0, n * m + 1):
        assert drift.exact_ks_p(n, m, distance) == pytest.approx(counted_p(n, m, distance), abs=1e-12)


def test_exact_p_is_near_the_asymptotic_one_for_large_samples():
    n, m = 9000, 4000
    distance = round(0.02 * n * m)
    asymptotic = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * 0.02**2 * n * m / (n + m)) for k in range(1, 50))
    assert drift.exact_ks_p(n, m, distance) == pytest.approx(asymptotic, abs=0.02)


def test_small_samples_get_the_exact_p(spark):
    rng = np.random.default_rng(13)
    rows = [("train" if i < 30 else "test", float(v), None) for i, v in enumerate(rng.normal(size=48))]
    df = spark.createDataFrame(rows, "split string, x double, y double")
    got = {r["feature"]: r for r in drift.ks_statistic(df, ["x", "y"]).collect()}
    assert got["x"]["p_value"] == pytest.approx(drift.exact_ks_p(30, 18, round(got["x"]["ks"] * 30 * 18)))


# --- profiles --------------------------------------------------------------------------------


def test_quartiles_are_exact_and_no_column_is_lost(spark):
    rng = np.random.default_rng(14)
    n = 20_000
    frame = pd.DataFrame(
        {
            "a": rng.normal(size=n),
            "b": rng.integers(0, 4, n).astype(float),
            "c": np.where(rng.random(n) < 0.7, 5.0, rng.normal(size=n)),
            "d": np.full(n, np.nan),
            "e": np.where(rng.random(n) < 0.4, np.nan, rng.exponential(size=n)),
        }
    )
    frame.loc[:6000, "f"] = np.inf
    frame["f"] = frame["f"].fillna(1.0)
    df = spark.createDataFrame(frame)
    got = profile.describe_numeric(df, list(frame.columns)).toPandas().set_index("column_name")
    assert list(got.index) == list(frame.columns)
    for c in "abce":
        want = frame[c].describe()
        np.testing.assert_allclose(got.loc[c, ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]].astype(float), want.to_numpy(), rtol=1e-9)
    assert got.loc["d", "count"] == 0 and got.loc["d"].drop("count").isna().all()
    assert got.loc["f", "q25"] == 1.0 and got.loc["f", "q75"] == np.inf
    assert profile.describe_numeric(df.limit(0), ["a"]).first()["count"] == 0


def test_a_sketch_that_misses_is_made_good(spark, monkeypatch):
    monkeypatch.setattr(profile, "MARGIN", 0.0)
    monkeypatch.setattr(profile, "SKETCH", 8)
    values = np.random.default_rng(15).normal(size=5001)
    got = profile.describe_numeric(spark.createDataFrame(pd.DataFrame({"x": values})), ["x"]).first()
    assert [got["q25"], got["q50"], got["q75"]] == pytest.approx(np.quantile(values, [0.25, 0.5, 0.75]).tolist())


def test_the_profile_does_not_explode_the_table(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("x"), F.col("id").cast("double").alias("y"))
    assert "Generate" not in df.agg(F.kll_sketch_agg_double("x"))._jdf.queryExecution().executedPlan().toString()
    assert [r["q50"] for r in profile.describe_numeric(df, ["x", "y"]).collect()] == [49.5, 49.5]


def test_distinct_estimate_is_within_its_bound(spark):
    df = spark.range(50_000).select("id", (F.col("id") % 7).alias("few"))
    got = {r["column_name"]: r["approx_distinct"] for r in profile.table_structure(df, "t", distinct=True).collect()}
    assert abs(got["id"] - 50_000) <= 5 * profile.DISTINCT_ERROR * 50_000 and got["few"] == 7


# --- NULL keys --------------------------------------------------------------------------------


def test_audit_compares_rows_with_a_null_key(spark):
    rows = [(s, D(2020, 1, 1) + dt.timedelta(i), float(i)) for s in ("a", None) for i in range(20)]
    source = spark.createDataFrame(rows, "series_id string, date date, value double")
    got = audit.lookahead_audit(source, lambda df: df.withColumn("twice", F.col("value") * 2), D(2020, 1, 11)).collect()
    assert [(r["feature"], r["rows_compared"], r["rows_changed"], r["uses_future"]) for r in got] == [
        ("value", 22, 0, False),
        ("twice", 22, 0, False),
    ]


def test_forecasts_keep_a_series_without_a_name(spark):
    rng = np.random.default_rng(16)
    clean = daily(spark, a=rng.normal(size=300).cumsum(), null=rng.normal(size=300).cumsum())
    result = training.train_eval_forecast(clean)
    assert {r["target"] for r in result.metrics.collect()} == {"a", None} and result.metrics.count() == 4
    assert result.predictions.filter("target IS NULL").count() == 120
    assert {r["target"] for r in result.best.collect()} == {"a", None}


def test_lagged_terms():
    terms = Lagged(np.eye(5).ravel())
    np.testing.assert_array_equal(terms.level[2], terms.unit[1] - terms.unit[3])
    np.testing.assert_array_equal(terms.differenced(2)[0], terms.change[0] - terms.change[1])
