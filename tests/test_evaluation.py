"""Drift, ranking metrics, profiles, stability: against brute force and by hand."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from yieldwatch.functions import scalars as sc
from yieldwatch.operators import curves, drift, evaluate, monitor, prefix, prepare, profile, reports


def split_frame(spark, train, test):
    rows = [("train", None if v is None else float(v)) for v in train]
    rows += [("test", None if v is None else float(v)) for v in test]
    return spark.createDataFrame(rows, "split string, x double")


def brute_psi(train, test, bins=10):
    train = np.array([v for v in train if v is not None and not np.isnan(v)], dtype=float)
    test = np.array([v for v in test if v is not None and not np.isnan(v)], dtype=float)
    edges = pd.cut(pd.Series(train), bins=bins, retbins=True)[1]
    e = pd.cut(pd.Series(train), bins=edges, include_lowest=True).value_counts(sort=False).to_numpy() / len(train)
    a = pd.cut(pd.Series(test), bins=edges, include_lowest=True).value_counts(sort=False).to_numpy() / len(test)
    keep = e > 0
    return float(np.sum((a[keep] - e[keep]) * np.log(a[keep] / e[keep] + 1e-10)))


CASES = {
    "normal": (np.random.default_rng(1).normal(size=500), np.random.default_rng(2).normal(0.3, 1.2, 200)),
    "on edges": (list(range(11)), list(range(11))),
    "outside": ([1, 2, 3, 4], [10, 20, 2]),
    "empty bin": ([0, 0, 10, 10], [5, 5, 5, 0]),
    "constant": ([3, 3, 3], [3, 3, 4]),
    "constant zero": ([0, 0], [0, 1]),
    "negative constant": ([-2, -2], [-2, -2.001, -3]),
    "missing": ([1, 2, None, float("nan"), 5], [1, None, 2]),
}


@pytest.mark.parametrize("case", CASES)
def test_psi_matches_pandas_cut(spark, case):
    train, test = CASES[case]
    got = drift.psi(split_frame(spark, train, test), ["x"]).first()
    assert got["psi"] == pytest.approx(brute_psi(train, test), abs=1e-12)


def test_psi_of_an_empty_side_is_null_and_drift_skips_it(spark):
    df = split_frame(spark, [1, 2, 3], [None, None]).withColumn("y", F.lit(1.0))
    assert drift.psi(df, ["x"]).first()["psi"] is None
    assert [r.feature for r in drift.feature_drift(df, ["x", "y"]).collect()] == ["y"]


def test_drift_report_status_and_unknown_method(spark):
    df = split_frame(spark, [1, 2, 3, 4], [10, 20, 30])
    row = drift.feature_drift(df, ["x"]).first()
    assert row["drift_status"] == "Significant" and row["train_mean"] == 2.5 and row["test_mean"] == 20.0
    assert row["mean_diff_pct"] == pytest.approx(700.0)
    assert drift.top_drift(drift.feature_drift(df, ["x"])).count() == 1
    with pytest.raises(ValueError):
        drift.feature_drift(df, ["x"], method="other")


def test_ks_matches_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    train, test = rng.normal(size=800).round(2), rng.normal(0.2, 1, 300).round(2)
    row = drift.ks_statistic(split_frame(spark, train, test), ["x"]).first()
    points = np.concatenate([train, test])
    want = max(abs((train <= p).mean() - (test <= p).mean()) for p in points)
    assert row["ks"] == pytest.approx(want, abs=1e-12)
    scaled = want * np.sqrt(800 * 300 / 1100)
    tail = 2 * sum((-1) ** (k - 1) * np.exp(-2 * k * k * scaled**2) for k in range(1, 101))
    # Small samples have the exact p; the asymptotic one, of larger ones, is near it.
    assert row["p_value"] == drift.exact_ks_p(800, 300, round(want * 800 * 300)) == pytest.approx(tail, abs=0.01)
    with monkeypatch.context() as context:
        context.setattr(drift, "EXACT_MOST", 0)
        row = drift.ks_statistic(split_frame(spark, train, test), ["x"]).first()
        assert row["p_value"] == pytest.approx(tail, abs=1e-12)
    same = drift.ks_statistic(split_frame(spark, [1, 2, 3], [1, 2, 3]), ["x"]).first()
    assert same["ks"] == 0.0 and same["p_value"] == 1.0


def scored(spark, seed=5, n=400, digits=2):
    rng = np.random.default_rng(seed)
    rows = []
    for model in ("a", "b"):
        score = rng.random(n).round(digits)
        label = (rng.random(n) < 0.2 + 0.6 * score).astype(int)
        rows += [(model, int(y), float(s)) for y, s in zip(label, score)]
    frame = pd.DataFrame(rows, columns=["model", "label", "score"])
    return frame, spark.createDataFrame(frame)


def test_auc_and_average_precision_match_brute_force(spark):
    frame, df = scored(spark)
    got = curves.ranking_metrics(df).toPandas().set_index("model")
    auc = curves.roc_auc(df).toPandas().set_index("model")["auc"]
    ap = curves.average_precision(df).toPandas().set_index("model")["average_precision"]
    for model, g in frame.groupby("model"):
        pos, neg = g[g.label == 1].score.to_numpy(), g[g.label == 0].score.to_numpy()
        wins = (pos[:, None] > neg).mean() + (pos[:, None] == neg).mean() / 2
        steps, last = 0.0, 0
        for s in sorted(g.score.unique(), reverse=True):
            taken = g[g.score >= s]
            found = taken.label.sum()
            steps += (found - last) / len(pos) * found / len(taken)
            last = found
        assert got.loc[model, "auc"] == pytest.approx(wins) == auc[model]
        assert got.loc[model, "average_precision"] == pytest.approx(steps) == ap[model]


def test_equal_scores_and_a_missing_class(spark):
    df = spark.createDataFrame([("m", 1, 0.5), ("m", 0, 0.5), ("n", 1, 0.1), ("n", 1, 0.2)], ["model", "label", "score"])
    got = {r.model: (r.auc, r.average_precision) for r in curves.ranking_metrics(df).collect()}
    assert got["m"] == (0.5, 0.5) and got["n"][0] is None and got["n"][1] == 1.0


def test_roc_curve_with_and_without_collinear_points(spark):
    frame, df = scored(spark, n=60, digits=1)
    full = curves.roc_curve(df).toPandas()
    short = curves.roc_curve(df, drop_collinear=True).toPandas()
    for model, g in frame.groupby("model"):
        scores = sorted(g.score.unique(), reverse=True)
        counts = [((g.score == s) & (g.label == 1)).sum() for s in scores], [((g.score == s) & (g.label == 0)).sum() for s in scores]
        keep = [
            i for i in range(len(scores))
            if i + 1 == len(scores) or (counts[0][i], counts[1][i]) != (counts[0][i + 1], counts[1][i + 1])
        ]
        got = full[(full.model == model) & full.threshold.notna()].sort_values("threshold", ascending=False)
        assert list(got.threshold) == scores
        np.testing.assert_allclose(got.tpr, np.cumsum(counts[0]) / sum(counts[0]))
        np.testing.assert_allclose(got.fpr, np.cumsum(counts[1]) / sum(counts[1]))
        kept = short[(short.model == model) & short.threshold.notna()].sort_values("threshold", ascending=False)
        assert list(kept.threshold) == [scores[i] for i in keep]
    start = full[full.threshold.isna()]
    assert len(start) == 2 and (start.fpr == 0).all() and (start.tpr == 0).all()


def test_pr_curve_closes_at_one_zero(spark):
    _, df = scored(spark)
    end = curves.pr_curve(df).filter("threshold IS NULL").toPandas()
    assert (end.precision == 1).all() and (end.recall == 0).all() and len(end) == 2


def test_histogram_matches_numpy(spark):
    frame, df = scored(spark, digits=6)
    got = curves.score_histogram(df).toPandas()
    for (model, label), g in frame.groupby(["model", "label"]):
        counts, edges = np.histogram(g.score, bins=30)
        density, _ = np.histogram(g.score, bins=30, density=True)
        own = got[(got.model == model) & (got.label == label)].sort_values("bin")
        filled = counts > 0
        assert list(own.n) == list(counts[filled])
        np.testing.assert_allclose(own.density, density[filled])
        np.testing.assert_allclose(own.lower, edges[:-1][filled])


def test_describe_matches_pandas(spark):
    rng = np.random.default_rng(9)
    frame = pd.DataFrame({"a": rng.normal(size=203), "b": rng.integers(0, 5, 203).astype(float), "c": [1.5] * 203})
    got = profile.describe_numeric(spark.createDataFrame(frame), ["a", "b", "c"]).toPandas().set_index("column_name")
    want = frame.describe()
    for c in frame:
        np.testing.assert_allclose(
            got.loc[c, ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]].astype(float), want[c], atol=1e-12
        )


def test_table_structure(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    rows = [tuple(r) for r in profile.table_structure(df, "t", distinct=True).orderBy("position").collect()]
    assert rows == [("t", 0, "a", "int", 0, 2), ("t", 1, "b", "string", 1, 1)]


def test_label_codes_follow_the_alphabet(spark):
    values = ["pear", "apple", "Zoo", None, "peach", "äpple", "apple"]
    df = spark.createDataFrame([(v, str(i)) for i, v in enumerate(values)], "c string, d string")
    got = {r.c: r.c_code for r in prepare.label_encode(df, ["c", "d"], "_code").collect()}
    order = sorted({v or "nan" for v in values})
    assert got == {v: order.index(v or "nan") for v in values}


def test_prepare_behavioral_keeps_probabilities_and_drops_incomplete_rows(spark):
    rows = [(1, "b", 0.1, 0.2, 0.5, 1, 0), (2, "a", None, 0.2, 0.5, 0, 1), (3, "a", float("nan"), 0.1, 0.4, 1, 0), (4, "c", 0.3, 0.1, 0.4, 0, 0)]
    df = spark.createDataFrame(
        rows,
        "customer_id int, customer_segment string, balance_volatility double, economic_stress double, "
        "outflow_probability double, outflow_event int, early_repayment_event int",
    )
    got = prepare.prepare_behavioral(df, "outflow_event")
    assert got.columns == [
        "customer_id", "customer_segment", "balance_volatility", "economic_stress", "outflow_probability",
        "volatility_stress", "volatility_sq", "stress_sq", "outflow_event",
    ]
    assert sorted((r.customer_id, r.customer_segment) for r in got.collect()) == [(1, 1), (4, 2)]


def test_scalars(spark):
    df = spark.createDataFrame([(0.5,), (2.0,), (None,)], "x double")
    assert [r[0] for r in df.select(sc.clip(F.col("x"), 1.0, 1.5)).collect()] == [1.0, 1.5, None]


def test_stability_of_edge_cases(spark):
    rows = [(1.0, 0.5, 10, 1.0), (2.0, 0.0, 10, 1.0), (1.3, 0.0, 10, 1.0), (1.0, None, 1, 1.0), (None, None, 0, 1.0)]
    df = spark.createDataFrame(rows, "m double, s double, n long, b double")
    got = [r[0] for r in df.select(evaluate.stability_of(F.col("m"), F.col("s"), F.col("n"), F.col("b"))).collect()]
    assert got[0] == pytest.approx(1 / 1.5) and got[1:3] == [0.7, 0.85] and got[3] is None and got[4] == 0.0


def test_baseline_comparison(spark):
    metrics = spark.createDataFrame([("t", "a", 2.0, 1.0), ("t", "b", 1.0, 0.5)], ["target", "model", "rmse", "mae"])
    best = evaluate.best_baseline(metrics)
    assert tuple(best.first()) == ("t", "b", 1.0, 0.5)
    gain = {r.model: r.improvement_pct for r in evaluate.improvement_vs_baseline(metrics, best).collect()}
    assert gain == {"a": -100.0, "b": 0.0}


def test_importance_share_and_order(spark):
    df = spark.createDataFrame([("x", 1.0), ("y", 3.0)], ["feature", "importance"])
    assert [tuple(r) for r in evaluate.importance_pct(df).collect()] == [("y", 3.0, 75.0), ("x", 1.0, 25.0)]


def test_unit_root_statistic(spark):
    rng = np.random.default_rng(0)
    noise, walk = rng.normal(size=300), rng.normal(size=300).cumsum()
    days = pd.date_range("2020-01-01", periods=300)
    rows = [(n, d.date(), float(v)) for n, s in (("noise", noise), ("walk", walk)) for d, v in zip(days, s)]
    got = {r.series_id: r for r in evaluate.stationarity(spark.createDataFrame(rows, ["series_id", "date", "value"])).collect()}
    x, y = noise[:-1], np.diff(noise)
    design = np.column_stack([np.ones(299), x])
    beta, rss = np.linalg.lstsq(design, y, rcond=None)[:2]
    error = np.sqrt(rss[0] / 297 * np.linalg.inv(design.T @ design)[1, 1])
    assert got["noise"].t_stat == pytest.approx(beta[1] / error) and got["noise"].stationary
    assert not got["walk"].stationary


def test_prediction_column_names():
    columns = ["date", "actual", "random_forest_pred", "xgboost_pred"]
    assert monitor.prediction_column(columns, "XGBoost") == "xgboost_pred"
    assert monitor.prediction_column(columns, "RandomForest") == "random_forest_pred"
    assert monitor.prediction_column(columns, "Other") == "random_forest_pred"
    assert monitor.prediction_column(["actual_pred", "xgb_pred"], "XGBoost") == "xgb_pred"
    with pytest.raises(ValueError):
        monitor.prediction_column(["date", "actual"], "XGBoost")


def test_reports(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 0)], ["seg", "event"])
    assert sorted(tuple(r) for r in reports.segment_share(df, "seg").collect()) == [("a", 2, 66.67), ("b", 1, 33.33)]
    balance = {(r.label, r.n): r.positive_rate_pct for r in reports.class_balance(df, ["event"]).collect()}
    assert balance.keys() == {(0, 2), (1, 1)} and balance[(1, 1)] == pytest.approx(100 / 3)


def test_many_categories_of_one_column_are_ranked_in_many_buckets(spark):
    names = [f"CUST_{i * 7919 % 3000:05d}" for i in range(3000)]
    df = spark.createDataFrame([(n,) for n in names], ["c"])
    got = {r.c: r.c_code for r in prepare.label_encode(df, ["c"], "_code").collect()}
    assert got == {n: i for i, n in enumerate(sorted(names))}
    assert prefix.add_bucket(df, [], "c", 128).select(prefix.BUCKET).distinct().count() > 100


def test_a_hot_key_gets_its_share_of_buckets(spark):
    rows = spark.range(9000).select(
        F.when(F.col("id") < 8000, "hot").otherwise("cold").alias("k"), F.rand(1).alias("x"), F.lit(1).alias("n")
    )
    buckets = prefix.add_bucket(rows, ["k"], "x", 128).filter("k = 'hot'").groupBy(prefix.BUCKET).count().toPandas()
    assert len(buckets) > 100 and buckets["count"].max() < 8000 / 40
    for number in (None, 128):
        sums = prefix.prefix_sums(rows, ["k"], "x", ["n"], buckets=number).toPandas().sort_values("x")
        for _, g in sums.groupby("k"):
            assert g["before_n"].tolist() == list(range(len(g))) and (g["total_n"] == len(g)).all()


def test_keys_with_ranges_of_their_own_are_spread_alike(spark):
    rows = spark.range(20_000).select((F.col("id") % 400).alias("k"), F.lit(1).alias("n"), "id")
    rows = rows.withColumn("x", F.col("k") * 1000.0 + F.col("id") / 1e5)
    buckets = prefix.add_bucket(rows, ["k"], "x", 800).groupBy("k").agg(F.countDistinct(prefix.BUCKET).alias("n"))
    assert buckets.agg(F.avg("n")).first()[0] >= 2
    sums = prefix.prefix_sums(rows, ["k"], "x", ["n"], buckets=800)
    wrong = sums.filter((F.col("total_n") != 50) | (F.col("before_n") != F.floor(F.col("id") / 400)))
    assert sums.count() == 20_000 and wrong.count() == 0


def test_very_large_counts_do_not_overflow(spark):
    # 4e9 rows of each class would make these counts; they are put in place of the counting.
    counts = spark.createDataFrame([("m", 0.9, 3e9, 1e9), ("m", 0.1, 1e9, 3e9)], "model string, score double, pos double, neg double")
    steps = prefix.prefix_sums(counts, ["model"], "score", ["pos", "neg"], descending=True)
    real = curves.score_steps
    curves.score_steps = lambda *a, **k: steps
    try:
        found = curves.ranking_metrics(counts).first()
        assert curves.roc_auc(counts).first()["auc"] == found["auc"] == pytest.approx(0.75)
        assert curves.average_precision(counts).first()[1] == found["average_precision"] == pytest.approx(0.75 * 0.75 + 0.25 * 0.5)
    finally:
        curves.score_steps = real


def test_a_null_model_is_a_model_of_its_own(spark):
    rows = [(m, y, s) for m in ("a", None) for y, s in ((1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1))]
    df = spark.createDataFrame(rows, "model string, label int, score double")
    for found in (curves.roc_auc(df), curves.average_precision(df)):
        values = {r["model"]: r[1] for r in found.collect()}
        assert set(values) == {"a", None} and values["a"] == values[None]
    for found in (curves.roc_curve(df), curves.roc_curve(df, drop_collinear=True), curves.pr_curve(df), curves.score_histogram(df)):
        groups = {m: sorted(str(tuple(r)[1:]) for r in found.collect() if r["model"] == m) for m in ("a", None)}
        assert len(groups["a"]) > 1 and groups["a"] == groups[None]


def test_unknown_errors_are_never_best_and_no_target_is_lost(spark):
    metrics = spark.createDataFrame(
        [("t", "x", None, 1.0), ("t", "y", float("nan"), 1.0), ("t", "z", 2.0, 1.0), ("u", "x", None, 1.0), (None, "x", 3.0, 1.0)],
        "target string, model string, rmse double, mae double",
    )
    best = {r["target"]: r["best_model"] for r in evaluate.best_baseline(metrics).collect()}
    assert best == {"t": "z", "u": None, None: "x"}
    base = spark.createDataFrame([("t", "z", 2.0), (None, "x", 3.0)], "target string, best_model string, rmse double")
    out = evaluate.improvement_vs_baseline(metrics, base).collect()
    assert len(out) == 5 and {r["improvement_pct"] for r in out if r["target"] is None} == {0.0}


def test_an_infinite_training_value_gives_no_drift_score(spark):
    rows = [("train", float(i), float(i)) for i in range(50)] + [("train", float("inf"), 1.0)] + [("test", 100.0 + i, 100.0 + i) for i in range(20)]
    df = spark.createDataFrame(rows, "split string, bad double, good double")
    got = {r["feature"]: r["psi"] for r in drift.psi(df, ["bad", "good"]).collect()}
    assert got["bad"] is None and got["good"] > 0


def test_augmented_unit_root_test_is_least_squares(spark):
    rng = np.random.default_rng(31)
    rows, series = [], {}
    for name, weight in (("a", 0.3), ("b", 1.0), (None, 0.9)):
        x, change = [500.0], 0.0
        for _ in range(300):
            change = 0.5 * change + rng.normal() - (1 - weight) * (x[-1] - 500)
            x.append(x[-1] + change)
        series[name] = np.array(x)
        rows += [(name, pd.Timestamp("2020-01-01").date() + pd.Timedelta(days=i), float(v)) for i, v in enumerate(x)]
    rows += [("short", pd.Timestamp("2020-01-01").date() + pd.Timedelta(days=i), float(i)) for i in range(4)]
    df = spark.createDataFrame([(s, pd.Timestamp(d).date(), v) for s, d, v in rows], "series_id string, date date, value double")
    got = {r["series_id"]: r for r in evaluate.stationarity(df, lags=2, daily=True).collect()}
    for name, x in series.items():
        d = np.diff(x)
        design = np.column_stack([np.ones(len(d) - 2), x[2:-1], d[1:-1], d[:-2]])
        weights, rss, *_ = np.linalg.lstsq(design, d[2:], rcond=None)
        error = np.sqrt(rss[0] / (len(d) - 2 - 4) * np.linalg.inv(design.T @ design)[1, 1])
        assert got[name]["n"] == len(d) - 2
        assert got[name]["slope"] == pytest.approx(weights[1], rel=1e-6)
        assert got[name]["t_stat"] == pytest.approx(weights[1] / error, rel=1e-6)
    assert got["short"]["t_stat"] is None
