"""Readers and writers, forecasts, model training, plans, and the entry point."""

import datetime as dt
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks import fixtures as fx
from yieldwatch.operators import features, forecast, grid, models
from yieldwatch.operators.split import chrono_split
from yieldwatch.plans import monitoring, rates, training
from yieldwatch.sources import readers, scratch, tables, writers
from yieldwatch.sources.scratch import scratch_path

D = dt.date


def write(path, text):
    path.write_text(text)
    return str(path)


def test_rate_files_named_by_series(spark, tmp_path):
    write(tmp_path / "S1.csv", "date,S1\n2020-01-02 09:30:00.5,1.5\n2020-01-03,.\n2020-01-04,2\n")
    write(tmp_path / "S2.csv", ",S2\n2020-01-02,7\nbad,8\n2020-01-05,NaN\n")
    got = sorted(tuple(r) for r in readers.read_rates_csv(spark, str(tmp_path)).collect())
    assert got == [
        ("S1", dt.datetime(2020, 1, 2, 9, 30, 0, 500000), 1.5),
        ("S1", dt.datetime(2020, 1, 4), 2.0),
        ("S2", dt.datetime(2020, 1, 2), 7.0),
    ]


def test_wide_rates_file(spark, tmp_path):
    path = write(tmp_path / "clean.csv", "date,S1,S 2\n2020-01-02,1.5,2\n2020-01-03,,3\n")
    got = sorted((tuple(r) for r in readers.read_wide_rates_csv(spark, path, ["S1", "S 2"]).collect()), key=str)
    assert got == [("S 2", D(2020, 1, 2), 2.0), ("S 2", D(2020, 1, 3), 3.0), ("S1", D(2020, 1, 2), 1.5), ("S1", D(2020, 1, 3), None)]


def test_observations(spark, tmp_path):
    good = write(tmp_path / "g.json", json.dumps({"observations": [{"date": "2020-01-01", "value": "."}, {"date": "2020-01-02", "value": "1.25"}]}, indent=1))
    got = readers.read_observations(spark, {"S": good}).collect()
    assert [tuple(r) for r in got] == [("S", D(2020, 1, 2), 1.25)]
    bad = write(tmp_path / "b.json", json.dumps({"error_code": 400}))
    with pytest.raises(Exception, match="no observations found for series S"):
        readers.read_observations(spark, {"S": bad}).collect()


def test_prediction_file_with_the_date_twice(spark, tmp_path):
    path = write(tmp_path / "p.csv", "date,date,actual,random_forest_pred\n2020-01-01,2020-01-01,1.0,1.5\n")
    assert [tuple(r) for r in readers.read_predictions_csv(spark, path).collect()] == [(D(2020, 1, 1), 1.0, 1.5)]


def test_metric_documents_round_trip(spark, tmp_path):
    rows = [("t 1", "a", 1.5, 0.5), ("t 1", "b", 2.5, 1.0), ("u", "a", 3.0, 2.0)]
    metrics = spark.createDataFrame(rows, ["target", "model", "rmse", "mae"])
    path = str(tmp_path / "m")
    writers.write_metrics_json(metrics, path)
    assert sorted(tuple(r) for r in readers.read_metrics_json(spark, path).collect()) == rows
    auc = spark.createDataFrame([("t", "m", 0.7, 0.2)], ["target", "model", "auc", "average_precision"])
    assert json.loads(writers.metrics_documents(auc).first()["json"]) == {"m": {"AUC": 0.7, "Average Precision": 0.2}}


def test_tables(spark, tmp_path):
    frames = {n: spark.createDataFrame([(D(2020, 1, 1), v)], ["date", "value"]) for n, v in (("s-1", 1.0), ("s2", 2.0))}
    counts = tables.ingest_tables(frames, str(tmp_path / "t"))
    assert sorted(tuple(r) for r in counts.collect()) == [("s-1", 1), ("s2", 1)]
    assert sorted(tuple(r) for r in tables.load_rates(spark, ["s-1", "s2"]).collect()) == [("s-1", D(2020, 1, 1), 1.0), ("s2", D(2020, 1, 1), 2.0)]


def test_scratch_follows_the_session_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert path != scratch_path(spark, "x")
    if configured:
        assert path.startswith(configured)


def daily(spark, **series):
    rows = [(n, (pd.Timestamp("2018-01-01") + pd.Timedelta(days=i)).date(), float(v)) for n, s in series.items() for i, v in enumerate(s)]
    return spark.createDataFrame(rows, ["series_id", "date", "value"])


def horizons(spark, **h):
    return spark.createDataFrame(list(h.items()), ["series_id", "horizon"])


def test_ar_forecast_recovers_the_process(spark):
    rng = np.random.default_rng(0)
    x = [0.0, 0.0]
    for _ in range(1500):
        x.append(0.6 * x[-1] + 0.25 * x[-2] + rng.normal())
    x = np.array(x) + 50
    line = 3 + 0.5 * np.arange(400)
    df = daily(spark, ar=x, line=line, flat=[4.0] * 30, short=[1.0, 2.0])
    got = forecast.forecast_ar(df, horizons(spark, ar=200, line=10, flat=3, short=2), daily=True).toPandas()
    ar = got[got.series_id == "ar"].sort_values("step")
    # One step ahead as the true weights say, and in the long run the mean of the series.
    want = 50 + 0.6 * (x[-1] - 50) + 0.25 * (x[-2] - 50)
    assert ar.predicted.iloc[0] == pytest.approx(want, abs=0.25)
    assert ar.predicted.iloc[-1] == pytest.approx(x.mean(), abs=0.5)
    assert ar.date.iloc[0] == (pd.Timestamp("2018-01-01") + pd.Timedelta(days=len(x))).date()
    np.testing.assert_allclose(got[got.series_id == "line"].sort_values("step").predicted, 3 + 0.5 * np.arange(400, 410), atol=1e-5)
    np.testing.assert_allclose(got[got.series_id == "flat"].predicted, 4.0, atol=1e-6)
    assert list(got[got.series_id == "short"].predicted) == [2.0, 2.0]


def test_ar_moments_equal_direct_least_squares(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=800).cumsum() + 100
    row = forecast.ar_moments(daily(spark, s=x)).first()
    p, d, constant, weights = forecast._fit_ar(np.asarray(row["moments"]))
    assert row["centre"] == pytest.approx(x.mean())
    x = x - row["centre"]
    z = np.diff(x, n=d) if d else x
    n = row["moments"][0]
    y = z[-int(n):]
    lags = [z[len(z) - int(n) - k : len(z) - k] for k in range(1, p + 1)]
    design = np.column_stack([*([np.ones(int(n))] if d < 2 else []), *lags])
    direct = np.linalg.lstsq(design, y, rcond=None)[0] if design.size else np.zeros(0)
    np.testing.assert_allclose([*([constant] if d < 2 else []), *weights], direct, rtol=1e-6, atol=1e-8)


def test_trend_and_season_forecast_recovers_them(spark):
    t = np.arange(1200)
    day0 = (pd.Timestamp("2018-01-01") - pd.Timestamp("2000-01-01")).days
    y = 2 + 0.001 * t + np.sin(2 * np.pi * (t + day0) / 365.25) + 0.3 * np.cos(2 * np.pi * (t + day0) / 7)
    df = daily(spark, s=y[:1000])
    got = forecast.forecast_trend_season(df, horizons(spark, s=200)).orderBy("step").toPandas()
    np.testing.assert_allclose(got.predicted, y[1000:], atol=1e-6)


def test_forecast_run_over_all_series(spark, sf):
    clean = fx.rates(spark, sf)
    result = training.train_eval_forecast(clean)
    metrics = result.metrics.toPandas()
    assert len(metrics) == 10 and set(metrics.model) == {"ARMA", "TrendSeason"} and (metrics.rmse > 0).all()
    n_test = chrono_split(clean).filter("split = 'test'").count()
    assert result.predictions.count() == 2 * n_test
    assert result.best.count() == 5


def separable(spark, n=600):
    rng = np.random.default_rng(11)
    x = rng.normal(size=n)
    rows = [(f"C{i}", dt.datetime(2020, 1, 1), "Retail" if i % 2 else "Corporate", float(x[i]), float(rng.normal()), int(x[i] + rng.normal() * 0.3 > 1), int(x[i] < 0)) for i in range(n)]
    return spark.createDataFrame(
        rows, "customer_id string, date timestamp, customer_segment string, credit_score double, "
        "base_balance double, outflow_event int, early_repayment_event int",
    )


def test_classifiers_rank_separable_data(spark, tmp_path):
    small = {"trees": 5, "max_depth": 3}
    result = training.train_eval_classify(
        separable(spark),
        estimators=lambda label, n: training.classifiers(label, n, {"max_iter": 20}, small, small, small),
        output=str(tmp_path / "out"),
    )
    metrics = result.metrics.toPandas()
    assert len(metrics) == 8 and (metrics.auc > 0.85).all()
    assert all(r.validated for r in result.gate.collect())
    scores = result.scores.agg(F.min("score"), F.max("score")).first()
    assert 0 <= scores[0] and scores[1] <= 1
    for curve in (result.roc_curve(), result.pr_curve()):
        assert curve.select("target", "model").distinct().count() == 8


def test_class_weights_balance(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], ["y"])
    got = models.with_class_weight(df, "y").groupBy("y").agg(F.sum(models.WEIGHT)).collect()
    assert [r[1] for r in got] == [pytest.approx(2.0), pytest.approx(2.0)]


def test_many_training_rows_lie_in_even_parts(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(0, 400 * cores + 1, 1, cores + 1).select("id", (F.col("id") % 2).cast("double").alias("y"))
    assert models.in_even_parts(rows).rdd.getNumPartitions() == cores + 1  # few rows stay as they lie
    monkeypatch.setattr(models, "ROWS_PER_CORE", 100)
    even = models.in_even_parts(rows)
    sizes = [r[0] for r in even.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) == 2 * cores and max(sizes) - min(sizes) <= cores + 1
    assert sorted(r.id for r in even.collect()) == list(range(400 * cores + 1))
    model = models.fit(rows, ["id"], models.gbt_classifier("y", trees=1, max_depth=2))
    assert models.positive_score(model, rows, ["id"], "y").filter("score BETWEEN 0 AND 1").count() == 400 * cores + 1


def test_forest_keeps_the_places_of_rows(spark):
    """With them a level reads each row's place; without them it leads every row down every tree."""
    assert models.rf_classifier("y").getCacheNodeIds()
    rng = np.random.default_rng(5)
    rows = spark.createDataFrame([(float(x), int(x > 0), 1.0) for x in rng.normal(size=200)], f"x double, y int, {models.WEIGHT} double")
    model = models.fit(rows, ["x"], models.rf_classifier("y", trees=3))
    assert models.positive_score(model, rows, ["x"], "y").filter((F.col("score") > 0.5) == (F.col("label") == 1)).count() >= 195


def test_regressors_train_and_compare(spark):
    rng = np.random.default_rng(2)
    clean = daily(spark, p=rng.normal(size=200).cumsum() + 50, q=rng.normal(size=200).cumsum() + 20)
    table = rates.wide_features(clean, {"p": "p", "q": "q"})
    baseline = spark.createDataFrame([("p", "naive", 5.0, 4.0)], ["target", "best_model", "rmse", "mae"])
    small = {"trees": 3, "max_depth": 3}
    result = training.train_eval_regress(table, ["p"], ["p", "q"], lambda t: training.regressors(t, small, small), baseline)
    assert set(result.metrics.columns) >= {"rmse", "mae", "improvement_pct"}
    assert result.predictions.count() == 2 * 38
    shares = result.importance.groupBy("model").agg(F.sum("importance_pct")).collect()
    assert [r[1] for r in shares] == [pytest.approx(100), pytest.approx(100)]


def test_dashboards_write_and_cover_every_pair(spark, sf, tmp_path):
    clean = fx.rates(spark, sf)
    board = monitoring.all_dashboards(
        rates.series_predictions(clean), rates.wide_features(clean, fx.SERIES), daily=True, output=str(tmp_path / "d")
    )
    summary = spark.read.json(str(tmp_path / "d" / "summary"))
    assert summary.count() == 10 and summary.filter("total_features = 79").count() == 10
    one = monitoring.monitoring_dashboard(
        rates.series_predictions(clean), rates.wide_features(clean, fx.SERIES), "5-LOW", "naive", daily=True
    )
    assert one.fact.select("target", "model").distinct().count() == 1
    assert len(board.fact.columns) == 14


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_plan_has_one_window_per_chunk_and_no_single_partition(spark, sf):
    plan = plan_of(rates.wide_features(fx.rates(spark, sf), fx.SERIES))
    assert "SinglePartition" not in plan
    long = plan_of(entry.queries()["all_features"](spark, sf))
    assert "SinglePartition" not in long
    assert long.count("+- Window") == 2  # the calendar gaps, and all features together


def test_running_counts_never_window_over_a_whole_key(spark, sf):
    from yieldwatch.operators.curves import score_steps

    plan = plan_of(score_steps(fx.scored(spark, sf)))
    for line in plan.splitlines():
        if "Window" in line and "score" in line:
            assert "_bucket" in line


def test_filters_reach_the_scan(spark, sf):
    plan = plan_of(entry.queries()["sql_date_from"](spark, sf))
    assert "TakeOrderedAndProject" in plan
    scan = fx.table(spark, sf, "orders").filter(F.col("o_orderdate") >= F.lit(dt.datetime(1997, 1, 1))).select("o_orderkey")
    assert "GreaterThanOrEqual(o_orderdate" in plan_of(scan)


def test_entry_runs(spark):
    out = entry.entry(spark)
    assert out.columns[:3] == ["series_id", "date", "value"] and out.count() > 0


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 95


def test_columns_are_read_by_name(spark, tmp_path):
    write(tmp_path / "wide.csv", "extra,DFF,date,DGS10\nx,1.5,2020-01-02,2.5\n")
    got = readers.read_wide_rates_csv(spark, str(tmp_path / "wide.csv"), ["DGS10", "DFF"]).collect()
    assert sorted(tuple(r) for r in got) == [("DFF", D(2020, 1, 2), 1.5), ("DGS10", D(2020, 1, 2), 2.5)]
    with pytest.raises(ValueError, match="DGS30"):
        readers.read_wide_rates_csv(spark, str(tmp_path / "wide.csv"), ["DGS30"])
    names = [c.split()[0] for c in readers.BEHAVIORAL_SCHEMA.split(", ")]
    values = {n: "1" for n in names} | {"outflow_event": "1", "early_repayment_event": "0", "date": "2020-01-02 00:00:00", "customer_id": "c", "credit_score": "NaN"}
    order = names[::-1] + ["more"]
    write(tmp_path / "customers.csv", ",".join(order) + "\n" + ",".join(values.get(n, "9") for n in order) + "\n")
    row = readers.read_behavioral_csv(spark, str(tmp_path / "customers.csv")).first()
    assert row.asDict().keys() == set(names)
    assert (row["outflow_event"], row["early_repayment_event"], row["customer_id"], row["credit_score"]) == (1, 0, "c", None)


def test_numeric_columns_are_the_default_series(spark):
    wide = spark.createDataFrame([(D(2020, 1, 1), 1.0, 2, "x")], "date date, a double, b bigint, c string")
    assert sorted(tuple(r) for r in features.long_series(wide).collect()) == [("a", D(2020, 1, 1), 1.0), ("b", D(2020, 1, 1), 2.0)]
    assert features.long_series(wide, ["b"]).count() == 1


def test_the_model_order_does_not_depend_on_the_level(spark):
    rng = np.random.default_rng(21)
    noise, x = rng.normal(scale=0.01, size=3000), np.zeros(3000)
    for i in range(1, 3000):
        x[i] = 0.5 * x[i - 1] + noise[i]
    levels = {f"l{int(level)}": x + level for level in (0, 1000, 1e6)}
    got = forecast.forecast_ar(daily(spark, **levels), horizons(spark, **{k: 1 for k in levels}), daily=True).collect()
    assert {(r["p"], r["d"]) for r in got} == {(1, 0)}
    for r in got:
        assert r["predicted"] - levels[r["series_id"]][-1] == pytest.approx(-0.5 * x[-1], abs=2e-3)


def test_unknown_values_leave_gaps_and_not_nulls(spark):
    rng = np.random.default_rng(22)
    rows = [("a", D(2018, 1, 1) + dt.timedelta(i), None if i % 50 == 49 else float(v)) for i, v in enumerate(rng.normal(5, 1, 600))]
    df = spark.createDataFrame(rows, "series_id string, date date, value double")
    got = forecast.forecast_ar(df, horizons(spark, a=3), daily=True).collect()
    assert len(got) == 3 and all(abs(r["predicted"] - 5) < 2 for r in got)


def test_intermediate_tables_need_a_shared_folder_off_local_mode(spark, monkeypatch):
    class Context:
        master, applicationId = "spark://somewhere:7077", "app"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.shared_dir(Session())
    scratch.settle(spark.range(3))
    assert scratch.clean_up(spark)
