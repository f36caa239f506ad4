"""Exact class shares, fits that run together, tables laid out for windows, runs that are repeated."""

import datetime as dt
import hashlib
import math
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from yieldwatch.operators import features, select, split
from yieldwatch.operators.evaluate import rolling_rmse
from yieldwatch.operators.halo import row_windows, rows_of, store_framed
from yieldwatch.plans import training
from yieldwatch.plans.together import run_together
from yieldwatch.sources import readers, writers
from yieldwatch.sources.scratch import scratch_path, settle

D = dt.date


# --- exact shares -----------------------------------------------------------------------


def plain_split(rows, share=0.8):
    """{(id, label): 'train' | 'test'} for unique ids."""
    out = {}
    for label in {r[1] for r in rows}:
        own = sorted((hashlib.md5(f"{i}:42".encode()).hexdigest(), i) for i, y in rows if y == label)
        for place, (_, i) in enumerate(own):
            out[i, label] = "train" if place < math.floor(len(own) * share) else "test"
    return out


@pytest.mark.parametrize("partitions", [1, 7])
def test_each_class_has_its_exact_share(spark, partitions):
    rows = [(f"c{i}", [0, 0, 0, 1, None, 2][i % 6]) for i in range(3001)] + [("lone", 9), ("a", 8), ("b", 8)]
    df = spark.createDataFrame(rows, "id string, y int").repartition(partitions)
    got = {(r["id"], r["y"]): r["split"] for r in split.stratified_split(df, "id", "y").collect()}
    assert got == plain_split(rows)
    assert got["lone", 9] == "test"


def test_equal_rows_at_the_cut_are_split_between_both_sides(spark):
    rows = [("same", 1, 5)] * 1000 + [(None, 1, 7)] * 500 + [(None, None, i) for i in range(11)]
    out = split.stratified_split(spark.createDataFrame(rows, "id string, y int, x int"), "id", "y")
    counts = {(r["y"], r["split"]): r["count"] for r in out.groupBy("y", "split").count().collect()}
    assert counts == {(1, "train"): 1200, (1, "test"): 300, (None, "train"): 8, (None, "test"): 3}
    assert out.columns == ["id", "y", "x", "split"] and out.groupBy("x").count().count() == 11


def test_split_of_no_rows(spark):
    df = spark.createDataFrame([], "id string, y int")
    assert split.stratified_split(df, "id", "y").count() == 0


def test_kth_smallest_by_digits(spark, monkeypatch):
    monkeypatch.setattr(select, "FEW", 3)
    rng = np.random.default_rng(1)
    rows = [(g, format(int(v), "08x")) for g in ("a", "b", None) for v in rng.integers(0, 2**32, 500) // 2**20 * 2**20]
    df = settle(spark.createDataFrame(rows, "g string, h string"))
    wanted = spark.createDataFrame([("a", 1), ("b", 250), (None, 500)], "g string, k int")
    got = {r["g"]: (r["cut"], r["keep"], r["equal"]) for r in select.kth_smallest(df, ["g"], "h", 8, wanted).collect()}
    for g, k in (("a", 1), ("b", 250), (None, 500)):
        own = sorted(h for x, h in rows if x == g)
        cut = own[k - 1]
        assert got[g] == (cut, k - sum(h < cut for h in own), own.count(cut))


# --- fits together ----------------------------------------------------------------------


def test_calls_run_together_in_order_and_pass_errors_on(spark):
    meet = threading.Barrier(3, timeout=20)

    def call(i):
        meet.wait()
        return i, spark.range(i + 1).count()

    assert run_together(spark, [lambda i=i: call(i) for i in range(3)], 3) == [(0, 1), (1, 2), (2, 3)]
    assert run_together(spark, [lambda: 5], 4) == [5] and run_together(spark, [], 4) == []
    with pytest.raises(ZeroDivisionError):
        run_together(spark, [lambda: 1 / 0, lambda: 2], 2)


def separable(spark, n=400):
    rng = np.random.default_rng(11)
    x = rng.normal(size=n)
    rows = [
        (f"C{i}", dt.datetime(2020, 1, 1), "Retail" if i % 2 else "Corporate", float(x[i]), float(rng.normal()),
         int(x[i] + rng.normal() * 0.3 > 1), int(x[i] < 0) if i % 50 else None)
        for i in range(n)
    ]
    return spark.createDataFrame(
        rows, "customer_id string, date timestamp, customer_segment string, credit_score double, "
        "base_balance double, outflow_event int, early_repayment_event int",
    )


def test_fits_together_give_the_models_of_fits_in_sequence(spark):
    small = {"trees": 4, "max_depth": 3}

    def run(workers):
        result = training.train_eval_classify(
            separable(spark),
            estimators=lambda label, n: training.classifiers(label, n, {"max_iter": 10}, small, small, small),
            workers=workers,
        )
        return {(r["target"], r["model"], r["customer_id"]): r["score"] for r in result.scores.collect()}

    one, four = run(1), run(4)
    assert one.keys() == four.keys()
    assert all(one[k] == pytest.approx(four[k], abs=1e-9) for k in one)
    # Each label's test rows: what its classes leave of 400 and 392 customers.
    for label, known in (("outflow_event", 400), ("early_repayment_event", 392)):
        tested = {k[2] for k in one if k[0] == label}
        assert known * 0.2 <= len(tested) <= known * 0.2 + 2


def test_regressors_of_all_targets_share_one_table(spark):
    from yieldwatch.plans import rates

    rng = np.random.default_rng(2)
    dates = [D(2020, 1, 1) + dt.timedelta(i) for i in range(160)]
    rows = [(s, d, float(v)) for s in ("p", "q") for d, v in zip(dates, rng.normal(size=160).cumsum() + 50)]
    table = rates.wide_features(spark.createDataFrame(rows, "series_id string, date date, value double"), {"p": "p", "q": "q"})
    small = {"trees": 3, "max_depth": 3}

    def run(workers, targets):
        made = lambda t: training.regressors(t, small, small)
        result = training.train_eval_regress(table, targets, ["p", "q"], made, workers=workers)
        return {(r["target"], r["model"], r["date"]): r["predicted"] for r in result.predictions.collect()}

    both, alone = run(4, ["p", "q"]), run(1, ["q"])
    assert {k: v for k, v in both.items() if k[0] == "q"} == pytest.approx(alone)
    assert len(both) == 4 * 30


# --- tables laid out for windows ----------------------------------------------------------


def rates_table(spark, days=900):
    rng = np.random.default_rng(5)
    rows = [
        (s, D(2019, 6, 1) + dt.timedelta(i), float(v), float(v) + 1)
        for s in ("a", "b", None)
        for i, v in enumerate(rng.normal(size=days).cumsum() + 100)
    ]
    return spark.createDataFrame(rows, "series_id string, date date, value double, other double")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("daily", [True, False])
def test_features_over_a_framed_table_need_no_exchange(spark, daily):
    df = rates_table(spark)
    path = scratch_path(spark, "framed")
    stored = store_framed(df, "framed_" + path[-32:], ["series_id"], "date", 30, 4, daily, path)
    made = features.all_features(stored, daily=daily)
    assert "Exchange" not in plan_of(made) and "Window" in plan_of(made)
    want = features.all_features(df, daily=daily)
    assert made.columns == want.columns
    assert sorted(map(str, made.collect())) == sorted(map(str, want.collect()))
    assert sorted(map(str, rows_of(stored).collect())) == sorted(map(str, df.collect()))


def test_rolling_error_over_a_framed_table_needs_no_exchange(spark):
    df = rates_table(spark).withColumnsRenamed({"series_id": "target", "value": "actual", "other": "predicted"}).withColumn("model", F.lit("m"))
    path = scratch_path(spark, "framed")
    stored = store_framed(df, "framed_" + path[-32:], ["target", "model"], "date", 29, 4, True, path)
    rolled = rolling_rmse(stored, daily=True)
    assert "Exchange" not in plan_of(rolled)
    assert sorted(map(str, rolled.select(sorted(rolled.columns)).collect())) == sorted(
        map(str, (want := rolling_rmse(df, daily=True)).select(sorted(want.columns)).collect())
    )


def test_longer_windows_than_a_framed_table_holds_are_framed_anew(spark):
    df = rates_table(spark, 500)
    path = scratch_path(spark, "framed")
    stored = store_framed(df, "framed_" + path[-32:], ["series_id"], "date", 3, 4, True, path)
    build = lambda w: {"back": F.lag("value", 20).over(w)}
    got = row_windows(stored, ["series_id"], "date", 20, build, True)
    assert sorted(map(str, got.collect())) == sorted(map(str, row_windows(df, ["series_id"], "date", 20, build, True).collect()))


# --- repeated runs --------------------------------------------------------------------


def test_a_repeated_run_replaces_its_partitions_only(spark, tmp_path):
    path = str(tmp_path / "out")

    def rows(target, predicted):
        return spark.createDataFrame([(target, "m", D(2020, 1, i + 1), 1.0, predicted + i) for i in range(3)], "target string, model string, date date, actual double, predicted double")

    for target, predicted in (("a", 1.0), ("b", 5.0), ("a", 7.0), ("a", 7.0)):
        writers.write_predictions(rows(target, predicted), path, ["m"], mode="partitions")
    got = sorted((r["target"], r["m_pred"]) for r in spark.read.parquet(path).collect())
    assert got == [("a", 7.0), ("a", 8.0), ("a", 9.0), ("b", 5.0), ("b", 6.0), ("b", 7.0)]

    metrics = str(tmp_path / "metrics")
    for target, rmse in (("a", 1.0), ("b", 2.0), ("a", 3.0)):
        frame = spark.createDataFrame([(target, "m", rmse, 0.5)], "target string, model string, rmse double, mae double")
        writers.write_metrics_json(frame, metrics, "partitions")
    assert sorted((r["target"], r["rmse"]) for r in readers.read_metrics_json(spark, metrics).collect()) == [("a", 3.0), ("b", 2.0)]


def test_dashboards_can_be_written_again(spark, tmp_path):
    path = str(tmp_path / "d")

    def parts(target):
        fact = spark.createDataFrame([(target, "m", 1.0)], "target string, model string, error double")
        drift = spark.createDataFrame([("f", 0.5)], "feature string, drift_score double")
        summary = spark.createDataFrame([(target, "m", 2)], "target string, model string, total_features int")
        return fact, drift, summary

    for target in ("a", "b", "a"):
        writers.write_dashboard(*parts(target), path, mode="partitions")
    assert spark.read.option("header", True).csv(f"{path}/fact").count() == 2
    assert spark.read.option("header", True).csv(f"{path}/drift").count() == 1
    assert spark.read.json(f"{path}/summary").count() == 2


def test_a_file_with_the_value_first_is_an_error(spark, tmp_path):
    (tmp_path / "S.csv").write_text("S,date\n1.5,2020-01-02\n2.5,2020-01-03\n")
    with pytest.raises(Exception, match="not the first column"):
        readers.read_rates_csv(spark, str(tmp_path / "S.csv")).collect()
