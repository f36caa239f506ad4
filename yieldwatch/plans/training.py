"""Train, score, compare and save: rate regressors, customer classifiers, forecasts.

Model fits are Spark jobs that read the training rows many times, so the rows of all targets
are prepared once into the shared folder, and several fits run at a time over that table;
everything after the fits is one lazy plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldwatch.operators import models as m
from yieldwatch.operators.arma import forecast_arma
from yieldwatch.operators.curves import pr_curve, ranking_metrics, roc_curve
from yieldwatch.operators.evaluate import (
    best_auc_gate,
    best_baseline,
    importance_pct,
    improvement_vs_baseline,
    regression_metrics,
)
from yieldwatch.operators.forecast import CHANGEPOINTS, forecast_trend_season
from yieldwatch.operators.joins import join_null_safe, join_summary
from yieldwatch.operators.prepare import LABELS, behavioral_features, complete_rows
from yieldwatch.operators.split import split_dates, stratified_split
from yieldwatch.operators.trees import Trees
from yieldwatch.plans.together import WORKERS, run_together
from yieldwatch.sources.scratch import discard, release, settle
from yieldwatch.sources.writers import write_importance, write_metrics_json, write_predictions


@dataclass
class Regression:
    predictions: DataFrame
    metrics: DataFrame
    importance: DataFrame


@dataclass
class Classification:
    scores: DataFrame
    metrics: DataFrame
    gate: DataFrame

    def roc_curve(self) -> DataFrame:
        """(target, model, threshold, fpr, tpr) of all models."""
        return roc_curve(self.scores, ["target", "model"])

    def pr_curve(self) -> DataFrame:
        """(target, model, threshold, precision, recall) of all models."""
        return pr_curve(self.scores, ["target", "model"])


@dataclass
class Forecast:
    predictions: DataFrame
    metrics: DataFrame
    best: DataFrame


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def regressors(target: str, forest: Mapping | None = None, boosting: Mapping | None = None) -> dict[str, object]:
    """The two regressors; the mappings override their settings."""
    return {
        "RandomForest": m.rf_regressor(target, **(forest or {})),
        "GradientBoosting": m.gbt_regressor(target, **(boosting or {})),
    }


def train_eval_regress(
    features: DataFrame,
    targets: Sequence[str],
    raw_series: Sequence[str],
    estimators=regressors,
    baseline: DataFrame | None = None,
    test_size: float = 0.2,
    output: str | None = None,
    mode: str = "error",
    workers: int = WORKERS,
) -> Regression:
    """Fit each regressor on each target; the first 80 % of a target's complete dates train.

    All targets read one stored table, and `workers` fits run at a time; the models are those
    of fits in sequence. With `baseline` (best model per target) the metrics also show the
    improvement. With `output` the predictions, metrics and importances are written below that
    folder; `mode` is one of the writers'.
    """
    spark = features.sparkSession
    shared = [c for c in features.columns if c not in {*targets, *raw_series}]
    table = settle(features.select(*shared, *targets).na.drop(how="any", subset=shared))
    columns = {t: [c for c in table.columns if c not in {"date", t, *raw_series}] for t in targets}

    def split(target: str) -> tuple[DataFrame, DataFrame]:
        rows = table.select("date", *columns[target], target).na.drop(how="any")
        cutoff = split_dates(rows, (), "date", test_size).first()["cutoff"]
        late = F.coalesce(F.col("date") >= F.lit(cutoff), F.lit(False))
        return rows.filter(~late), rows.filter(late)

    def fit(target: str, name: str, estimator, rows: tuple[DataFrame, DataFrame]) -> tuple[DataFrame, DataFrame]:
        model = m.fit(rows[0], columns[target], estimator)
        scored = m.predict(model, rows[1], ["date"], target)
        ranked = importance_pct(m.feature_importance(spark, model, columns[target]))
        marks = (F.lit(target).alias("target"), F.lit(name).alias("model"))
        return settle(scored.select(*marks, "*")), ranked.select(*marks, "*")

    halves = dict(zip(targets, run_together(spark, [partial(split, t) for t in targets], workers), strict=True))
    wanted = [(t, name, estimator) for t in targets for name, estimator in estimators(t).items()]
    names = list(dict.fromkeys(name for _, name, _ in wanted))
    done = run_together(spark, [partial(fit, t, name, e, halves[t]) for t, name, e in wanted], workers)
    all_predictions = _union([predictions for predictions, _ in done])
    importance = _union([ranked for _, ranked in done])
    metrics = regression_metrics(all_predictions)
    result = Regression(
        all_predictions,
        improvement_vs_baseline(metrics, baseline) if baseline is not None else metrics,
        importance,
    )
    if output is not None:
        write_predictions(all_predictions, f"{output}/predictions", names, mode=mode)
        write_metrics_json(metrics, f"{output}/metrics", mode)
        write_importance(importance, f"{output}/importance", mode)
    return result


def classifiers(
    label: str,
    n_rows: int,
    logistic: Mapping | None = None,
    forest: Mapping | None = None,
    boosting: Mapping | None = None,
    sampled_boosting: Mapping | None = None,
) -> dict[str, object]:
    """The four classifiers; the mappings override their settings."""
    return {
        "LogisticRegression": m.logistic_classifier(label, n_rows, **(logistic or {})),
        "RandomForest": m.rf_classifier(label, **(forest or {})),
        "GradientBoosting": m.gbt_classifier(label, **(boosting or {})),
        "SampledBoosting": m.gbt_classifier_sub(label, **(sampled_boosting or {})),
    }


def train_eval_classify(
    behavior: DataFrame,
    labels: Sequence[str] = LABELS,
    key: str = "customer_id",
    estimators=classifiers,
    test_size: float = 0.2,
    output: str | None = None,
    mode: str = "error",
    workers: int = WORKERS,
) -> Classification:
    """Fit each classifier on each label and score the held-out customers.

    Categories are coded once for all labels; each label has its own split, with exact class
    shares; `workers` fits run at a time. `scores` has (target, model, key, label, score) and
    feeds the curve operators. The rows are stored once for each label, and what no later step
    reads is deleted: the features of all labels after the splits, trees and shuffles after each
    fit, the rows after the last.
    """
    spark = behavior.sparkSession
    labels = [c for c in labels if c in behavior.columns]
    table, columns = behavioral_features(behavior, labels, key=key)
    table = settle(table)

    def split(label: str) -> DataFrame:
        return settle(stratified_split(complete_rows(table, columns, label, key), key, label, test_size, stored=True))

    def fit(label: str, name: str, estimator) -> DataFrame:
        model = m.fit(train[label], columns, estimator)
        scored = m.positive_score(model, rows[label].filter("split = 'test'"), [key], label)
        scores = settle(scored.select(F.lit(label).alias("target"), F.lit(name).alias("model"), "*"))
        if isinstance(model, Trees):
            model.discard()
        release(spark)
        return scores

    rows = dict(zip(labels, run_together(spark, [partial(split, c) for c in labels], workers), strict=True))
    discard(table)
    train = {c: m.with_class_weight(rows[c].filter("split = 'train'"), c) for c in labels}
    wanted = [(c, name, estimator) for c in labels for name, estimator in estimators(c, train[c].count()).items()]
    all_scores = _union(run_together(spark, [partial(fit, c, name, e) for c, name, e in wanted], workers))
    for label in labels:
        discard(rows[label])
    metrics = ranking_metrics(all_scores, ["target", "model"])
    if output is not None:
        write_metrics_json(metrics, f"{output}/metrics", mode)
    return Classification(all_scores, metrics, best_auc_gate(metrics, ["target"]))


def train_eval_forecast(
    clean: DataFrame,
    test_size: float = 0.2,
    output: str | None = None,
    mode: str = "error",
    changepoints: int = CHANGEPOINTS,
) -> Forecast:
    """Both forecasts for every series of a clean daily calendar, all series in one plan.

    The models are ARMA with a seasonal term, its order chosen by AIC, and a trend with seasons
    whose slope may change at `changepoints` places.
    """
    cuts = settle(split_dates(clean, ["series_id"], "date", test_size))
    marked = join_summary(clean, cuts, ["series_id"], "left", stored=True)
    is_test = F.coalesce(F.col("date") >= F.col("cutoff"), F.lit(False))
    marked = settle(marked.select("series_id", "date", "value", is_test.alias("_test")))
    train = marked.filter(~F.col("_test")).drop("_test")
    test = marked.filter("_test").select("series_id", "date", F.col("value").alias("actual"))
    horizon = cuts.select("series_id", (F.col("n_rows") - F.col("n_train")).alias("horizon"))
    models = {
        "ARMA": forecast_arma(train, horizon, daily=True),
        "TrendSeason": forecast_trend_season(train, horizon, changepoints=changepoints),
    }
    columns = ("series_id", "date", "predicted")
    forecasts = _union([f.select(F.lit(name).alias("model"), *columns) for name, f in models.items()])
    predictions = join_null_safe(forecasts, test, ["series_id", "date"]).select(
        F.col("series_id").alias("target"), "model", "date", "actual", "predicted"
    )
    predictions = settle(predictions)
    metrics = regression_metrics(predictions)
    if output is not None:
        write_predictions(predictions, f"{output}/predictions", list(models), mode=mode)
        write_metrics_json(metrics, f"{output}/metrics", mode)
    return Forecast(predictions, metrics, best_baseline(metrics))
