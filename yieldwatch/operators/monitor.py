"""Monitoring tables: long predictions, the fact table, and the summary per model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldwatch.operators.drift import SIGNIFICANT
from yieldwatch.operators.evaluate import TARGET_MODEL, rolling_rmse, stability_index
from yieldwatch.operators.joins import join_summary
from yieldwatch.sources.scratch import settle

# The short spellings under which a model's column may be found.
ALIASES = {"xgboost": "xgb", "randomforest": "random"}


def prediction_column(columns: Sequence[str], model: str) -> str:
    """The prediction column of a model: by its name, else its alias, else the first one."""
    candidates = [c for c in columns if "pred" in c.lower() and "actual" not in c.lower()]
    name = model.lower()
    for wanted in (name, ALIASES.get(name)):
        for c in candidates:
            if wanted and wanted in c.lower():
                return c
    if candidates:
        return candidates[0]
    raise ValueError(f"no prediction column for {model}")


def predictions_long(df: DataFrame, models: Sequence[str], ids: Sequence[str] = ("date", "actual")) -> DataFrame:
    """ids, model, predicted: one row per row and model."""
    cells = F.array(
        *[
            F.struct(
                F.lit(m).alias("model"), F.col(prediction_column(df.columns, m)).cast("double").alias("predicted")
            )
            for m in models
        ]
    )
    return df.select(*ids, F.explode(cells).alias("_c")).select(*ids, "_c.*")


def forecast_vs_actual(predictions: DataFrame) -> DataFrame:
    """(target, model, date, actual, forecast): what a chart of both lines reads. Rows without a
    forecast stay, as gaps of its line."""
    return predictions.select("target", "model", "date", "actual", F.col("predicted").alias("forecast"))


def dashboard_fields(date: str = "date") -> dict[str, Column]:
    """Error and period columns of the fact table."""
    error = F.col("actual") - F.col("predicted")
    return {
        "error": error,
        "error_abs": F.abs(error),
        "year": F.year(date),
        "month": F.month(date),
        "quarter": F.quarter(date),
        "year_month": F.date_format(date, "yyyy-MM"),
    }


FACT_COLUMNS = (
    "target",
    "model",
    "date",
    "actual",
    "predicted",
    "error",
    "error_abs",
    "rolling_rmse",
    "stability_index",
    "overall_rmse",
    "year",
    "month",
    "quarter",
    "year_month",
)


def monitoring_fact(
    predictions: DataFrame, window: int = 30, daily: bool = False, date: str = "date"
) -> tuple[DataFrame, DataFrame]:
    """(fact, scores): 14 columns per prediction, and the numbers per (target, model).

    All targets and models are done in one plan. The rolling errors and the scores are stored
    once: the fact table and the summary both read them.
    """
    rolled = settle(rolling_rmse(predictions, TARGET_MODEL, date, window, daily))
    scores = settle(stability_index(rolled))
    constants = scores.select(*TARGET_MODEL, "stability_index", "overall_rmse")
    fact = join_summary(rolled, constants, TARGET_MODEL, stored=True).withColumns(dashboard_fields(date))
    return fact.select(*FACT_COLUMNS), scores


def monitoring_summary(scores: DataFrame, drift: DataFrame) -> DataFrame:
    """Nine fields per (target, model); the drift counts are the same for all of them."""
    counts = drift.agg(
        F.struct(
            F.count_if(F.col("drift_status") == SIGNIFICANT).alias("drifted"), F.count(F.lit(1)).alias("total")
        )
    ).scalar()
    drifted, total = F.col("_drift")["drifted"], F.col("_drift")["total"]
    return scores.withColumn("_drift", counts).select(
        *TARGET_MODEL,
        "overall_rmse",
        "mean_rolling_rmse",
        "std_rolling_rmse",
        "stability_index",
        drifted.alias("features_with_drift"),
        total.alias("total_features"),
        F.coalesce(F.try_divide(drifted.cast("double"), total), F.lit(0.0)).alias("drift_rate"),
    )
