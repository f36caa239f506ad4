"""Writers. Rows are rebalanced on the partition columns first: small files are merged and
the rows of a hot target are split over several tasks.

`mode` is one of Spark's, or `partitions`: the partitions (series, targets, models) that are
in the rows are replaced and all others stay, so a run can be repeated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

PARTITIONS = "partitions"


def _write(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str, mode: str) -> None:
    balanced = df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")
    writer = _with_mode(balanced.write, mode).partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def _with_mode(writer: DataFrameWriter, mode: str) -> DataFrameWriter:
    if mode == PARTITIONS:
        return writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    return writer.mode(mode)


def write_features(
    df: DataFrame, path: str, partition_by: Sequence[str] = ("series_id",), fmt: str = "parquet", mode: str = "error"
) -> None:
    """The feature table, one folder per series."""
    _write(df, path, partition_by, fmt, mode)


def predictions_wide(predictions: DataFrame, models: Sequence[str]) -> DataFrame:
    """(target, date, actual, <model>_pred...): one column per model."""
    wide = (
        predictions.groupBy("target", "date")
        .pivot("model", list(models))
        .agg(F.first("predicted").alias("predicted"), F.first("actual").alias("actual"))
    )
    actual = F.coalesce(*[F.col(f"`{m}_actual`") for m in models])
    return wide.select(
        "target", "date", actual.alias("actual"),
        *[F.col(f"`{m}_predicted`").alias(f"{m.lower()}_pred") for m in models],
    )


def write_predictions(
    predictions: DataFrame, path: str, models: Sequence[str], fmt: str = "parquet", mode: str = "error"
) -> None:
    """One folder per target with one column per model."""
    _write(predictions_wide(predictions, models), path, ["target"], fmt, mode)


def metrics_documents(metrics: DataFrame, keys: Sequence[str] = ("target",)) -> DataFrame:
    """(keys, json): {model: {RMSE, MAE}}, or {model: {AUC, Average Precision}}."""
    # The names of the metrics in the files.
    names = {"rmse": "RMSE", "mae": "MAE", "auc": "AUC", "average_precision": "Average Precision"}
    fields = F.struct(*[F.col(c).alias(name) for c, name in names.items() if c in metrics.columns])
    entries = F.sort_array(F.collect_list(F.struct(F.col("model"), fields.alias("metrics"))))
    return metrics.groupBy(*keys).agg(F.to_json(F.map_from_entries(entries), {"pretty": "true"}).alias("json"))


def write_metrics_json(metrics: DataFrame, path: str, mode: str = "error") -> None:
    """One metric document per target, in the folder `target=<name>`."""
    _with_mode(metrics_documents(metrics).write, mode).partitionBy("target").text(path, lineSep="\n")


def write_importance(importance: DataFrame, path: str, mode: str = "error") -> None:
    """Feature importances as CSV by target and model."""
    _write(importance, path, ["target", "model"], "csv", mode)


def write_dashboard(
    fact: DataFrame, drift: DataFrame, summary: DataFrame, path: str, fmt: str = "csv", mode: str = "error"
) -> None:
    """fact/ and summary/ by target and model, drift/ once for all of them (and so replaced whole)."""
    _write(fact, f"{path}/fact", ["target", "model"], fmt, mode)
    _write(drift, f"{path}/drift", [], fmt, mode)
    _with_mode(summary.write, mode).partitionBy("target", "model").json(f"{path}/summary")
