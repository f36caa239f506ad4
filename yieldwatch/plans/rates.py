"""From raw observations to the feature table."""

from __future__ import annotations

import datetime
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yieldwatch.operators.audit import lookahead_audit
from yieldwatch.operators.features import all_features, feature_table
from yieldwatch.operators.grid import uniform_calendar
from yieldwatch.operators.halo import row_windows
from yieldwatch.sources.readers import read_rates_csv
from yieldwatch.sources.writers import write_features


def preprocess_rates(observations: DataFrame, ts: str = "ts", leading: str = "backfill") -> DataFrame:
    """(series_id, date, value): every calendar day, as-of filled, leading gap backfilled."""
    return uniform_calendar(observations, "series_id", ts, "value", leading)


def engineer_features(spark: SparkSession, input_path: str, output_path: str, leak_free: bool = False) -> DataFrame:
    """Read rate files, clean them, build all features, write them; returns the table."""
    clean = preprocess_rates(read_rates_csv(spark, input_path))
    table = all_features(clean, leak_free=leak_free, daily=True)
    write_features(table, output_path)
    return spark.read.schema(table.schema).parquet(output_path)


def wide_features(clean: DataFrame, series: Mapping[str, str], leak_free: bool = False) -> DataFrame:
    """The wide feature table of a clean daily calendar."""
    return feature_table(clean, series, leak_free=leak_free, daily=True)


def audit_features(clean: DataFrame, until: datetime.date, leak_free: bool = False) -> DataFrame:
    """Which feature columns change before `until` when later rows are taken away."""
    return lookahead_audit(clean, lambda rows: all_features(rows, leak_free=leak_free, daily=True), until)


def series_predictions(clean: DataFrame) -> DataFrame:
    """Rule-of-thumb forecasts (target, date, model, actual, predicted) of a clean calendar:
    the value of the day before, and the mean of the seven days before."""
    rows = row_windows(
        clean,
        ["series_id"],
        "date",
        7,
        lambda w: {
            "_naive": F.lag("value").over(w),
            "_ma7": F.avg("value").over(w.rowsBetween(-7, -1)),
        },
        daily=True,
    )
    cells = F.array(
        F.struct(F.lit("naive").alias("model"), F.col("_naive").alias("predicted")),
        F.struct(F.lit("ma7").alias("model"), F.col("_ma7").alias("predicted")),
    )
    return (
        rows.select(F.col("series_id").alias("target"), "date", F.col("value").alias("actual"), F.explode(cells).alias("_c"))
        .select("target", "date", "_c.model", "actual", "_c.predicted")
        .na.drop()
    )
