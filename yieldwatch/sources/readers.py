"""Readers with fixed schemas: rate and customer CSV, observation and metric JSON."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yieldwatch.functions.scalars import null_if_nan

BEHAVIORAL_SCHEMA = (
    "date TIMESTAMP_NTZ, customer_id STRING, customer_segment STRING, account_age_months INT, "
    "base_balance DOUBLE, balance_volatility DOUBLE, seasonal_factor DOUBLE, interest_rate_level DOUBLE, "
    "economic_stress DOUBLE, market_volatility DOUBLE, num_products INT, transaction_frequency DOUBLE, "
    "credit_score DOUBLE, outflow_probability DOUBLE, outflow_event INT, "
    "early_repayment_probability DOUBLE, early_repayment_event INT"
)
OBSERVATIONS = "observations ARRAY<STRUCT<date: STRING, value: STRING>>"
METRICS = "MAP<STRING, STRUCT<RMSE: DOUBLE, MAE: DOUBLE>>"


def _number(text: Column) -> Column:
    """A number, or NULL where the text is none (or says NaN)."""
    return null_if_nan(text.try_cast("double"))


def _by_name(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """The named columns of CSV files as text, in any order of the header; a missing one is an error.

    All files must have the header of the first, in the same order; another one is an error too.
    """
    raw = spark.read.csv(path, header=True, enforceSchema=False)
    missing = [n for n in names if n not in raw.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return raw.select(*[F.col(f"`{n}`") for n in names])


def read_rates_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(series_id, ts, value) from files with a date column and one value column.

    The series is named by the folder `series_id=<name>`, or else by the file name. Rows
    without a readable date or number are left out. A file with the value before the date is an error.
    """
    paths = [path] if isinstance(path, str) else list(path)
    # Each file names its value column as it likes, so the two columns are taken in their order.
    raw = spark.read.csv(paths, header=True, schema="ts STRING, value STRING", enforceSchema=True)
    location = F.col("_metadata.file_path")
    folder = F.regexp_extract(location, r"/series_id=([^/]+)/", 1)
    file = F.regexp_extract(location, r"([^/]+?)(\.csv)?(\.gz)?$", 1)
    series = F.url_decode(F.when(folder != "", folder).otherwise(file))
    number, date = F.col("value").try_cast("double"), F.col("value").try_cast("timestamp_ntz")
    swapped = number.isNull() & date.isNotNull() & F.col("ts").try_cast("double").isNotNull()
    wrong = F.raise_error(F.concat(F.lit("the date is not the first column of "), location)).cast("timestamp_ntz")
    ts = F.when(swapped, wrong).otherwise(F.col("ts").try_cast("timestamp_ntz"))
    return raw.select(series.alias("series_id"), ts.alias("ts"), _number(F.col("value")).alias("value")).na.drop()


def read_wide_rates_csv(spark: SparkSession, path: str, series: Sequence[str]) -> DataFrame:
    """(series_id, date, value) from files with a date and one column per series, found by name."""
    raw = _by_name(spark, path, ["date", *series])
    cells = F.array(*[F.struct(F.lit(s).alias("series_id"), _number(F.col(f"`{s}`")).alias("value")) for s in series])
    return raw.select(F.col("date").try_cast("date").alias("date"), F.explode(cells).alias("_c")).select(
        "_c.series_id", "date", "_c.value"
    )


def read_behavioral_csv(spark: SparkSession, path: str) -> DataFrame:
    """The customer table, its columns found by name; other columns are left out. NaN becomes
    NULL, and so does what is no value of the column's type."""
    fields = T.StructType.fromDDL(BEHAVIORAL_SCHEMA).fields
    text = _by_name(spark, path, [f.name for f in fields])
    rows = text.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields])
    doubles = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return rows.withColumns({c: null_if_nan(F.col(c)) for c in doubles})


def parse_observations(documents: DataFrame, json: str = "json", series: str = "series_id") -> DataFrame:
    """(series, date, value) from JSON documents with an `observations` array.

    Values that are no numbers are left out; a document without the array is an error.
    """
    parsed = F.from_json(json, OBSERVATIONS)["observations"]
    missing = F.raise_error(F.concat(F.lit("no observations found for series "), F.col(series)))
    rows = documents.select(series, F.explode(F.coalesce(parsed, missing.cast(T.ArrayType(
        T.StructType().add("date", "string").add("value", "string"))))).alias("_o"))
    return rows.select(
        series, F.col("_o.date").try_cast("date").alias("date"), _number(F.col("_o.value")).alias("value")
    ).na.drop()


def read_observations(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Observation documents, one path per series id."""
    out = None
    for series_id, path in paths.items():
        text = spark.read.text(path, wholetext=True)
        part = text.select(F.lit(series_id).alias("series_id"), F.col("value").alias("json"))
        out = part if out is None else out.unionByName(part)
    return parse_observations(out)


def read_predictions_csv(spark: SparkSession, path: str) -> DataFrame:
    """A prediction file, whose header may name the date twice; numbers as double."""
    raw = spark.read.csv(path, header=True)
    # A repeated name gets its position appended by the reader.
    dates = [c for c in raw.columns if c.rstrip("0123456789") == "date"]
    others = [c for c in raw.columns if c not in dates]
    return raw.select(
        F.col(dates[0]).try_cast("date").alias("date"), *[_number(F.col(f"`{c}`")).alias(c) for c in others]
    )


def parse_metrics(documents: DataFrame, json: str = "json", keys: Sequence[str] = ("target",)) -> DataFrame:
    """(keys, model, rmse, mae) from {model: {RMSE, MAE}} documents."""
    return documents.select(*keys, F.explode(F.from_json(json, METRICS)).alias("model", "_m")).select(
        *keys, "model", F.col("_m.RMSE").alias("rmse"), F.col("_m.MAE").alias("mae")
    )


def read_metrics_json(spark: SparkSession, path: str) -> DataFrame:
    """Metric documents below `path`, one folder `target=<name>` per target."""
    text = spark.read.text(path, wholetext=True)
    return parse_metrics(text.withColumnRenamed("value", "json"))
