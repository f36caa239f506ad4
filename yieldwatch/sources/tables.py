"""Named tables: ingesting raw sources and reading the rate series back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ingest_tables(tables: Mapping[str, DataFrame], path: str | None = None) -> DataFrame:
    """Make each frame a table and return (table_name, count).

    With `path` the rows are written there as Parquet and the view reads them back;
    without, the view is over the source itself.
    """
    counts = None
    for name, df in tables.items():
        spark = df.sparkSession
        if path is not None:
            df.write.mode("error").parquet(f"{path}/{name}")
            df = spark.read.parquet(f"{path}/{name}")
        df.createOrReplaceTempView(f"`{name}`")
        part = df.agg(F.count(F.lit(1)).alias("count")).select(F.lit(name).alias("table_name"), "count")
        counts = part if counts is None else counts.unionByName(part)
    return counts


def load_rates(spark: SparkSession, series: Sequence[str]) -> DataFrame:
    """The series tables in long form: (series_id, date, value)."""
    out = None
    for name in series:
        part = spark.table(f"`{name}`").select(F.lit(name).alias("series_id"), "date", "value")
        out = part if out is None else out.unionByName(part)
    return out
