"""Column profiles: types, missing values, summary statistics with exact quartiles."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldwatch.functions.scalars import null_if_nan
from yieldwatch.operators.prefix import prefix_sums

QUARTILES = (0.25, 0.5, 0.75)
#: Size of the quantile sketches; their ranks are off by 0.3 % of the rows or less, nearly always.
SKETCH = 1000
#: Cells reach this far around a quartile.
MARGIN = 0.01
#: Relative standard deviation of the estimate of distinct values.
DISTINCT_ERROR = 0.02


def table_structure(df: DataFrame, table: str, distinct: bool = False) -> DataFrame:
    """One row per column: position, name, type, NULL count; with `distinct` an estimate of
    the distinct values, whose relative standard deviation is DISTINCT_ERROR. One pass over the table."""
    fields = df.schema.fields

    def column(i: int):
        f = fields[i]
        parts = [
            F.lit(table).alias("table_name"),
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.count_if(F.col(f.name).isNull()).alias("null_count"),
        ]
        if distinct:
            parts.append(F.approx_count_distinct(f.name, DISTINCT_ERROR).alias("approx_distinct"))
        return F.struct(*parts)

    return df.agg(F.array(*[column(i) for i in range(len(fields))]).alias("_c")).select(F.inline("_c"))


def _number(df: DataFrame, column: str) -> Column:
    return null_if_nan(df[column].cast("double"))


def _sketched(df: DataFrame, columns: Sequence[str]) -> list[dict]:
    """Per column: the plain statistics and, around each quartile, a cell (least, most) of
    values that should hold it. One pass, one row out, whatever the columns."""
    ranks = [min(max(q + side * MARGIN, 0.0), 1.0) for q in QUARTILES for side in (-1, 1)]

    def parts(i: int, c: str) -> list[Column]:
        x = _number(df, c)
        # A sketch orders finite values only; infinite ones are minimum and maximum.
        finite = F.when(F.abs(x) < float("inf"), x)
        wanted = F.array(*[F.lit(r) for r in ranks])
        sketch = F.kll_sketch_agg_double(finite, F.lit(SKETCH))
        found = F.when(F.count(finite) > 0, F.kll_sketch_get_quantile_double(sketch, wanted))
        return [
            F.count(x).alias(f"count_{i}"),
            F.avg(x).alias(f"mean_{i}"),
            F.stddev_samp(x).alias(f"std_{i}"),
            F.min(x).alias(f"min_{i}"),
            F.max(x).alias(f"max_{i}"),
            found.alias(f"cells_{i}"),
        ]

    row = df.agg(*[part for i, c in enumerate(columns) for part in parts(i, c)]).first()
    names = ("count", "mean", "std", "min", "max", "cells")
    return [{n: row[f"{n}_{i}"] for n in names} for i in range(len(columns))]


def _exact_quartiles(df: DataFrame, columns: Sequence[str], cells: dict[tuple[int, int], tuple]) -> dict:
    """(column, quartile) -> value, for those whose cell holds the ranks around the quartile.

    cells: (least, most, count) with the number of the column's known values. Values below a
    cell are counted in one pass; those inside are counted per value, and running counts find the two ranks.
    """
    keys = list(cells)
    outside = [F.count_if(_number(df, columns[i]) < F.lit(cells[i, k][0])).alias(f"below_{i}_{k}") for i, k in keys]
    below = df.agg(*outside).first()
    ranks = {(i, k): (cells[i, k][2] - 1) * QUARTILES[k] for i, k in keys}
    # Only what lies in a cell becomes a row.
    held = [
        F.when(
            _number(df, columns[i]).between(F.lit(cells[i, k][0]), F.lit(cells[i, k][1])),
            F.struct(F.lit(place).alias("cell"), _number(df, columns[i]).alias("value")),
        )
        for place, (i, k) in enumerate(keys)
    ]
    values = df.select(F.inline(F.array_compact(F.array(*held))))
    counts = values.groupBy("cell", "value").agg(F.count(F.lit(1)).alias("n"))
    running = prefix_sums(counts, ["cell"], "value", ["n"])
    # The two ranks around the quartile, counted from the cell's first value.
    starts = [below[f"below_{i}_{k}"] for i, k in keys]
    places = [
        F.struct(F.lit(math.floor(ranks[key]) - start).alias("low"), F.lit(math.ceil(ranks[key]) - start).alias("high"))
        for key, start in zip(keys, starts, strict=True)
    ]
    place = F.get(F.array(*places), F.col("cell"))
    first, last = F.col("before_n"), F.col("before_n") + F.col("n") - 1
    near = running.filter(place["low"].between(first, last) | place["high"].between(first, last))
    found: dict[int, dict] = {}
    # Two rows at most per column and quartile.
    for row in near.withColumn("place", place).collect():
        at = found.setdefault(row["cell"], {})
        for side in ("low", "high"):
            if row["before_n"] <= row["place"][side] <= row["before_n"] + row["n"] - 1:
                at[side] = row["value"]
    out = {}
    for number, key in enumerate(keys):
        at = found.get(number, {})
        if len(at) == 2:
            share = ranks[key] - math.floor(ranks[key])
            out[key] = at["low"] if share == 0 or at["low"] == at["high"] else at["low"] + (at["high"] - at["low"]) * share
    return out


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles (linear interpolation), max of each column.

    One row per column, in their order; a column without a known value has count 0 and NULLs.
    The quartiles are exact: a quantile sketch of each column, built in the pass that gives
    the plain statistics, bounds the cell that holds a quartile, and only the few values inside
    the cells are counted. Where a sketch missed, which the counts show, that column is
    counted whole. Runs jobs that read `df` three times, so it should read a table.
    """
    basics = _sketched(df, columns)
    quartiles: dict[tuple[int, int], float] = {}
    inf = float("inf")
    cells = {}
    for i, found in enumerate(basics):
        for k in range(len(QUARTILES)):
            if found["count"]:
                ends = found["cells"]
                cells[i, k] = (ends[2 * k], ends[2 * k + 1], found["count"]) if ends else (-inf, inf, found["count"])
    if cells:
        quartiles = _exact_quartiles(df, columns, cells)
        missed = {key: (-inf, inf, cells[key][2]) for key in cells if key not in quartiles}
        if missed:
            quartiles |= _exact_quartiles(df, columns, missed)
    rows = [
        (c, b["count"], b["mean"], b["std"], b["min"], *[quartiles.get((i, k)) for k in range(len(QUARTILES))], b["max"])
        for i, (c, b) in enumerate(zip(columns, basics, strict=True))
    ]
    schema = "column_name string, count bigint, mean double, std double, min double, q25 double, q50 double, q75 double, max double"
    return df.sparkSession.createDataFrame(rows, schema)
