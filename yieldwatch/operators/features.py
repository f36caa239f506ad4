"""Lag, rolling, return and trend features of daily series.

Windows count rows, so on the uniform calendar they count days. By default the same-row
features (returns, differences, rolling statistics) include the value of their own row;
`leak_free=True` moves them one row back, so that row t only shows what was known before t.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yieldwatch.functions.calendar import calendar_columns
from yieldwatch.functions.scalars import null_if_nan
from yieldwatch.operators.halo import row_windows

LAGS = (1, 5, 10)
WINDOWS = (7, 30)
SERIES = ("series_id",)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """64-bit numeric columns, the ones used when no columns are named."""
    wanted = (T.DoubleType, T.LongType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, wanted) and f.name not in exclude]


def lags(value: str, w: WindowSpec, periods: Sequence[int] = LAGS) -> dict[str, Column]:
    return {f"lag{k}": F.lag(value, k).over(w) for k in periods}


def rolling(value: str, w: WindowSpec, windows: Sequence[int] = WINDOWS, shift: int = 0) -> dict[str, Column]:
    """Mean and sample deviation of the last n rows; shorter at the start of a series."""
    columns = {}
    for n in windows:
        frame = w.rowsBetween(1 - n - shift, -shift)
        columns[f"roll_mean_{n}"] = F.avg(value).over(frame)
        columns[f"roll_std_{n}"] = F.stddev_samp(value).over(frame)
    return columns


def changes(value: str, w: WindowSpec, shift: int = 0) -> dict[str, Column]:
    """Relative and absolute change from one row to the next; NULL on a zero base."""

    def back(k: int) -> Column:
        return F.lag(value, k).over(w) if k else F.col(value)

    relative = F.try_divide(back(shift), back(shift + 1)) - 1
    return {
        "return": relative,
        "return_lag1": F.try_divide(back(shift + 1), back(shift + 2)) - 1,
        "diff": back(shift) - back(shift + 1),
        "diff_pct": relative,
    }


def time_features(
    df: DataFrame,
    keys: Sequence[str] = SERIES,
    order: str = "date",
    value: str = "value",
    lag_periods: Sequence[int] = LAGS,
    rolling_windows: Sequence[int] = WINDOWS,
    leak_free: bool = False,
    daily: bool = False,
    drop_first: int = 0,
) -> DataFrame:
    """All value features of one column in a single window pass.

    `drop_first` leaves out that many rows at the start of each key. See `row_windows` for
    `daily`.
    """
    shift = 1 if leak_free else 0
    lookback = max([*lag_periods, *[n - 1 + shift for n in rolling_windows], 2 + shift, drop_first])

    def build(w: WindowSpec) -> dict[str, Column]:
        columns = {
            **lags(value, w, lag_periods),
            **rolling(value, w, rolling_windows, shift),
            **changes(value, w, shift),
        }
        if drop_first:
            columns["_seen"] = F.count(F.lit(1)).over(w.rowsBetween(-drop_first, -1))
        return columns

    known = df.withColumn(value, null_if_nan(F.col(value)))
    out = row_windows(known, keys, order, lookback, build, daily)
    if drop_first:
        out = out.filter(F.col("_seen") == drop_first).drop("_seen")
    if {7, 30} <= set(rolling_windows):
        out = out.withColumn("ma_crossover", F.col("roll_mean_7") - F.col("roll_mean_30"))
    return out


def drop_warmup(
    df: DataFrame,
    keys: Sequence[str] = SERIES,
    order: str = "date",
    rows: int = max(LAGS),
    daily: bool = False,
) -> DataFrame:
    """Drop the first `rows` rows of each key by position; NULLs elsewhere stay."""
    if rows <= 0:
        return df
    if not keys:
        return df.filter(F.col(order) >= _date_after(df, order, rows))
    seen = row_windows(
        df, keys, order, rows, lambda w: {"_seen": F.count(F.lit(1)).over(w.rowsBetween(-rows, -1))}, daily
    )
    return seen.filter(F.col("_seen") == rows).drop("_seen")


def _date_after(df: DataFrame, order: str, rows: int) -> Column:
    """The date after the first `rows` dates, or NULL; a subquery over a few sorted dates."""
    earliest = df.select(order).distinct().orderBy(order).limit(rows + 1)
    return earliest.agg(F.when(F.count(order) > rows, F.max(order))).scalar()


def all_features(
    df: DataFrame,
    keys: Sequence[str] = SERIES,
    order: str = "date",
    value: str = "value",
    lag_periods: Sequence[int] = LAGS,
    rolling_windows: Sequence[int] = WINDOWS,
    include_calendar: bool = True,
    leak_free: bool = False,
    daily: bool = False,
) -> DataFrame:
    """Value features of every series, calendar columns, warm-up rows dropped (long form)."""
    out = time_features(
        df,
        keys,
        order,
        value,
        lag_periods,
        rolling_windows,
        leak_free,
        daily,
        drop_first=max(lag_periods, default=0),
    )
    if include_calendar:
        out = out.withColumns(calendar_columns(F.col(order)))
    return out


def align_series(df: DataFrame, series: Sequence[str], order: str = "date", value: str = "value") -> DataFrame:
    """One column per series, joined on the date (a date missing in one series gives NULL)."""
    return df.groupBy(order).pivot("series_id", list(series)).agg(F.first(value))


def long_series(wide: DataFrame, series: Sequence[str] | None = None, order: str = "date") -> DataFrame:
    """(series_id, date, value) of the named columns, or of all 64-bit numeric ones."""
    names = list(series) if series is not None else numeric_columns(wide, [order])
    cells = [F.struct(F.lit(n).alias("series_id"), F.col(f"`{n}`").cast("double").alias("value")) for n in names]
    return wide.select(order, F.explode(F.array(*cells)).alias("_c")).select("_c.series_id", order, "_c.value")


def feature_table(
    df: DataFrame,
    series: Mapping[str, str],
    order: str = "date",
    value: str = "value",
    lag_periods: Sequence[int] = LAGS,
    rolling_windows: Sequence[int] = WINDOWS,
    include_calendar: bool = True,
    leak_free: bool = False,
    daily: bool = False,
) -> DataFrame:
    """The wide feature table: raw series, `<series>_<feature>` columns, calendar columns.

    `series` maps series ids to column names and fixes the column order.
    """
    long = time_features(df, SERIES, order, value, lag_periods, rolling_windows, leak_free, daily)
    features = [c for c in long.columns if c not in ("series_id", order, value)]
    names = list(series.values())
    # One struct per series keeps this at a single shuffle by date.
    wide = (
        long.replace(dict(series), subset=["series_id"])
        .groupBy(order)
        .pivot("series_id", names)
        .agg(F.first(F.struct(value, *features), ignorenulls=True))
    )
    max_lag = max(lag_periods, default=0)
    if max_lag:
        wide = wide.filter(F.col(order) >= _date_after(df, order, max_lag))
    wide = wide.select(
        order,
        *[F.col(f"`{name}`")[value].alias(name) for name in names],
        *[F.col(f"`{name}`")[c].alias(f"{name}_{c}") for name in names for c in features],
    )
    if include_calendar:
        wide = wide.withColumns(calendar_columns(F.col(order)))
    return wide


def sequences(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    keys: Sequence[str] = SERIES,
    order: str = "date",
    length: int = 30,
    daily: bool = False,
) -> DataFrame:
    """For each row after the first `length`: the earlier `length` rows and the row's target.

    `x` holds the earlier rows in date order, each as (date, [target, features...]).
    """
    vector = F.array(*[F.col(c).cast("double") for c in (target, *features)])

    def build(w: WindowSpec) -> dict[str, Column]:
        return {"x": F.collect_list(F.struct(F.col(order).alias("date"), vector.alias("v"))).over(
            w.rowsBetween(-length, -1)
        )}

    rows = row_windows(df.select(*keys, order, target, *features), keys, order, length, build, daily)
    return rows.filter(F.size("x") == length).select(*keys, order, "x", F.col(target).alias("y"))
