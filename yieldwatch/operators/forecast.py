"""Forecasts of many series at once: autoregression, and trend with seasons.

Both are linear models. Spark reduces each series to the sums its normal equations need;
only those sums, a few dozen numbers per series, reach the small solver. No task ever holds
the rows of a series.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yieldwatch.functions.scalars import null_if_nan
from yieldwatch.operators.halo import row_windows
from yieldwatch.operators.joins import join_null_safe, join_summary

MAX_P, MAX_D = 5, 2
_LOOKBACK = MAX_P + MAX_D
STEP_BLOCK = 10_000
MOST_HELD = 1_000  # series whose sums a task holds at once

YEAR, WEEK = 365.25, 7.0
YEARLY_TERMS, WEEKLY_TERMS = 10, 3
# Number of places where the trend may bend, and the part of the history they are in.
CHANGEPOINTS, CHANGE_SPAN = 25, 0.8
PENALTY = 0.05  # of the price from which on no slope changes
DESCENTS = 500
_ORIGIN = "2000-01-01"


# --- autoregression -------------------------------------------------------------------


def ar_moments(
    train: DataFrame, key: str = "series_id", order: str = "date", value: str = "value", daily: bool = False
) -> DataFrame:
    """Per series: all products of (1, previous value, this change, 6 earlier changes), and the
    mean that is subtracted from the values, which keeps the sums free of cancellation.

    Every AR(p <= 5) model on the values, changes or changes of changes is a linear map of
    these, so one pass serves all of them, on the same rows: those whose values and
    earlier values are all known.
    """

    def build(w) -> dict[str, Column]:
        def back(k: int) -> Column:
            return F.lag(value, k).over(w) if k else F.col(value)

        return {"_u1": back(1), **{f"_u{k + 2}": back(k) - back(k + 1) for k in range(_LOOKBACK)}}

    means = train.groupBy(key).agg(F.avg(null_if_nan(F.col(value))).alias("centre"))
    centred = join_summary(train.select(key, order, value), means, [key])
    centred = centred.withColumn(value, null_if_nan(F.col(value)) - F.col("centre"))
    rows = row_windows(centred, [key], order, _LOOKBACK, build, daily)
    terms = [F.lit(1.0), *[F.col(f"_u{i}") for i in range(1, _LOOKBACK + 2)]]
    complete = rows.filter(reduce(lambda a, b: a & b, [t.isNotNull() for t in terms[1:]]))
    size = len(terms)
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    sums = complete.groupBy(key, "centre").agg(*[F.sum(terms[i] * terms[j]).alias(f"_s{i}_{j}") for i, j in pairs])
    return sums.select(key, "centre", F.array(*[f"_s{i}_{j}" for i, j in pairs]).alias("moments"))


def last_values(
    train: DataFrame, key: str = "series_id", order: str = "date", value: str = "value", n: int = _LOOKBACK + 1
) -> DataFrame:
    """The last n known values of each series in date order, and the date of the last one."""
    recent = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))
    known = train.select(key, order, value).filter(null_if_nan(F.col(value)).isNotNull())
    tail = known.withColumn("_r", recent).filter(F.col("_r") <= n)
    return tail.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct(order, value)))[value].alias("recent"),
        F.max(order).alias("last_date"),
    )


def _fit_ar(moments: np.ndarray, fixed: tuple[int, int] | None = None) -> tuple[int, int, float, np.ndarray]:
    """(p, d, constant, weights) with the lowest AIC, or of the given order."""
    size = _LOOKBACK + 2
    gram = np.zeros((size, size))
    gram[np.triu_indices(size)] = moments
    gram = gram + np.triu(gram, 1).T
    n = gram[0, 0]
    unit = np.eye(size)
    change = [unit[2 + k] for k in range(_LOOKBACK)]  # change k rows back
    level = [unit[1] + unit[2]]  # value k rows back
    for k in range(MAX_P):
        level.append(level[-1] - change[k])
    second = [change[k] - change[k + 1] for k in range(_LOOKBACK - 1)]
    best = None
    for d, basis in enumerate((level, change, second)):
        for p in range(MAX_P + 1):
            if fixed is not None and fixed != (p, d):
                continue
            design = [*([unit[0]] if d < 2 else []), *basis[1 : p + 1]]
            if n <= len(design) + 1:
                continue
            x = np.array(design).reshape(len(design), size)
            xx, xy, yy = x @ gram @ x.T, x @ gram @ basis[0], basis[0] @ gram @ basis[0]
            weights = np.linalg.lstsq(xx, xy, rcond=None)[0] if design else np.zeros(0)
            rss = max(yy - weights @ xy, 1e-12 * max(yy, 1e-300))
            aic = n * np.log(rss / n) + 2 * (len(design) + 1)
            if best is None or aic < best[0] - 1e-9:
                constant = float(weights[0]) if d < 2 else 0.0
                best = (aic, p, d, constant, weights[1:] if d < 2 else weights)
    if best is None:
        return 0, 1, 0.0, np.zeros(0)
    return best[1], best[2], best[3], best[4]


def _ar_steps(p: int, d: int, constant: float, weights: np.ndarray, recent: np.ndarray, steps: int) -> Iterator[np.ndarray]:
    """The forecasts, in blocks."""
    differenced = np.diff(recent, n=d) if d else recent
    lags = [float(v) for v in differenced[::-1][:p]]
    # Last value of each level of differencing, to add the forecast changes to.
    ends = [float(np.diff(recent, n=i)[-1]) for i in range(d)]
    block = []
    for _ in range(steps):
        z = constant + float(np.dot(weights, lags)) if p else constant
        if p:
            lags = [z, *lags[:-1]]
        for i in range(d - 1, -1, -1):
            ends[i] += z
            z = ends[i]
        block.append(z)
        if len(block) == STEP_BLOCK:
            yield np.array(block)
            block = []
    if block:
        yield np.array(block)


def forecast_ar(
    train: DataFrame,
    horizon: DataFrame,
    key: str = "series_id",
    order: str = "date",
    value: str = "value",
    daily: bool = False,
    fixed: tuple[int, int] | None = None,
) -> DataFrame:
    """AR forecasts: (key, p, d, step, date, predicted).

    `horizon` has (key, horizon): the number of days to forecast. p <= 5 and d <= 2 are
    chosen by AIC, unless `fixed` gives (p, d). A series too short for any model repeats its
    last value; one without a known value has no forecast. A job stores the means.
    """
    moments = ar_moments(train, key, order, value, daily)
    steps_wanted = horizon.select(key, F.col("horizon").cast("int").alias("horizon"))
    state = join_null_safe(last_values(train, key, order, value), moments, [key], "left")
    state = join_null_safe(state, steps_wanted, [key])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                known = row.moments is not None
                centre = row.centre if known else 0.0
                recent = np.asarray(row.recent, dtype=float) - centre
                p, d, constant, weights = _fit_ar(np.asarray(row.moments), fixed) if known else (0, 1, 0.0, np.zeros(0))
                done = 0
                for block in _ar_steps(p, d, constant, weights, recent, row.horizon):
                    steps = np.arange(done + 1, done + len(block) + 1)
                    done += len(block)
                    yield pd.DataFrame(
                        {"key": row.key, "p": p, "d": d, "step": steps, "last_date": row.last_date, "predicted": block + centre}
                    )

    steps = state.select(F.col(key).alias("key"), "recent", "centre", "moments", "last_date", "horizon").mapInPandas(
        run, "key string, p int, d int, step int, last_date date, predicted double"
    )
    return steps.select(
        F.col("key").alias(key), "p", "d", "step", F.date_add("last_date", F.col("step")).alias(order), "predicted"
    )


# --- trend and seasons ----------------------------------------------------------------


def season_terms(date: Column, yearly: int = YEARLY_TERMS, weekly: int = WEEKLY_TERMS) -> list[Column]:
    """1, trend in years, yearly and weekly sine and cosine terms."""
    day = F.datediff(date, F.lit(_ORIGIN).cast("date")).cast("double")
    terms = [F.lit(1.0), day / YEAR]
    for period, count in ((YEAR, yearly), (WEEK, weekly)):
        for k in range(1, count + 1):
            angle = day * (2 * np.pi * k / period)
            terms += [F.sin(angle), F.cos(angle)]
    return terms


def _season_matrix(days: np.ndarray, yearly: int, weekly: int) -> np.ndarray:
    columns = [np.ones_like(days), days / YEAR]
    for period, count in ((YEAR, yearly), (WEEK, weekly)):
        for k in range(1, count + 1):
            angle = days * (2 * np.pi * k / period)
            columns += [np.sin(angle), np.cos(angle)]
    return np.column_stack(columns)


def season_coefficients(
    train: DataFrame,
    key: str = "series_id",
    order: str = "date",
    value: str = "value",
    yearly: int = YEARLY_TERMS,
    weekly: int = WEEKLY_TERMS,
) -> DataFrame:
    """(key, coefficients) by least squares.

    Each task adds up one matrix of sums for each of its series; a solve per series adds
    those of all tasks.
    """
    size = 2 + 2 * (yearly + weekly)
    known = train.filter(null_if_nan(F.col(value)).isNotNull()).select(
        F.col(key).alias("key"),
        F.datediff(order, F.lit(_ORIGIN).cast("date")).cast("double").alias("day"),
        F.col(value).cast("double").alias("y"),
    )

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for batch in batches:
            for name, group in batch.groupby("key", dropna=False):
                x = _season_matrix(group["day"].to_numpy(), yearly, weekly)
                gram = x.T @ np.column_stack([x, group["y"].to_numpy()])
                name = None if pd.isna(name) else name
                held[name] = held[name] + gram if name in held else gram
            if len(held) > MOST_HELD:
                yield pd.DataFrame({"key": list(held), "gram": [g.ravel() for g in held.values()]})
                held = {}
        if held:
            yield pd.DataFrame({"key": list(held), "gram": [g.ravel() for g in held.values()]})

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(np.stack(group["gram"].to_numpy()), axis=0).reshape(size, size + 1)
        weights = np.linalg.lstsq(total[:, :size], total[:, size], rcond=1e-10)[0]
        return pd.DataFrame({"key": [group["key"].iloc[0]], "coefficients": [weights]})

    added = known.mapInPandas(sums, "key string, gram array<double>")
    solved = added.groupBy("key").applyInPandas(solve, "key string, coefficients array<double>")
    return solved.select(F.col("key").alias(key), "coefficients")


def season_value(coefficients: Column, date: Column, yearly: int = YEARLY_TERMS, weekly: int = WEEKLY_TERMS) -> Column:
    """The model at a date, as a column expression."""
    total = F.lit(0.0)
    for i, term in enumerate(season_terms(date, yearly, weekly)):
        total = total + coefficients[i] * term
    return total


def _hinges(days: np.ndarray, low: float, high: float, count: int) -> np.ndarray:
    """How many years a day is past each changepoint, 0 before it."""
    places = low + CHANGE_SPAN * (high - low) * np.arange(1, count + 1) / count
    return np.maximum(days[:, None] - places, 0) / YEAR


def hinge_value(changes: Column, day: Column, low: Column, high: Column, count: int) -> Column:
    """What the changes of slope add at a day, as a column expression."""
    total = F.lit(0.0)
    for k in range(1, count + 1):
        place = low + F.lit(CHANGE_SPAN) * (high - low) * F.lit(k) / F.lit(count)
        total = total + changes[k - 1] * F.greatest(day - place, F.lit(0.0)) / YEAR
    return total


def solve_changes(gram: np.ndarray, free: int, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """(weights of the free terms, changes of slope) from summed products.

    gram: products of (free terms, hinges) with themselves and, last column, with the value.
    Minimises half the squared error plus a price for the absolute changes, by coordinate
    descent on what the free terms leave. The price is `penalty` times the one from which on
    no slope changes, so a penalty of 1 or more gives a straight trend.
    """
    size = len(gram)
    xx, xy = gram[:, :size], gram[:, size]
    aa, ah, hh = xx[:free, :free], xx[:free, free:], xx[free:, free:]
    alone = np.linalg.lstsq(aa, xy[:free], rcond=1e-10)[0]
    across = np.linalg.lstsq(aa, ah, rcond=1e-10)[0]
    left, pull = hh - ah.T @ across, xy[free:] - ah.T @ alone
    changes = np.zeros(size - free)
    if not len(changes) or penalty >= 1:
        return alone, changes
    price = penalty * np.abs(pull).max()
    # A hinge that the free terms explain, as on a short series, keeps its slope.
    usable = [k for k in range(len(changes)) if left[k, k] > 1e-9 * max(hh[k, k], 1e-300)]
    for _ in range(DESCENTS):
        moved = 0.0
        for k in usable:
            rest = pull[k] - left[k] @ changes + left[k, k] * changes[k]
            new = np.sign(rest) * max(abs(rest) - price, 0.0) / left[k, k]
            moved = max(moved, abs(new - changes[k]) * np.sqrt(left[k, k]))
            changes[k] = new
        if moved <= 1e-9 * np.sqrt(max(np.abs(np.diag(left)).max(), 1e-300)):
            break
    return alone - across @ changes, changes


def bent_trend(
    train: DataFrame,
    key: str = "series_id",
    order: str = "date",
    value: str = "value",
    yearly: int = YEARLY_TERMS,
    weekly: int = WEEKLY_TERMS,
    changepoints: int = CHANGEPOINTS,
    penalty: float = PENALTY,
) -> DataFrame:
    """(key, low, high, coefficients, changes): trend whose slope may change at `changepoints`
    even places of the first CHANGE_SPAN of a series, with seasons.

    low and high are the first and last known day. Each task adds up one matrix per series;
    a solve per series sees those sums only. A job stores the days.
    """
    free = 2 + 2 * (yearly + weekly)
    size = free + changepoints
    day = F.datediff(F.col(order), F.lit(_ORIGIN).cast("date")).cast("double")
    known = train.filter(null_if_nan(F.col(value)).isNotNull()).select(
        F.col(key).alias("key"), day.alias("day"), F.col(value).cast("double").alias("y")
    )
    ends = known.groupBy("key").agg(F.min("day").alias("low"), F.max("day").alias("high"))
    rows = join_summary(known, ends, ["key"])
    kind = train.schema[key].dataType.simpleString()

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for batch in batches:
            for (name, low, high), group in batch.groupby(["key", "low", "high"], dropna=False):
                days = group["day"].to_numpy()
                x = np.column_stack([_season_matrix(days, yearly, weekly), _hinges(days, low, high, changepoints)])
                gram = x.T @ np.column_stack([x, group["y"].to_numpy()])
                name = (None if pd.isna(name) else name, low, high)
                held[name] = held[name] + gram if name in held else gram
            if len(held) > MOST_HELD:
                yield flat(held)
                held = {}
        if held:
            yield flat(held)

    def flat(held: dict) -> pd.DataFrame:
        names = pd.DataFrame(list(held), columns=["key", "low", "high"])
        return names.assign(gram=[g.ravel() for g in held.values()])

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(np.stack(group["gram"].to_numpy()), axis=0).reshape(size, size + 1)
        weights, changes = solve_changes(total, free, penalty)
        return group[["key", "low", "high"]].head(1).assign(coefficients=[weights], changes=[changes])

    added = rows.mapInPandas(sums, f"key {kind}, low double, high double, gram array<double>")
    solved = added.groupBy("key").applyInPandas(
        solve, f"key {kind}, low double, high double, coefficients array<double>, changes array<double>"
    )
    return solved.withColumnRenamed("key", key)


def forecast_trend_season(
    train: DataFrame,
    horizon: DataFrame,
    key: str = "series_id",
    order: str = "date",
    value: str = "value",
    yearly: int = YEARLY_TERMS,
    weekly: int = WEEKLY_TERMS,
    changepoints: int = 0,
    penalty: float = PENALTY,
) -> DataFrame:
    """(key, step, date, predicted) for the days after the last training day.

    `yearly` and `weekly` are the numbers of sine and cosine pairs; none leave a straight line.
    With `changepoints` the slope may change at that many places (`bent_trend`); the last
    slope goes on into the forecast.
    """
    last = train.groupBy(key).agg(F.max(order).alias("last_date"))
    steps_wanted = horizon.select(key, F.col("horizon").cast("int").alias("horizon"))
    if changepoints:
        models = bent_trend(train, key, order, value, yearly, weekly, changepoints, penalty)
    else:
        models = season_coefficients(train, key, order, value, yearly, weekly)
    state = join_null_safe(models, last, [key])
    future = (
        join_null_safe(state, steps_wanted, [key])
        .filter(F.col("horizon") > 0)
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.col("horizon"))))
        .withColumn(order, F.date_add("last_date", F.col("step")))
    )
    predicted = season_value(F.col("coefficients"), F.col(order), yearly, weekly)
    if changepoints:
        day = F.datediff(F.col(order), F.lit(_ORIGIN).cast("date")).cast("double")
        predicted = predicted + hinge_value(F.col("changes"), day, F.col("low"), F.col("high"), changepoints)
    return future.select(key, "step", order, predicted.alias("predicted"))
