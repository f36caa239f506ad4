"""Forecast errors, comparison with a baseline, rolling error, stability, unit-root test."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yieldwatch.functions.scalars import null_if_nan
from yieldwatch.operators.halo import row_windows
from yieldwatch.operators.joins import join_null_safe, join_summary
from yieldwatch.operators.lagged import Lagged, lagged_products

TARGET_MODEL = ("target", "model")
# 5 % point of the Dickey-Fuller distribution with a constant.
DICKEY_FULLER_5PCT = -2.86
# Published response surface of that distribution's p-value (constant, one
# series): ends of the range, the t where the second polynomial takes over, coefficients.
SURFACE_LEAST, SURFACE_MOST, SURFACE_TURN = -18.83, 2.74, -1.61
SURFACE_LOW = (2.1659, 1.4412, 0.038269)
SURFACE_HIGH = (1.7339, 0.93202, -0.12745, -0.010368)
MAX_LAGS = 26


def squared_error(actual: str = "actual", predicted: str = "predicted") -> Column:
    error = F.col(actual) - F.col(predicted)
    return error * error


def regression_metrics(df: DataFrame, keys: Sequence[str] = TARGET_MODEL) -> DataFrame:
    """RMSE and MAE per key, in one aggregation."""
    return df.groupBy(*keys).agg(
        F.sqrt(F.avg(squared_error())).alias("rmse"),
        F.avg(F.abs(F.col("actual") - F.col("predicted"))).alias("mae"),
    )


def best_baseline(metrics: DataFrame, keys: Sequence[str] = ("target",)) -> DataFrame:
    """The model with the lowest RMSE per target (ties: first by name).

    A model whose RMSE is NULL or NaN is never the best; a target with no other has NULLs.
    """
    known = null_if_nan(F.col("rmse")).isNotNull()
    best = F.min(F.when(known, F.struct("rmse", "model", "mae"))).alias("_best")
    return metrics.groupBy(*keys).agg(best).select(
        *keys,
        F.col("_best.model").alias("best_model"),
        F.col("_best.rmse").alias("rmse"),
        F.col("_best.mae").alias("mae"),
    )


def improvement_vs_baseline(
    metrics: DataFrame, baseline: DataFrame, keys: Sequence[str] = ("target",)
) -> DataFrame:
    """RMSE change against the baseline, in percent of the baseline; NULL without a baseline."""
    base = baseline.select(*keys, F.col("best_model").alias("baseline_model"), F.col("rmse").alias("baseline_rmse"))
    gain = F.try_divide(F.col("baseline_rmse") - F.col("rmse"), F.col("baseline_rmse")) * 100
    return join_null_safe(metrics, base, list(keys), "left").withColumn("improvement_pct", gain)


def best_auc_gate(metrics: DataFrame, keys: Sequence[str] = (), threshold: float = 0.75) -> DataFrame:
    """The best AUC over the models and whether it passes the threshold."""
    return metrics.groupBy(*keys).agg(F.max("auc").alias("best_auc")).withColumn(
        "validated", F.col("best_auc") > threshold
    )


def rolling_rmse(
    df: DataFrame,
    keys: Sequence[str] = TARGET_MODEL,
    order: str = "date",
    window: int = 30,
    daily: bool = False,
) -> DataFrame:
    """Add `rolling_rmse` over the last `window` rows, shorter at the start."""
    squared = df.withColumn("_squared", null_if_nan(squared_error()))
    return row_windows(
        squared,
        keys,
        order,
        window - 1,
        lambda w: {"rolling_rmse": F.sqrt(F.avg("_squared").over(w.rowsBetween(1 - window, 0)))},
        daily,
    ).drop("_squared")


def stability_of(mean: Column, std: Column, n: Column, baseline: Column) -> Column:
    """1 / (1 + variation), cut when the mean is far above the baseline, at most 1.

    No rows give 0; one row gives NULL, as its deviation is unknown.
    """
    # Guard against zero, penalty limits and factors.
    variation = std / (mean + 1e-10)
    ratio = mean / (baseline + 1e-10)
    penalty = F.when(ratio > 1.5, 0.7).when(ratio > 1.2, 0.85).otherwise(1.0)
    index = penalty / (1 + variation)
    return F.when(n == 0, 0.0).when(index.isNotNull(), F.least(index, F.lit(1.0)))


def stability_index(rolled: DataFrame, keys: Sequence[str] = TARGET_MODEL) -> DataFrame:
    """Per key: overall RMSE, mean and deviation of the rolling RMSE, stability index."""
    return (
        rolled.groupBy(*keys)
        .agg(
            F.sqrt(F.avg(squared_error())).alias("overall_rmse"),
            F.avg("rolling_rmse").alias("mean_rolling_rmse"),
            F.stddev_samp("rolling_rmse").alias("std_rolling_rmse"),
            F.count("rolling_rmse").alias("_n"),
        )
        .withColumn(
            "stability_index",
            stability_of(F.col("mean_rolling_rmse"), F.col("std_rolling_rmse"), F.col("_n"), F.col("overall_rmse")),
        )
        .drop("_n")
    )


def importance_pct(importance: DataFrame) -> DataFrame:
    """(feature, importance, importance_pct), highest first."""
    total = importance.agg(F.sum("importance")).scalar()
    share = F.try_divide(F.col("importance"), total) * 100
    return importance.withColumn("importance_pct", share).orderBy(F.desc("importance"), "feature")


def stationarity(
    df: DataFrame,
    keys: Sequence[str] = ("series_id",),
    order: str = "date",
    value: str = "value",
    daily: bool = False,
    lags: int = 0,
) -> DataFrame:
    """Dickey-Fuller t per series: the change regressed on the level of the row before, and
    with `lags` (the augmented test) on that many earlier changes too.

    Rows with an unknown value among those needed are left out; a series with too few rows
    has NULL. With `lags` a job stores the mean of each series.
    """
    if lags:
        return _augmented(df, list(keys), order, value, daily, lags)
    steps = row_windows(df, keys, order, 1, lambda w: {"_level": F.lag(value).over(w)}, daily)
    steps = steps.withColumn("_change", F.col(value) - F.col("_level"))
    y, x = "_change", "_level"
    fit = steps.groupBy(*keys).agg(
        F.regr_count(y, x).alias("n"),
        F.regr_slope(y, x).alias("_slope"),
        F.regr_sxx(y, x).alias("_sxx"),
        F.regr_sxy(y, x).alias("_sxy"),
        F.regr_syy(y, x).alias("_syy"),
    )
    residual = (F.col("_syy") - F.col("_slope") * F.col("_sxy")) / F.when(F.col("n") > 2, F.col("n") - 2)
    error = F.sqrt(F.try_divide(residual, F.col("_sxx")))
    return fit.select(
        *keys, "n", F.col("_slope").alias("slope"), F.try_divide(F.col("_slope"), error).alias("t_stat")
    ).withColumn("stationary", F.col("t_stat") < DICKEY_FULLER_5PCT)


def _augmented(df: DataFrame, keys: list[str], order: str, value: str, daily: bool, lags: int) -> DataFrame:
    """Spark sums the products of all terms per series; a small solver sees only those sums."""
    means = df.groupBy(*keys).agg(F.avg(null_if_nan(F.col(value))).alias("_mean"))
    rows = join_summary(df.select(*keys, order, value), means, keys)
    rows = rows.withColumn("_x", null_if_nan(F.col(value).cast("double")) - F.col("_mean"))

    def build(w) -> dict[str, Column]:
        def back(k: int) -> Column:
            return F.lag("_x", k).over(w) if k else F.col("_x")

        return {"_t1": back(1), **{f"_t{k + 2}": back(k) - back(k + 1) for k in range(lags + 1)}}

    wide = row_windows(rows, keys, order, lags + 1, build, daily)
    # 1, the level before, this change, the earlier changes.
    terms = [F.lit(1.0), *[F.col(f"_t{i}") for i in range(1, lags + 3)]]
    known = wide.filter(reduce(lambda a, b: a & b, [t.isNotNull() for t in terms[1:]]))
    size = len(terms)
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    sums = known.groupBy(*keys).agg(F.array(*[F.sum(terms[i] * terms[j]) for i, j in pairs]).alias("_sums"))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_dickey_fuller(np.asarray(m, dtype=float), size) for m in batch["_sums"]]
            out = batch[keys].copy()
            out["n"], out["slope"], out["t_stat"] = (list(x) for x in zip(*found)) if found else ([], [], [])
            yield out

    schema = T.StructType([sums.schema[k] for k in keys]).add("n", T.LongType()).add("slope", T.DoubleType()).add("t_stat", T.DoubleType())
    solved = sums.mapInPandas(solve, schema)
    return solved.withColumns({c: null_if_nan(F.col(c)) for c in ("slope", "t_stat")}).withColumn(
        "stationary", F.col("t_stat") < DICKEY_FULLER_5PCT
    )


def _dickey_fuller(moments: np.ndarray, size: int) -> tuple[int, float, float]:
    """(n, slope of the level, its t) from the products of (1, level, change, earlier changes)."""
    gram = np.zeros((size, size))
    gram[np.triu_indices(size)] = moments
    gram = gram + np.triu(gram, 1).T
    n, inputs = int(round(gram[0, 0])), [0, 1, *range(3, size)]
    xx, xy = gram[np.ix_(inputs, inputs)], gram[inputs, 2]
    if n <= len(inputs) or np.linalg.matrix_rank(xx) < len(inputs):
        return n, float("nan"), float("nan")
    inverse = np.linalg.inv(xx)
    weights = inverse @ xy
    residual = max(gram[2, 2] - weights @ xy, 0.0) / (n - len(inputs))
    error = np.sqrt(residual * inverse[1, 1])
    return n, float(weights[1]), float(weights[1] / error) if error > 0 else float("nan")


def dickey_fuller_p(t: float) -> float:
    """The p-value of a Dickey-Fuller t with a constant, by the published response surface."""
    if t > SURFACE_MOST:
        return 1.0
    if t < SURFACE_LEAST:
        return 0.0
    terms = SURFACE_LOW if t <= SURFACE_TURN else SURFACE_HIGH
    z = sum(c * t**k for k, c in enumerate(terms))
    return 0.5 * math.erfc(-z / math.sqrt(2))


def lags_by_aic(gram: np.ndarray, max_lags: int) -> tuple[int, int, float] | None:
    """(n, lags, t): the number of earlier changes with the lowest AIC, and the t of the level.

    All numbers up to `max_lags` are compared on the same rows; no more are tried than
    Schwert's rule 12 (n / 100)^(1/4) allows. None without enough rows.
    """
    terms = Lagged(gram)
    n, before = terms.n, terms.unit[1]
    best = None
    for lags in range(min(max_lags, math.ceil(12 * (n / 100) ** 0.25)) + 1):
        design = [before, terms.one, *terms.change[1 : lags + 1]]
        x = np.array(design)
        xx = x @ terms.gram @ x.T
        if n <= len(design) or np.linalg.matrix_rank(xx) < len(design):
            continue
        weights, rss = terms.regress(terms.change[0], design)
        if rss <= 0:
            continue
        aic = n * math.log(rss / n) + 2 * len(design)
        if best is None or aic < best[0]:
            error = math.sqrt(rss / (n - len(design)) * np.linalg.inv(xx)[0, 0])
            best = (aic, lags, float(weights[0] / error))
    return (int(round(n)), best[1], best[2]) if best else None


def unit_root_test(
    df: DataFrame,
    key: str = "series_id",
    order: str = "date",
    value: str = "value",
    daily: bool = False,
    max_lags: int = MAX_LAGS,
) -> DataFrame:
    """Augmented Dickey-Fuller test: (key, n, lags, t_stat, p_value, stationary).

    The number of lags is the one with the lowest AIC, all of them solved from one matrix of
    products per series. Rows count that have `max_lags` + 1 known rows before them; a series
    with too few rows has NULLs. `stationary` is p < 0.05. A job stores the means.
    """
    products = lagged_products(df, key, order, value, max_lags + 1, daily)
    kind = df.schema[key].dataType.simpleString()

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [lags_by_aic(np.asarray(g, dtype=float), max_lags) for g in batch["gram"]]
            out = pd.DataFrame({"key": batch["key"]})
            out["n"] = [f[0] if f else None for f in found]
            out["lags"] = [f[1] if f else None for f in found]
            out["t_stat"] = [f[2] if f else None for f in found]
            out["p_value"] = [dickey_fuller_p(f[2]) if f else None for f in found]
            yield out

    tested = products.select(F.col(key).alias("key"), "gram").mapInPandas(
        solve, f"key {kind}, n bigint, lags int, t_stat double, p_value double"
    )
    # A series that has no row with enough known ones before it is not in the products.
    series = df.select(F.col(key)).distinct()
    joined = join_null_safe(series, tested.withColumnRenamed("key", key), [key], "left")
    # Fixed value: 5 % level of the test.
    return joined.withColumn("stationary", F.col("p_value") < 0.05)
