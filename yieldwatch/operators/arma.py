"""Forecasts of many series by ARMA models with a seasonal term, after Hannan and Rissanen.

A long autoregression gives the residuals, and the value is then regressed on earlier values,
earlier residuals and, for the season, the value one period back. The residuals are
linear in the lagged values, so both regressions of every candidate order come from the one
matrix of products that Spark sums per series (`lagged_products`).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldwatch.operators.forecast import STEP_BLOCK, last_values
from yieldwatch.operators.joins import join_null_safe
from yieldwatch.operators.lagged import Lagged, lagged_products

MAX_P, MAX_D, MAX_Q = 5, 2, 2
PERIOD = 12
LONG = 13  # rows of the long autoregression


@dataclass(frozen=True)
class Order:
    """p earlier values, d differences, q earlier residuals, `seasonal` values one period apart (0 or 1)."""

    p: int
    d: int
    q: int = 0
    seasonal: int = 0


@dataclass
class Arma:
    order: Order
    constant: float = 0.0
    values: np.ndarray = field(default_factory=lambda: np.zeros(0))
    residuals: np.ndarray = field(default_factory=lambda: np.zeros(0))
    season: float = 0.0
    long_constant: float = 0.0
    long: np.ndarray = field(default_factory=lambda: np.zeros(0))


def rows_back(orders: list[Order], long: int, period: int) -> int:
    """How many earlier rows the candidates need; all of them are compared on the same rows."""
    most_d = max(o.d for o in orders)
    most_q = max(o.q for o in orders)
    reach = max([*(o.p for o in orders), *(period for o in orders if o.seasonal), 1])
    return most_d + max(reach, most_q + long if most_q else 0)


def _shrinks(weights: np.ndarray) -> bool:
    """True if x_t = sum of weights * x_(t-i) dies out."""
    if not len(weights):
        return True
    step = np.eye(len(weights), k=-1)
    step[0] = weights
    return bool(np.abs(np.linalg.eigvals(step)).max() < 1)


def fit(gram: np.ndarray, orders: list[Order], long: int = LONG, period: int = PERIOD) -> Arma:
    """The candidate with the lowest AIC; without enough rows for any, the last value repeated.

    A candidate whose residual part is not invertible is left out, as its forecasts would
    depend on ever older residuals.
    """
    terms = Lagged(gram)
    best, least = None, None
    for d in sorted({o.d for o in orders}):
        z = terms.differenced(d)
        constant = [terms.one] if d < 2 else []
        shocks, long_weights = [], np.zeros(0)
        if any(o.q for o in orders if o.d == d) and terms.n > long + 2:
            long_weights, _ = terms.regress(z[0], [*constant, *z[1 : long + 1]])
            own = long_weights[len(constant) :]
            for j in range(max(o.q for o in orders if o.d == d) + 1):
                shock = z[j] - sum(w * z[j + i + 1] for i, w in enumerate(own))
                shocks.append(shock - long_weights[0] * terms.one if constant else shock)
        for order in [o for o in orders if o.d == d]:
            if order.q and not shocks:
                continue
            design = [*constant, *z[1 : order.p + 1], *shocks[1 : order.q + 1], *([z[period]] if order.seasonal else [])]
            if terms.n <= len(design) + 1:
                continue
            weights, rss = terms.regress(z[0], design)
            total = float(z[0] @ terms.gram @ z[0])
            rss = max(rss, 1e-12 * max(total, 1e-300))
            aic = terms.n * np.log(rss / terms.n) + 2 * (len(design) + 1)
            first = len(constant)
            residuals = weights[first + order.p : first + order.p + order.q]
            if not _shrinks(-residuals) or (least is not None and aic >= least - 1e-9):
                continue
            least = aic
            best = Arma(
                order,
                float(weights[0]) if constant else 0.0,
                weights[first : first + order.p],
                residuals,
                float(weights[-1]) if order.seasonal else 0.0,
                float(long_weights[0]) if constant and len(long_weights) else 0.0,
                long_weights[first:],
            )
    return best or Arma(Order(0, 1))


def steps(model: Arma, recent: np.ndarray, count: int, period: int = PERIOD) -> Iterator[np.ndarray]:
    """The forecasts after `recent`, in blocks."""
    d = model.order.d
    z = np.diff(recent, n=d) if d else recent
    reach = max(model.order.p, period if model.order.seasonal else 0)
    lags = [float(v) for v in z[::-1][:reach]] + [0.0] * max(0, reach - len(z))
    shocks = []
    for j in range(model.order.q):
        before = z[::-1][j + 1 : j + 1 + len(model.long)]
        known = j < len(z) and len(before) == len(model.long)
        shocks.append(float(z[::-1][j] - model.long_constant - before @ model.long) if known else 0.0)
    # Last value of each level of differencing, to add the forecast changes to.
    ends = [float(np.diff(recent, n=i)[-1]) if len(recent) > i else 0.0 for i in range(d)]
    block = []
    for _ in range(count):
        step = model.constant + float(np.dot(model.values, lags[: model.order.p])) + float(np.dot(model.residuals, shocks))
        if model.order.seasonal:
            step += model.season * lags[period - 1]
        if reach:
            lags = [step, *lags[:-1]]
        if shocks:
            shocks = [0.0, *shocks[:-1]]
        for i in range(d - 1, -1, -1):
            ends[i] += step
            step = ends[i]
        block.append(step)
        if len(block) == STEP_BLOCK:
            yield np.array(block)
            block = []
    if block:
        yield np.array(block)


def all_orders(max_p: int = MAX_P, max_d: int = MAX_D, max_q: int = MAX_Q, seasonal: bool = True) -> list[Order]:
    """Every order up to the given ones, simple ones first."""
    found = [
        Order(p, d, q, s)
        for d in range(max_d + 1)
        for s in range(2 if seasonal else 1)
        for q in range(max_q + 1)
        for p in range(max_p + 1)
    ]
    return sorted(found, key=lambda o: (o.d, o.p + o.q + o.seasonal, o.q, o.seasonal))


def forecast_arma(
    train: DataFrame,
    horizon: DataFrame,
    key: str = "series_id",
    order: str = "date",
    value: str = "value",
    daily: bool = False,
    fixed: Order | None = None,
    long: int = LONG,
    period: int = PERIOD,
    seasonal: bool = True,
) -> DataFrame:
    """ARMA forecasts: (key, p, d, q, seasonal, step, date, predicted).

    `horizon` has (key, horizon): the number of days to forecast. The order is chosen by AIC
    among p <= 5, d <= 2, q <= 2 with and without the value `period` rows back (`seasonal`),
    unless `fixed` gives it. `long` is the length of the autoregression that gives the
    residuals. A series too short for any model repeats its last value; one without a known
    value has no forecast. A NULL key is a series. A job stores the means.
    """
    orders = [fixed] if fixed is not None else all_orders(seasonal=seasonal)
    lookback = rows_back(orders, long, period)
    products = lagged_products(train, key, order, value, lookback, daily)
    wanted = horizon.select(key, F.col("horizon").cast("int").alias("horizon"))
    state = join_null_safe(last_values(train, key, order, value, lookback + 1), products, [key], "left")
    state = join_null_safe(state, wanted, [key])
    kind = train.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                known = row.gram is not None
                centre = row.centre if known else 0.0
                model = fit(np.asarray(row.gram), orders, long, period) if known else Arma(Order(0, 1))
                recent = np.asarray(row.recent, dtype=float) - centre
                o, done = model.order, 0
                for block in steps(model, recent, row.horizon, period):
                    numbers = np.arange(done + 1, done + len(block) + 1)
                    done += len(block)
                    yield pd.DataFrame(
                        {
                            "key": row.key, "p": o.p, "d": o.d, "q": o.q, "seasonal": o.seasonal, "step": numbers,
                            "last_date": row.last_date, "predicted": block + centre,
                        }
                    )

    state = state.select(F.col(key).alias("key"), "recent", "centre", "gram", "last_date", "horizon")
    found = state.mapInPandas(
        run, f"key {kind}, p int, d int, q int, seasonal int, step int, last_date date, predicted double"
    )
    date = F.date_add("last_date", F.col("step")).alias(order)
    return found.select(F.col("key").alias(key), "p", "d", "q", "seasonal", "step", date, "predicted")
