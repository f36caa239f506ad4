"""DuckDB texts of the shared views, used by the oracle of many queries."""

from __future__ import annotations

from collections.abc import Sequence

from checks import fixtures as fx

RATES = f"""rates_raw AS ({fx.duck(fx.RATES_RAW)}),
grid AS (SELECT series_id, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
         FROM rates_raw GROUP BY series_id),
rates AS (SELECT g.series_id, g.date, r.value
          FROM grid g ASOF LEFT JOIN rates_raw r ON g.series_id = r.series_id AND g.date >= r.date)"""

FEATURES = f"""{RATES},
steps AS (
  SELECT series_id, date, value,
         lag(value, 1) OVER w AS lag1, lag(value, 5) OVER w AS lag5, lag(value, 10) OVER w AS lag10,
         avg(value) OVER (w ROWS 6 PRECEDING) AS roll_mean_7,
         stddev_samp(value) OVER (w ROWS 6 PRECEDING) AS roll_std_7,
         avg(value) OVER (w ROWS 29 PRECEDING) AS roll_mean_30,
         stddev_samp(value) OVER (w ROWS 29 PRECEDING) AS roll_std_30,
         value / nullif(lag(value, 1) OVER w, 0) - 1 AS "return",
         lag(value, 1) OVER w / nullif(lag(value, 2) OVER w, 0) - 1 AS return_lag1,
         value - lag(value, 1) OVER w AS diff,
         value / nullif(lag(value, 1) OVER w, 0) - 1 AS diff_pct,
         row_number() OVER w AS rn
  FROM rates WINDOW w AS (PARTITION BY series_id ORDER BY date)),
calendar AS (
  SELECT date, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(day(date) AS INTEGER) AS day_of_month,
         CAST(dayofyear(date) AS INTEGER) AS day_of_year, CAST(month(date) AS INTEGER) AS month,
         CAST(quarter(date) AS INTEGER) AS quarter, CAST(year(date) AS INTEGER) AS year,
         CAST(weekofyear(date) AS INTEGER) AS week_of_year,
         sin(2 * pi() * (isodow(date) - 1) / 7) AS day_of_week_sin,
         cos(2 * pi() * (isodow(date) - 1) / 7) AS day_of_week_cos,
         sin(2 * pi() * month(date) / 12) AS month_sin, cos(2 * pi() * month(date) / 12) AS month_cos,
         CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
         CASE WHEN last_day(date) = date THEN 1 ELSE 0 END AS is_month_end,
         CASE WHEN last_day(date) = date AND month(date) % 3 = 0 THEN 1 ELSE 0 END AS is_quarter_end
  FROM (SELECT DISTINCT date FROM rates)),
features AS (
  SELECT s.* EXCLUDE (rn), s.roll_mean_7 - s.roll_mean_30 AS ma_crossover, c.* EXCLUDE (date)
  FROM steps s JOIN calendar c ON s.date = c.date WHERE s.rn > 10)"""

VALUE_FEATURES = (
    "lag1", "lag5", "lag10", "roll_mean_7", "roll_std_7", "roll_mean_30", "roll_std_30",
    "return", "return_lag1", "diff", "diff_pct", "ma_crossover",
)
CALENDAR = (
    "day_of_week", "day_of_month", "day_of_year", "month", "quarter", "year", "week_of_year",
    "day_of_week_sin", "day_of_week_cos", "month_sin", "month_cos", "is_weekend", "is_month_end", "is_quarter_end",
)
INEXACT = {
    "roll_mean_7": 3, "roll_std_7": 3, "roll_mean_30": 3, "roll_std_30": 3, "ma_crossover": 3,
    "day_of_week_sin": 10, "day_of_week_cos": 10, "month_sin": 10, "month_cos": 10,
}

PREDICTIONS = f"""{RATES},
guesses AS (
  SELECT series_id, date, value, lag(value, 1) OVER w AS naive,
         avg(value) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS ma7
  FROM rates WINDOW w AS (PARTITION BY series_id ORDER BY date)),
predictions AS (
  SELECT series_id AS target, date, 'naive' AS model, value AS actual, naive AS predicted
  FROM guesses WHERE naive IS NOT NULL
  UNION ALL
  SELECT series_id, date, 'ma7', value, ma7 FROM guesses WHERE ma7 IS NOT NULL)"""

METRICS = f"""{PREDICTIONS},
metrics AS (
  SELECT target, model, sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse,
         avg(abs(actual - predicted)) AS mae
  FROM predictions GROUP BY target, model)"""

MONITORING = f"""{PREDICTIONS},
rolled AS (
  SELECT *, sqrt(avg((actual - predicted) * (actual - predicted)) OVER (
           PARTITION BY target, model ORDER BY date ROWS 29 PRECEDING)) AS rolling_rmse
  FROM predictions),
moments AS (
  SELECT target, model, sqrt(avg((actual - predicted) * (actual - predicted))) AS overall_rmse,
         avg(rolling_rmse) AS mean_rolling_rmse, stddev_samp(rolling_rmse) AS std_rolling_rmse
  FROM rolled GROUP BY target, model),
scores AS (
  SELECT *, least(1e0, 1 / (1 + std_rolling_rmse / (mean_rolling_rmse + 1e-10)) *
           CASE WHEN mean_rolling_rmse / (overall_rmse + 1e-10) > 1.5 THEN 0.7e0
                WHEN mean_rolling_rmse / (overall_rmse + 1e-10) > 1.2 THEN 0.85e0 ELSE 1e0 END) AS stability_index
  FROM moments)"""

BEHAVIOR = f"behavior AS ({fx.duck(fx.BEHAVIOR)})"

OUTFLOW = f"""1 / (1 + exp(-(-2.5e0 + 1.5e0 * balance_volatility + 0.3e0 * (interest_rate_level - 2.5e0)
      + 2e0 * economic_stress + 0.5e0 * CASE WHEN customer_segment = '{fx.RETAIL}' THEN 1 ELSE 0 END
      - 0.2e0 * ln(least(greatest(base_balance, 1e3), 1e7)) / 10 - 0.1e0 * account_age_months / 12)))"""
REPAYMENT = f"""1 / (1 + exp(-(-3e0 + 0.01e0 * (credit_score - 700) - 0.4e0 * (interest_rate_level - 2.5e0)
      + 1.5e0 * economic_stress + 0.3e0 * CASE WHEN customer_segment = '{fx.CORPORATE}' THEN 1 ELSE 0 END)))"""
SEASONAL = f"""CASE WHEN month(date) >= 10 AND customer_segment = '{fx.RETAIL}' THEN 1.4e0
      WHEN month(date) >= 10 THEN 1.2e0 ELSE 1e0 END"""

CUSTOMERS = f"""{BEHAVIOR},
customers AS (
  SELECT date, customer_id, customer_segment, account_age_months,
         least(greatest(base_balance, 1e3), 1e7) AS base_balance, balance_volatility,
         {SEASONAL} AS seasonal_factor, interest_rate_level, economic_stress, market_volatility, num_products,
         transaction_frequency, credit_score, {OUTFLOW} AS outflow_probability, outflow_event,
         {REPAYMENT} AS early_repayment_probability, early_repayment_event
  FROM behavior)"""

SCORED = f"scored AS ({fx.duck(fx.SCORED)})"
STEPS = f"""{SCORED},
counts AS (SELECT model, score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label <> 1) AS neg
           FROM scored GROUP BY model, score),
steps AS (
  SELECT model, score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
         sum(pos) OVER (PARTITION BY model) AS p, sum(neg) OVER (PARTITION BY model) AS n
  FROM counts WINDOW w AS (PARTITION BY model ORDER BY score DESC))"""

# Daily means over a whole table each: the two series of the join reports.
DAILY = {
    "orders_daily": """SELECT CAST(o_orderdate AS DATE) AS date,
       sum(CAST(round(o_totalprice * 100) AS BIGINT)) / count(*) / 100e0 AS value
FROM {orders} GROUP BY CAST(o_orderdate AS DATE)""",
    "shipments_daily": """SELECT CAST(l_shipdate AS DATE) AS date,
       sum(CAST(round(l_extendedprice * 100) AS BIGINT)) / count(*) / 100e0 AS value
FROM {lineitem} GROUP BY CAST(l_shipdate AS DATE)""",
}
DAILY_SQL = ",\n".join(f"{name} AS ({fx.duck(sql)})" for name, sql in DAILY.items())


def long_features(source: str, features: Sequence[str], is_train: str) -> str:
    """(feature, is_train, value) rows of a wide table."""
    parts = [
        f"SELECT '{c}' AS feature, {is_train} AS is_train, CAST(\"{c}\" AS DOUBLE) AS value FROM {source}"
        for c in features
    ]
    return " UNION ALL ".join(parts)


def drift(long_cte: str) -> str:
    """CTEs up to `scores(feature, psi, n_train, n_test, train_mean, test_mean)` from a CTE
    list that ends with `long(feature, is_train, value)`."""
    inner = " + ".join(f"CAST(value > s + {i} * ((e - s) / 10) AS INTEGER)" for i in range(1, 10))
    return f"""{long_cte},
bounds AS (SELECT feature, min(value) FILTER (is_train) AS lo, max(value) FILTER (is_train) AS hi
           FROM long GROUP BY feature),
edges AS (
  SELECT feature, CASE WHEN lo = hi THEN lo - CASE WHEN lo = 0 THEN 1e-3 ELSE abs(lo) * 1e-3 END ELSE lo END AS s,
         CASE WHEN lo = hi THEN hi + CASE WHEN lo = 0 THEN 1e-3 ELSE abs(lo) * 1e-3 END ELSE hi END AS e,
         CASE WHEN lo = hi THEN lo - CASE WHEN lo = 0 THEN 1e-3 ELSE abs(lo) * 1e-3 END
              ELSE lo - (hi - lo) * 1e-3 END AS f
  FROM bounds),
binned AS (
  SELECT feature, is_train, value,
         CASE WHEN value = f THEN 1 ELSE CAST(value > f AS INTEGER) + {inner} + CAST(value > e AS INTEGER) END AS bin
  FROM long JOIN edges USING (feature) WHERE value IS NOT NULL),
bins AS (SELECT feature, bin, count(*) FILTER (is_train) AS te, count(*) FILTER (NOT is_train) AS ta
         FROM binned GROUP BY feature, bin),
totals AS (SELECT feature, count(*) FILTER (is_train) AS n_train, count(*) FILTER (NOT is_train) AS n_test,
                  avg(value) FILTER (is_train) AS train_mean, avg(value) FILTER (NOT is_train) AS test_mean
           FROM binned GROUP BY feature),
scores AS (
  SELECT feature, n_train, n_test, train_mean, test_mean,
         sum((ta / n_test - te / n_train) * ln((ta / n_test) / (te / n_train) + 1e-10))
           FILTER (bin BETWEEN 1 AND 10 AND te > 0) AS psi
  FROM bins JOIN totals USING (feature) GROUP BY ALL)"""


DRIFT_FEATURES = ("value", *VALUE_FEATURES, *CALENDAR)
FEATURE_LONG = f"""{FEATURES},
placed AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY date)
                  <= floor(count(*) OVER (PARTITION BY series_id) * 8e-1) AS is_train FROM features),
long AS ({long_features("placed", DRIFT_FEATURES, "is_train")})"""
FEATURE_DRIFT = f"""{drift(FEATURE_LONG)},
report AS (
  SELECT feature, psi AS drift_score, CASE WHEN psi > 0.25 THEN 'Significant' ELSE 'Stable' END AS drift_status,
         train_mean, test_mean, abs((test_mean - train_mean) / (train_mean + 1e-10)) * 100 AS mean_diff_pct
  FROM scores WHERE n_train > 0 AND n_test > 0)"""

# Two columns of lineitem, before and from 1999-01-01.
LINE_DRIFT = f"""long AS ({long_features(
    "lineitem", ("l_extendedprice", "l_quantity", "l_discount"), "CAST(l_shipdate AS DATE) < DATE '1999-01-01'"
)})"""
