"""Every operator as a query over the test tables, with its SQL where SQL can say it."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks import sqltext as sq
from checks.registry import query
from yieldwatch.functions import calendar as cal
from yieldwatch.functions import scalars as sc
from yieldwatch.operators import audit, curves, drift, evaluate, features, grid, models, monitor, prepare, profile
from yieldwatch.operators import reports as rp
from yieldwatch.operators import scaling
from yieldwatch.operators.arma import Order, forecast_arma
from yieldwatch.operators.forecast import forecast_ar, forecast_trend_season
from yieldwatch.operators.halo import row_windows, store_framed
from yieldwatch.operators.split import chrono_split, hash_split, split_dates, stratified_split
from yieldwatch.plans import monitoring, rates, training
from yieldwatch.sources import readers, tables, writers
from yieldwatch.sources.scratch import scratch_path, settle

KEY = ["series_id", "date"]


# --- inputs ---------------------------------------------------------------------------


def daily_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    names = {"orders_daily": "orders", "shipments_daily": "lineitem"}
    return {
        name: spark.sql(sql, **{names[name]: fx.table(spark, sf, names[name])}) for name, sql in sq.DAILY.items()
    }


def customers(spark: SparkSession, sf: str) -> DataFrame:
    """The customer table with all 17 columns."""
    c = F.col
    balance = sc.clip(c("base_balance"), 1e3, 1e7)
    return fx.behavior(spark, sf).select(
        "date",
        "customer_id",
        "customer_segment",
        "account_age_months",
        balance.alias("base_balance"),
        "balance_volatility",
        sc.seasonal_factor(c("customer_segment"), c("date"), fx.RETAIL).alias("seasonal_factor"),
        "interest_rate_level",
        "economic_stress",
        "market_volatility",
        "num_products",
        "transaction_frequency",
        "credit_score",
        outflow(balance).alias("outflow_probability"),
        "outflow_event",
        repayment().alias("early_repayment_probability"),
        "early_repayment_event",
    )


def behavior_table(spark: SparkSession, sf: str) -> DataFrame:
    """The customer view as a stored table, for operators that read it more than once."""
    return settle(fx.behavior(spark, sf))


def outflow(balance):
    c = F.col
    return sc.outflow_score(
        c("balance_volatility"),
        c("interest_rate_level"),
        c("economic_stress"),
        c("customer_segment"),
        balance,
        c("account_age_months"),
        fx.RETAIL,
    )


def repayment():
    c = F.col
    return sc.early_repayment_score(
        c("credit_score"), c("interest_rate_level"), c("economic_stress"), c("customer_segment"), fx.CORPORATE
    )


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    return rates.series_predictions(fx.rates(spark, sf))


def long_features(spark: SparkSession, sf: str) -> DataFrame:
    return features.all_features(fx.rates(spark, sf), daily=True)


def feature_file(spark: SparkSession, sf: str) -> DataFrame:
    """The long feature table as written, the way monitoring reads it."""
    return settle(long_features(spark, sf))


def wide_features(spark: SparkSession, sf: str) -> DataFrame:
    return rates.wide_features(fx.rates(spark, sf), fx.SERIES)


def line_split(spark: SparkSession, sf: str) -> DataFrame:
    early = F.to_date("l_shipdate") < F.lit(datetime.date(1999, 1, 1))
    return fx.table(spark, sf, "lineitem").withColumn("split", F.when(early, "train").otherwise("test"))


LINE_COLUMNS = ["l_extendedprice", "l_quantity", "l_discount"]


# --- sources and sinks ----------------------------------------------------------------


@query("read_rates_csv", f"WITH {sq.RATES} SELECT series_id, CAST(date AS TIMESTAMP) AS ts, value FROM rates_raw")
def read_rates_csv(spark, sf):
    path = scratch_path(spark, "rates-csv")
    writers.write_features(fx.rates_raw(spark, sf), path, fmt="csv")
    return readers.read_rates_csv(spark, path)


@query(
    "read_behavioral_csv",
    f"""WITH {sq.CUSTOMERS} SELECT * REPLACE (CAST(date AS TIMESTAMP) AS date,
        CAST(customer_id AS VARCHAR) AS customer_id) FROM customers""",
    {"outflow_probability": 10, "early_repayment_probability": 10},
)
def read_behavioral_csv(spark, sf):
    path = scratch_path(spark, "customers-csv")
    writers.write_features(customers(spark, sf), path, partition_by=(), fmt="csv")
    return readers.read_behavioral_csv(spark, path)


def ingest(spark, sf):
    sources = {"behavioral_data": fx.behavior(spark, sf), **daily_tables(spark, sf)}
    return tables.ingest_tables(sources, scratch_path(spark, "tables"))


@query(
    "ingest_tables",
    f"""WITH {sq.BEHAVIOR}, {sq.DAILY_SQL}
    SELECT 'behavioral_data' AS table_name, count(*) AS count FROM behavior
    UNION ALL SELECT 'orders_daily', count(*) FROM orders_daily
    UNION ALL SELECT 'shipments_daily', count(*) FROM shipments_daily""",
)
def ingest_tables(spark, sf):
    return ingest(spark, sf)


@query(
    "load_rates",
    f"""WITH {sq.DAILY_SQL} SELECT 'orders_daily' AS series_id, date, value FROM orders_daily
    UNION ALL SELECT 'shipments_daily', date, value FROM shipments_daily""",
)
def load_rates(spark, sf):
    tables.ingest_tables(daily_tables(spark, sf))
    return tables.load_rates(spark, ["orders_daily", "shipments_daily"])


@query(
    "parse_observations",
    """SELECT event_type AS series_id, CAST(ts AS DATE) AS date,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS value FROM events""",
)
def parse_observations(spark, sf):
    point = F.struct(
        F.date_format("ts", "yyyy-MM-dd").alias("date"), F.get_json_object("props", "$.k").alias("value")
    )
    documents = fx.table(spark, sf, "events").select(
        F.col("event_type").alias("series_id"), F.to_json(F.struct(F.array(point).alias("observations"))).alias("json")
    )
    return readers.parse_observations(documents)


@query(
    "write_features",
    f"WITH {sq.FEATURES} SELECT * FROM features",
    sq.INEXACT,
)
def write_features(spark, sf):
    path = scratch_path(spark, "features")
    writers.write_features(long_features(spark, sf), path)
    return spark.read.parquet(path)


@query(
    "write_predictions",
    f"""WITH {sq.PREDICTIONS}
    SELECT target, date, max(actual) AS actual, max(predicted) FILTER (model = 'naive') AS naive_pred,
           max(predicted) FILTER (model = 'ma7') AS ma7_pred FROM predictions GROUP BY target, date""",
    {"ma7_pred": 3},
)
def write_predictions(spark, sf):
    path = scratch_path(spark, "predictions")
    writers.write_predictions(predictions(spark, sf), path, ["naive", "ma7"])
    return spark.read.parquet(path)


@query(
    "write_metrics_json",
    f"""WITH {sq.METRICS} SELECT target, count(*) AS models, max(rmse) FILTER (model = 'naive') AS naive_rmse,
    max(mae) FILTER (model = 'ma7') AS ma7_mae FROM metrics GROUP BY target""",
    {"naive_rmse": 3, "ma7_mae": 3},
)
def write_metrics_json(spark, sf):
    """The documents as text, read by their paths."""
    path = scratch_path(spark, "metrics")
    writers.write_metrics_json(evaluate.regression_metrics(predictions(spark, sf)), path)
    documents = spark.read.text(path, wholetext=True)
    return documents.select(
        "target",
        F.size(F.json_object_keys("value")).cast("long").alias("models"),
        F.get_json_object("value", "$.naive.RMSE").cast("double").alias("naive_rmse"),
        F.get_json_object("value", "$.ma7.MAE").cast("double").alias("ma7_mae"),
    )


@query("read_metrics_json", f"WITH {sq.METRICS} SELECT * FROM metrics", {"rmse": 3, "mae": 3})
def read_metrics_json(spark, sf):
    path = scratch_path(spark, "metrics")
    writers.write_metrics_json(evaluate.regression_metrics(predictions(spark, sf)), path)
    return readers.read_metrics_json(spark, path)


def dashboard_sql() -> str:
    summary = SUMMARY_SQL[SUMMARY_SQL.rindex("SELECT target, model, overall_rmse") :]
    tables = SUMMARY_SQL[: SUMMARY_SQL.rindex("SELECT target, model, overall_rmse")].rstrip()
    return f"""{tables}, summary AS ({summary})
    SELECT r.target, r.model, count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date,
           any_value(s.overall_rmse) AS overall_rmse, any_value(s.stability_index) AS stability_index,
           any_value(s.features_with_drift) AS features_with_drift, (SELECT count(*) FROM report) AS drift_rows,
           (SELECT sum(drift_score) FROM report) AS drift_total
    FROM rolled r JOIN summary s ON r.target = s.target AND r.model = s.model GROUP BY r.target, r.model"""


def write_dashboard(spark, sf):
    """All three parts as written: rows of the fact table beside the summary and the drift report."""
    path = scratch_path(spark, "dashboard")
    monitoring.all_dashboards(
        predictions(spark, sf), feature_file(spark, sf), daily=True, feature_keys=["series_id"], output=path
    )
    fact = spark.read.option("header", True).csv(f"{path}/fact")
    summary = spark.read.json(f"{path}/summary")
    drift_rows = spark.read.option("header", True).option("inferSchema", True).csv(f"{path}/drift")
    pairs = fact.groupBy("target", "model").agg(
        F.count("*").alias("n_rows"),
        F.to_date(F.min("date")).alias("first_date"),
        F.to_date(F.max("date")).alias("last_date"),
    )
    return pairs.join(summary, ["target", "model"]).select(
        *pairs.columns,
        "overall_rmse",
        "stability_index",
        "features_with_drift",
        drift_rows.agg(F.count("*")).scalar().alias("drift_rows"),
        drift_rows.agg(F.sum("drift_score")).scalar().alias("drift_total"),
    )


# --- filters, projections, catalog ----------------------------------------------------

THRESHOLD = 300_000.0
RANGE = datetime.date(1997, 1, 1), datetime.date(1997, 12, 31)


@query("sql_sample", f"WITH {sq.BEHAVIOR} SELECT * FROM behavior ORDER BY customer_id LIMIT 5")
def sql_sample(spark, sf):
    return rp.sample_rows(fx.behavior(spark, sf), ["customer_id"])


@query(
    "sql_filter_event",
    f"WITH {sq.BEHAVIOR} SELECT * FROM behavior WHERE outflow_event = 1 ORDER BY customer_id LIMIT 10",
)
def sql_filter_event(spark, sf):
    return rp.filter_event(fx.behavior(spark, sf), "outflow_event", ["customer_id"])


@query(
    "sql_filter_threshold",
    f"""WITH {sq.RATES} SELECT * FROM rates_raw WHERE value > {THRESHOLD}
    ORDER BY date DESC, series_id LIMIT 10""",
)
def sql_filter_threshold(spark, sf):
    newest = [F.desc("date"), F.col("series_id")]
    return rp.filter_threshold(fx.rates_raw(spark, sf), "value", THRESHOLD, newest)


@query(
    "sql_date_range_closed",
    f"""WITH {sq.RATES} SELECT * FROM rates_raw WHERE date >= DATE '1997-01-01' AND date <= DATE '1997-12-31'
    ORDER BY date, series_id LIMIT 10""",
)
def sql_date_range_closed(spark, sf):
    return rp.date_range_closed(fx.rates_raw(spark, sf), *RANGE, ["date", "series_id"])


@query(
    "sql_date_from",
    f"""WITH {sq.BEHAVIOR} SELECT * FROM behavior WHERE date >= DATE '1997-01-01'
    ORDER BY date, customer_id LIMIT 10""",
)
def sql_date_from(spark, sf):
    return rp.date_from(fx.behavior(spark, sf), RANGE[0], ["date", "customer_id"])


@query("business_days", f"WITH {sq.RATES} SELECT * FROM rates WHERE isodow(date) < 6")
def business_days(spark, sf):
    return grid.business_days(fx.rates(spark, sf))


def wide_sql() -> str:
    columns = ", ".join(
        f"max(\"{c}\") FILTER (series_id = '{series}') AS \"{name}_{c}\""
        for series, name in fx.SERIES.items()
        for c in sq.VALUE_FEATURES
    )
    raw = ", ".join(f"max(value) FILTER (series_id = '{s}') AS {name}" for s, name in fx.SERIES.items())
    return f"""{sq.FEATURES},
    tagged AS (SELECT *, roll_mean_7 - roll_mean_30 AS ma_crossover FROM steps),
    wide AS (SELECT date, {raw}, {columns} FROM tagged GROUP BY date
             QUALIFY row_number() OVER (ORDER BY date) > 10)"""


PREPARED = [f"{n}_{c}" for n in fx.SERIES.values() for c in sq.VALUE_FEATURES]
WIDE_DIGITS = {f"{n}_{c}": d for n in fx.SERIES.values() for c, d in sq.INEXACT.items() if c in sq.VALUE_FEATURES}
WIDE_DIGITS |= {c: d for c, d in sq.INEXACT.items() if c in sq.CALENDAR}


@query(
    "prepare_ml",
    f"""WITH {wide_sql()}
    SELECT w.date, {", ".join(f'w."{c}"' for c in PREPARED)}, c.* EXCLUDE (date), w.urgent
    FROM wide w JOIN calendar c ON w.date = c.date
    WHERE {" AND ".join(f'w."{c}" IS NOT NULL' for c in [*PREPARED, "urgent"])}""",
    WIDE_DIGITS,
)
def prepare_ml(spark, sf):
    return prepare.prepare_ml(wide_features(spark, sf), "urgent", list(fx.SERIES.values()))


@query(
    "numeric_columns",
    """WITH days AS (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS orders, count(DISTINCT o_custkey) AS customers,
                            CAST(max(o_custkey) AS DOUBLE) AS last_customer FROM orders GROUP BY 1)
    SELECT 'orders' AS series_id, date, CAST(orders AS DOUBLE) AS value FROM days
    UNION ALL SELECT 'customers', date, customers FROM days
    UNION ALL SELECT 'last_customer', date, last_customer FROM days""",
)
def numeric_columns(spark, sf):
    """Without named columns all 64-bit numeric ones are series; text and dates are not."""
    day = F.to_date("o_orderdate").alias("date")
    wide = fx.table(spark, sf, "orders").groupBy(day).agg(
        F.count("*").alias("orders"),
        F.count_distinct("o_custkey").alias("customers"),
        F.max("o_custkey").cast("double").alias("last_customer"),
        F.max("o_orderstatus").alias("status"),
        F.max("o_custkey").cast("int").alias("narrow"),
    )
    return features.long_series(wide)


@query(
    "prepare_behavioral",
    f"""WITH {sq.CUSTOMERS},
    coded AS (SELECT *, CAST(dense_rank() OVER (ORDER BY customer_segment) - 1 AS INTEGER) AS code FROM customers)
    SELECT customer_id, code AS customer_segment, account_age_months, base_balance, balance_volatility,
           seasonal_factor, interest_rate_level, economic_stress, market_volatility, num_products,
           transaction_frequency, credit_score, outflow_probability, early_repayment_probability,
           balance_volatility * economic_stress AS volatility_stress,
           interest_rate_level * economic_stress AS rate_stress,
           base_balance / (balance_volatility + 1e-6) AS balance_vol_ratio,
           credit_score * (account_age_months / 12) AS credit_age,
           balance_volatility * balance_volatility AS volatility_sq, economic_stress * economic_stress AS stress_sq,
           (credit_score - 700) / 50 AS credit_score_norm, outflow_event
    FROM coded WHERE market_volatility IS NOT NULL AND balance_volatility IS NOT NULL""",
    {"outflow_probability": 10, "early_repayment_probability": 10},
)
def prepare_behavioral(spark, sf):
    return prepare.prepare_behavioral(settle(customers(spark, sf)), "outflow_event")


@query(
    "drop_warmup",
    f"""WITH {sq.RATES} SELECT series_id, date, value FROM rates
    QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY date) > 10""",
)
def drop_warmup(spark, sf):
    return features.drop_warmup(fx.rates(spark, sf), daily=True)


@query(
    "predictions_long",
    f"""WITH {sq.PREDICTIONS} SELECT target, date, model, actual, predicted FROM predictions
    UNION ALL SELECT p.target, p.date, 'ma7', p.actual, NULL FROM predictions p
    LEFT JOIN predictions q ON p.target = q.target AND p.date = q.date AND q.model = 'ma7'
    WHERE p.model = 'naive' AND q.target IS NULL""",
    {"predicted": 3},
)
def predictions_long(spark, sf):
    wide = writers.predictions_wide(predictions(spark, sf), ["naive", "ma7"])
    return monitor.predictions_long(wide, ["naive", "ma7"], ["target", "date", "actual"])


def structure_sql() -> str:
    types = {
        "customer_id": "bigint", "date": "date", "customer_segment": "string", "account_age_months": "int",
        "base_balance": "double", "balance_volatility": "double", "interest_rate_level": "double",
        "economic_stress": "double", "market_volatility": "double", "num_products": "int",
        "transaction_frequency": "double", "credit_score": "double", "outflow_event": "int",
        "early_repayment_event": "int",
    }
    frames = {"behavioral_data": ("behavior", types)}
    frames |= {name: (name, {"date": "date", "value": "double"}) for name in sq.DAILY}
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, {i} AS position, '{c}' AS column_name, '{t}' AS data_type,
        count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS distinct_values, true AS estimate_near FROM {view}"""
        for name, (view, columns) in frames.items()
        for i, (c, t) in enumerate(columns.items())
    )


@query("table_structure", f"WITH {sq.BEHAVIOR}, {sq.DAILY_SQL} {structure_sql()}")
def table_structure(spark, sf):
    sources = {"behavioral_data": fx.behavior(spark, sf), **daily_tables(spark, sf)}
    parts = []
    for name, df in sources.items():
        df = settle(df)
        found = profile.table_structure(df, name, distinct=True)
        counted = df.agg(F.array(*[F.count_distinct(c) for c in df.columns])).scalar()
        exact = F.get(counted, F.col("position"))
        # Five standard deviations of the estimate.
        near = F.abs(F.col("approx_distinct") - exact) <= 5 * profile.DISTINCT_ERROR * exact
        parts.append(found.select(*found.columns[:-1], exact.alias("distinct_values"), near.alias("estimate_near")))
    return reduce(DataFrame.unionByName, parts)


DESCRIBED = [
    "account_age_months", "base_balance", "balance_volatility", "interest_rate_level", "economic_stress",
    "market_volatility", "num_products", "transaction_frequency", "credit_score",
]


@query(
    "describe_numeric",
    f"WITH {sq.BEHAVIOR} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std,
        CAST(min({c}) AS DOUBLE) AS min, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q25,
        quantile_cont(CAST({c} AS DOUBLE), 0.5) AS q50, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q75,
        CAST(max({c}) AS DOUBLE) AS max FROM behavior"""
        for c in DESCRIBED
    ),
    {"mean": 6, "std": 6, "q25": 8, "q50": 8, "q75": 8},
)
def describe_numeric(spark, sf):
    return profile.describe_numeric(behavior_table(spark, sf), DESCRIBED)


@query(
    "date_key_check",
    """WITH k AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY ALL)
    SELECT CAST(sum(n) AS BIGINT) AS n_rows,
           CAST(coalesce(sum(n) FILTER (o_orderpriority IS NULL OR d IS NULL), 0) AS BIGINT) AS null_key_rows,
           count(*) FILTER (n > 1) AS duplicate_keys,
           CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS duplicate_key_rows FROM k""",
)
def date_key_check(spark, sf):
    orders = fx.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("series_id"), F.to_date("o_orderdate").alias("date")
    )
    return grid.date_key_check(orders)


# --- joins ----------------------------------------------------------------------------


def joined_sql(tail: str) -> str:
    return f"""WITH {sq.DAILY_SQL}
    SELECT o.date, o.value AS orders_daily, s.value AS shipments_daily
    FROM orders_daily o JOIN shipments_daily s ON o.date = s.date {tail}"""


PAIR = ("orders_daily", "shipments_daily")


@query("join_series_recent", joined_sql("ORDER BY o.date DESC LIMIT 10"))
def join_series_recent(spark, sf):
    t = daily_tables(spark, sf)
    return rp.join_series_recent(t[PAIR[0]], t[PAIR[1]], PAIR)


@query("join_series_range", joined_sql("WHERE o.date >= DATE '1997-01-01' ORDER BY o.date LIMIT 10"))
def join_series_range(spark, sf):
    t = daily_tables(spark, sf)
    return rp.join_series_range(t[PAIR[0]], t[PAIR[1]], PAIR, RANGE[0])


@query(
    "align_series",
    f"WITH {sq.RATES} SELECT date, "
    + ", ".join(f"max(value) FILTER (series_id = '{s}') AS \"{s}\"" for s in fx.SERIES)
    + " FROM rates_raw GROUP BY date",
)
def align_series(spark, sf):
    return features.align_series(fx.rates_raw(spark, sf), list(fx.SERIES))


# --- aggregations ---------------------------------------------------------------------


@query("count_rows", f"WITH {sq.BEHAVIOR} SELECT count(*) AS total_rows FROM behavior")
def count_rows(spark, sf):
    return rp.count_rows(fx.behavior(spark, sf))


@query(
    "union_counts",
    """SELECT 'orders' AS table_name, count(*) AS count FROM orders
    UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'customer', count(*) FROM customer""",
)
def union_counts(spark, sf):
    return rp.union_counts({n: fx.table(spark, sf, n) for n in ("orders", "lineitem", "customer")})


@query(
    "count_by_segment",
    f"WITH {sq.BEHAVIOR} SELECT customer_segment, count(*) AS count FROM behavior GROUP BY customer_segment",
)
def count_by_segment(spark, sf):
    return rp.count_by_segment(fx.behavior(spark, sf), "customer_segment")


@query(
    "segment_share",
    f"""WITH {sq.BEHAVIOR} SELECT customer_segment, count(*) AS count,
    CAST(round(100.0 * count(*) / (SELECT count(*) FROM behavior), 2) AS DOUBLE) AS percentage
    FROM behavior GROUP BY customer_segment""",
)
def segment_share(spark, sf):
    return rp.segment_share(fx.behavior(spark, sf), "customer_segment")


@query(
    "avg_volatility_by_segment",
    f"""WITH {sq.BEHAVIOR} SELECT customer_segment, avg(balance_volatility) AS avg_volatility
    FROM behavior GROUP BY customer_segment""",
    {"avg_volatility": 10},
)
def avg_volatility_by_segment(spark, sf):
    return rp.average_by_segment(fx.behavior(spark, sf), "customer_segment", "balance_volatility", "avg_volatility")


@query(
    "range_stats",
    f"""WITH {sq.RATES} SELECT series_id, count(*) AS count, min(value) AS min_rate, max(value) AS max_rate,
    avg(value) AS avg_rate FROM rates_raw WHERE date >= DATE '1997-01-01' AND date < DATE '1998-01-01'
    GROUP BY series_id""",
    {"avg_rate": 3},
)
def range_stats(spark, sf):
    return rp.range_stats(fx.rates_raw(spark, sf), RANGE[0], datetime.date(1998, 1, 1), ["series_id"])


@query(
    "date_span",
    f"""WITH {sq.RATES} SELECT series_id, min(date) AS min_date, max(date) AS max_date, count(*) AS count
    FROM rates_raw GROUP BY series_id""",
)
def date_span(spark, sf):
    return rp.date_span(fx.rates_raw(spark, sf), ["series_id"])


@query(
    "class_balance",
    f"WITH {sq.BEHAVIOR}"
    + " UNION ALL ".join(
        f""" SELECT '{t}' AS target, {t} AS label, count(*) AS n,
        (SELECT avg({t}) * 100 FROM behavior) AS positive_rate_pct FROM behavior GROUP BY {t}"""
        for t in prepare.LABELS
    ),
    {"positive_rate_pct": 8},
)
def class_balance(spark, sf):
    return rp.class_balance(fx.behavior(spark, sf), prepare.LABELS)


@query("regression_metrics", f"WITH {sq.METRICS} SELECT * FROM metrics", {"rmse": 3, "mae": 3})
def regression_metrics(spark, sf):
    return evaluate.regression_metrics(predictions(spark, sf))


@query(
    "best_baseline",
    f"""WITH {sq.METRICS} SELECT target, arg_min(model, rmse) AS best_model, min(rmse) AS rmse,
    arg_min(mae, rmse) AS mae FROM metrics GROUP BY target""",
    {"rmse": 3, "mae": 3},
)
def best_baseline(spark, sf):
    return evaluate.best_baseline(evaluate.regression_metrics(predictions(spark, sf)))


@query(
    "improvement_vs_baseline",
    f"""WITH {sq.METRICS}, best AS (SELECT target, arg_min(model, rmse) AS baseline_model, min(rmse) AS baseline_rmse
    FROM metrics GROUP BY target)
    SELECT m.target, m.model, m.rmse, m.mae, b.baseline_model, b.baseline_rmse,
           (b.baseline_rmse - m.rmse) / b.baseline_rmse * 100 AS improvement_pct
    FROM metrics m JOIN best b ON m.target = b.target""",
    {"rmse": 3, "mae": 3, "baseline_rmse": 3, "improvement_pct": 6},
)
def improvement_vs_baseline(spark, sf):
    metrics = evaluate.regression_metrics(predictions(spark, sf))
    return evaluate.improvement_vs_baseline(metrics, evaluate.best_baseline(metrics))


@query(
    "best_auc_gate",
    f"""WITH {sq.STEPS}, aucs AS (SELECT model, sum(neg * (tp - pos + pos / 2)) / (sum(pos) * sum(neg)) AS auc
    FROM steps GROUP BY model) SELECT max(auc) AS best_auc, max(auc) > 0.75 AS validated FROM aucs""",
    {"best_auc": 10},
)
def best_auc_gate(spark, sf):
    return evaluate.best_auc_gate(curves.roc_auc(fx.scored(spark, sf)))


SCORE_DIGITS = {"overall_rmse": 3, "mean_rolling_rmse": 3, "std_rolling_rmse": 3, "stability_index": 8}


@query(
    "stability_index",
    f"""WITH {sq.MONITORING} SELECT target, model, overall_rmse, mean_rolling_rmse, std_rolling_rmse, stability_index
    FROM scores""",
    SCORE_DIGITS,
)
def stability_index(spark, sf):
    return evaluate.stability_index(evaluate.rolling_rmse(predictions(spark, sf), daily=True))


SUMMARY_SQL = f"""WITH {sq.MONITORING.replace("scores AS", "stability AS").replace("steps AS", "steps_ AS")},
    {sq.FEATURE_DRIFT.replace(sq.RATES + ",", "", 1)}
    SELECT target, model, overall_rmse, mean_rolling_rmse, std_rolling_rmse, stability_index,
           (SELECT count(*) FROM report WHERE drift_status = 'Significant') AS features_with_drift,
           (SELECT count(*) FROM report) AS total_features,
           (SELECT count(*) FILTER (drift_status = 'Significant') / count(*) FROM report) AS drift_rate
    FROM stability"""


@query("monitoring_summary", SUMMARY_SQL, {**SCORE_DIGITS, "drift_rate": 10})
def monitoring_summary(spark, sf):
    board = monitoring.all_dashboards(
        predictions(spark, sf), feature_file(spark, sf), daily=True, feature_keys=["series_id"]
    )
    return board.summary


query("write_dashboard", dashboard_sql(), {"overall_rmse": 3, "stability_index": 8, "drift_total": 6})(write_dashboard)


# --- window features ------------------------------------------------------------------


def feature_query(name: str, columns: list[str], build):
    """A query of some value features on every series, without dropping the first rows."""
    digits = {c: d for c, d in sq.INEXACT.items() if c in columns}
    quoted = ", ".join(f'"{c}"' for c in columns)
    source = "SELECT *, roll_mean_7 - roll_mean_30 AS ma_crossover FROM steps"

    @query(name, f"WITH {sq.FEATURES} SELECT series_id, date, {quoted} FROM ({source}) AS s", digits)
    def run(spark, sf):
        out = row_windows(fx.rates(spark, sf), ["series_id"], "date", 29, build, daily=True)
        return out.select("series_id", "date", *columns)

    return run


feature_query("lags", ["lag1", "lag5", "lag10"], lambda w: features.lags("value", w))
feature_query("rolling_mean", ["roll_mean_7", "roll_mean_30"], lambda w: features.rolling("value", w))
feature_query("rolling_std", ["roll_std_7", "roll_std_30"], lambda w: features.rolling("value", w))
feature_query("returns", ["return", "diff_pct"], lambda w: features.changes("value", w))
feature_query("return_lag1", ["return_lag1"], lambda w: features.changes("value", w))
feature_query("diff", ["diff"], lambda w: features.changes("value", w))


@query(
    "ma_crossover",
    f"WITH {sq.FEATURES} SELECT series_id, date, roll_mean_7 - roll_mean_30 AS ma_crossover FROM steps",
    {"ma_crossover": 3},
)
def ma_crossover(spark, sf):
    return features.time_features(fx.rates(spark, sf), daily=True).select(*KEY, "ma_crossover")


@query("all_features", f"WITH {sq.FEATURES} SELECT * FROM features", sq.INEXACT)
def all_features(spark, sf):
    return long_features(spark, sf)


@query(
    "engineer_features",
    f"WITH {sq.FEATURES} SELECT * FROM features",
    sq.INEXACT,
)
def engineer_features(spark, sf):
    source, target = scratch_path(spark, "rates-csv"), scratch_path(spark, "features")
    writers.write_features(fx.rates_raw(spark, sf), source, fmt="csv")
    return rates.engineer_features(spark, source, target)


ROLLED_SQL = f"WITH {sq.MONITORING} SELECT * FROM rolled"


def framed_rates(spark, sf):
    """The clean rates as a table laid out for windows of up to 30 rows."""
    name = scratch_path(spark, "framed")
    table = "framed_" + name[-32:]
    return store_framed(fx.rates(spark, sf), table, ["series_id"], "date", 30, buckets=8, daily=True, path=name)


@query("all_features_laid_out", f"WITH {sq.FEATURES} SELECT * FROM features", sq.INEXACT)
def all_features_laid_out(spark, sf):
    return features.all_features(framed_rates(spark, sf), daily=True)


@query("rolling_rmse", ROLLED_SQL, {"predicted": 3, "rolling_rmse": 3})
def rolling_rmse(spark, sf):
    return evaluate.rolling_rmse(predictions(spark, sf), daily=True)


@query(
    "sequences",
    f"""WITH {sq.FEATURES},
    lists AS (SELECT series_id, date, list(date) OVER w AS dates, list(value) OVER w AS vs, list("diff") OVER w AS ds,
                     value AS y FROM features
              WINDOW w AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))
    SELECT series_id, date, CAST(len(dates) AS INTEGER) AS n, dates[1] AS first_date, vs[1] AS first_value,
           ds[1] AS first_diff, dates[30] AS last_date, vs[30] AS last_value, ds[30] AS last_diff, y,
           list_sum(list_transform(range(1, 31), lambda i: i * vs[i])) AS all_values,
           list_sum(list_transform(range(1, 31), lambda i: i * ds[i])) AS all_diffs,
           CAST(list_sum(list_transform(range(1, 31), lambda i: i * datediff('day', DATE '1990-01-01', dates[i]))) AS BIGINT) AS all_dates
    FROM lists WHERE len(dates) = 30""",
    {"all_values": 2, "all_diffs": 2},
)
def sequences(spark, sf):
    """Ends of each sequence, and sums over all its elements, each times its place."""
    seq = features.sequences(long_features(spark, sf), ["diff"], "value", daily=True)
    x = F.col("x")

    def over_all(cell, start):
        placed = F.transform(x, lambda e, i: cell(e) * (i + 1))
        return F.aggregate(placed, start, lambda total, v: total + v)

    return seq.select(
        *KEY,
        F.size(x).alias("n"),
        x[0]["date"].alias("first_date"),
        x[0]["v"][0].alias("first_value"),
        x[0]["v"][1].alias("first_diff"),
        x[29]["date"].alias("last_date"),
        x[29]["v"][0].alias("last_value"),
        x[29]["v"][1].alias("last_diff"),
        "y",
        over_all(lambda e: e["v"][0], F.lit(0.0)).alias("all_values"),
        over_all(lambda e: e["v"][1], F.lit(0.0)).alias("all_diffs"),
        over_all(lambda e: F.datediff(e["date"], F.lit(datetime.date(1990, 1, 1))).cast("bigint"), F.lit(0).cast("bigint")).alias("all_dates"),
    )


@query(
    "chrono_split",
    f"""WITH {sq.RATES} SELECT series_id, date, value,
    CASE WHEN row_number() OVER (PARTITION BY series_id ORDER BY date)
              <= floor(count(*) OVER (PARTITION BY series_id) * 8e-1) THEN 'train' ELSE 'test' END AS split
    FROM rates_raw""",
)
def split_by_time(spark, sf):
    return chrono_split(fx.rates_raw(spark, sf))


TICKS_SQL = """ticks AS (SELECT event_type AS series_id, ts, value FROM events),
tick_grid AS (SELECT series_id, unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)),
              INTERVAL 1 DAY)) AS midnight FROM ticks GROUP BY series_id),
tick_days AS (SELECT g.series_id, CAST(g.midnight AS DATE) AS date, t.value
              FROM tick_grid g ASOF LEFT JOIN ticks t ON g.series_id = t.series_id AND g.midnight >= t.ts)"""


def ticks(spark, sf):
    return fx.table(spark, sf, "events").select(F.col("event_type").alias("series_id"), "ts", "value")


@query("uniform_calendar", f"WITH {TICKS_SQL} SELECT series_id, date, value FROM tick_days")
def uniform_calendar(spark, sf):
    return grid.uniform_calendar(ticks(spark, sf))


@query(
    "fill_missing",
    f"""WITH {sq.RATES}, {TICKS_SQL},
    gaps AS (SELECT g.series_id, g.date, r.value FROM grid g LEFT JOIN rates_raw r
             ON g.series_id = r.series_id AND g.date = r.date UNION ALL SELECT * FROM tick_days)
    SELECT series_id, date, coalesce(
        last_value(value IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY date),
        first_value(value IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY date
          ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS value FROM gaps""",
)
def fill_missing(spark, sf):
    raw = fx.rates_raw(spark, sf)
    gaps = fx.rates(spark, sf).select(*KEY).join(raw, KEY, "left")
    return grid.fill_missing(gaps.unionByName(grid.uniform_calendar(ticks(spark, sf))))


@query("preprocess_rates", f"WITH {sq.RATES} SELECT series_id, date, value FROM rates")
def preprocess_rates(spark, sf):
    return rates.preprocess_rates(fx.rates_raw(spark, sf), ts="date")


# --- scalars --------------------------------------------------------------------------


def scalar_query(name: str, sql: str, build, digits: int | None = None, source="behavior"):
    rounding = {name: digits} if digits else None

    @query(name, f"WITH {sq.BEHAVIOR} SELECT customer_id, {sql} AS {name} FROM behavior", rounding)
    def run(spark, sf):
        return fx.behavior(spark, sf).select("customer_id", build().alias(name))

    return run


_c = F.col
scalar_query(
    "volatility_stress",
    "balance_volatility * economic_stress",
    lambda: sc.volatility_stress(_c("balance_volatility"), _c("economic_stress")),
)
scalar_query(
    "rate_stress",
    "interest_rate_level * economic_stress",
    lambda: sc.rate_stress(_c("interest_rate_level"), _c("economic_stress")),
)
scalar_query(
    "balance_vol_ratio",
    "base_balance / (balance_volatility + 1e-6)",
    lambda: sc.balance_vol_ratio(_c("base_balance"), _c("balance_volatility")),
)
scalar_query(
    "credit_age",
    "credit_score * (account_age_months / 12)",
    lambda: sc.credit_age(_c("credit_score"), _c("account_age_months")),
)
scalar_query("volatility_sq", "balance_volatility * balance_volatility", lambda: sc.squared(_c("balance_volatility")))
scalar_query("stress_sq", "economic_stress * economic_stress", lambda: sc.squared(_c("economic_stress")))
scalar_query("credit_score_norm", "(credit_score - 700) / 50", lambda: sc.credit_score_norm(_c("credit_score")))
scalar_query(
    "seasonal_factor", sq.SEASONAL, lambda: sc.seasonal_factor(_c("customer_segment"), _c("date"), fx.RETAIL)
)
scalar_query("clip", "least(greatest(base_balance, 1e3), 5e3)", lambda: sc.clip(_c("base_balance"), 1e3, 5e3))


@query(
    "logistic_risk_score",
    f"""WITH {sq.BEHAVIOR} SELECT customer_id, {sq.OUTFLOW} AS outflow_probability,
    {sq.REPAYMENT} AS early_repayment_probability FROM behavior""",
    {"outflow_probability": 10, "early_repayment_probability": 10},
)
def logistic_risk_score(spark, sf):
    balance = sc.clip(F.col("base_balance"), 1e3, 1e7)
    return fx.behavior(spark, sf).select(
        "customer_id",
        outflow(balance).alias("outflow_probability"),
        repayment().alias("early_repayment_probability"),
    )


def calendar_query(name: str, columns: list[str], build):
    digits = {c: d for c, d in sq.INEXACT.items() if c in columns}

    @query(
        name,
        f"""WITH {sq.FEATURES} SELECT r.series_id, r.date, {", ".join("c." + c for c in columns)}
        FROM rates r JOIN calendar c ON r.date = c.date""",
        digits,
    )
    def run(spark, sf):
        return fx.rates(spark, sf).select(*KEY, *[e.alias(c) for c, e in build(F.col("date")).items()])

    return run


calendar_query("calendar_fields", list(sq.CALENDAR[:7]), cal.calendar_fields)
calendar_query("cyclical_encoding", list(sq.CALENDAR[7:11]), cal.cyclical_encoding)
calendar_query("calendar_flags", list(sq.CALENDAR[11:]), cal.calendar_flags)


@query(
    "label_encode",
    f"""WITH {sq.BEHAVIOR} SELECT customer_id, customer_segment,
    CAST(dense_rank() OVER (ORDER BY customer_segment) - 1 AS INTEGER) AS customer_segment_code FROM behavior""",
)
def label_encode(spark, sf):
    rows = behavior_table(spark, sf).select("customer_id", "customer_segment")
    return prepare.label_encode(rows, ["customer_segment"], suffix="_code")


@query(
    "dashboard_fields",
    f"""WITH {sq.PREDICTIONS} SELECT target, date, model, actual - predicted AS error,
    abs(actual - predicted) AS error_abs, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
    CAST(quarter(date) AS INTEGER) AS quarter, strftime(date, '%Y-%m') AS year_month FROM predictions""",
    {"error": 3, "error_abs": 3},
)
def dashboard_fields(spark, sf):
    rows = predictions(spark, sf).withColumns(monitor.dashboard_fields())
    return rows.drop("actual", "predicted")


@query(
    "normalize_series",
    f"""WITH {sq.RATES} SELECT series_id, date, value,
    (value - avg(value) OVER s) / nullif(stddev_samp(value) OVER s, 0) AS zscore,
    coalesce((value - min(value) OVER s) / nullif(max(value) OVER s - min(value) OVER s, 0), 0) AS minmax
    FROM rates WINDOW s AS (PARTITION BY series_id)""",
    {"zscore": 8, "minmax": 10},
)
def normalize_series(spark, sf):
    return scaling.normalize_series(fx.rates(spark, sf))


@query(
    "minmax_scale",
    f"""WITH {sq.BEHAVIOR}, b AS (SELECT min(base_balance) AS lo, max(base_balance) AS hi,
      min(credit_score) AS lc, max(credit_score) AS hc FROM behavior)
    SELECT customer_id, coalesce((base_balance - lo) / nullif(hi - lo, 0), 0) AS base_balance_scaled,
           coalesce((credit_score - lc) / nullif(hc - lc, 0), 0) AS credit_score_scaled,
           (base_balance - lo) / (hi - lo) * (hi - lo) + lo AS base_balance_back
    FROM behavior, b""",
    {"base_balance_scaled": 10, "credit_score_scaled": 10, "base_balance_back": 6},
)
def minmax_scale(spark, sf):
    rows = fx.behavior(spark, sf).select("customer_id", "base_balance", "credit_score")
    bounds = scaling.column_bounds(rows, ["base_balance"]).scalar()
    scaled = scaling.minmax_scale(rows, ["base_balance", "credit_score"]).withColumn("_b", bounds)
    back = scaling.minmax_inverse(F.col("base_balance_scaled"), F.col("_b")["low"], F.col("_b")["high"])
    return scaled.select(
        "customer_id", "base_balance_scaled", "credit_score_scaled", back.alias("base_balance_back")
    )


# --- statistics -----------------------------------------------------------------------


@query(
    "psi",
    f"WITH {sq.drift(sq.LINE_DRIFT)} SELECT feature, psi, n_train, n_test FROM scores",
    {"psi": 10},
)
def psi(spark, sf):
    return drift.psi(line_split(spark, sf), LINE_COLUMNS)


REPORT_DIGITS = {"drift_score": 8, "train_mean": 3, "test_mean": 3, "mean_diff_pct": 3}


@query("feature_drift", f"WITH {sq.FEATURE_DRIFT} SELECT * FROM report", REPORT_DIGITS)
def feature_drift(spark, sf):
    return monitoring.drift_report(feature_file(spark, sf), ["series_id"])


@query(
    "top_drift",
    f"""WITH {sq.FEATURE_DRIFT} SELECT * FROM report WHERE drift_status = 'Significant'
    ORDER BY drift_score DESC, feature LIMIT 5""",
    REPORT_DIGITS,
)
def top_drift(spark, sf):
    return drift.top_drift(monitoring.drift_report(feature_file(spark, sf), ["series_id"]))


@query(
    "ks_drift",
    f"""WITH {sq.LINE_DRIFT},
    v AS (SELECT feature, value, count(*) FILTER (is_train) AS a, count(*) FILTER (NOT is_train) AS b
          FROM long WHERE value IS NOT NULL GROUP BY feature, value),
    f AS (SELECT feature, sum(a) OVER w / sum(a) OVER (PARTITION BY feature) AS fa,
                 sum(b) OVER w / sum(b) OVER (PARTITION BY feature) AS fb
          FROM v WINDOW w AS (PARTITION BY feature ORDER BY value))
    SELECT f.feature, max(abs(fa - fb)) AS ks, any_value(n_train) AS n_train, any_value(n_test) AS n_test
    FROM f JOIN (SELECT feature, CAST(sum(a) AS BIGINT) AS n_train, CAST(sum(b) AS BIGINT) AS n_test
                 FROM v GROUP BY feature) t ON f.feature = t.feature GROUP BY f.feature""",
    {"ks": 10},
)
def ks_drift(spark, sf):
    return drift.ks_statistic(line_split(spark, sf), LINE_COLUMNS).select("feature", "ks", "n_train", "n_test")


KS_SQL = f"""WITH {sq.FEATURE_LONG},
    v AS (SELECT feature, value, count(*) FILTER (is_train) AS a, count(*) FILTER (NOT is_train) AS b
          FROM long WHERE value IS NOT NULL GROUP BY feature, value),
    f AS (SELECT feature, value, a, b, sum(a) OVER w / sum(a) OVER (PARTITION BY feature) AS fa,
                 sum(b) OVER w / sum(b) OVER (PARTITION BY feature) AS fb
          FROM v WINDOW w AS (PARTITION BY feature ORDER BY value)),
    g AS (SELECT feature, max(abs(fa - fb)) AS ks, sum(a) AS n, sum(b) AS m, sum(value * a) / sum(a) AS train_mean,
                 sum(value * b) / sum(b) AS test_mean FROM f GROUP BY feature),
    p AS (SELECT *, list_sum(list_transform(range(1, 101), lambda k: 2 * (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END)
                 * exp(-2 * k * k * ks * ks * n * m / (n + m)))) AS tail FROM g)
    SELECT feature, ks AS drift_score, CASE WHEN tail < 0.05 AND ks * sqrt(n * m / (n + m)) >= 0.1
           THEN 'Significant' ELSE 'Stable' END AS drift_status, train_mean, test_mean,
           abs((test_mean - train_mean) / (train_mean + 1e-10)) * 100 AS mean_diff_pct FROM p"""


# Neither sample has over 10,000 values here, so the operator's p-values are exact; SQL decides
# by the asymptotic ones, which only near the level of the test could differ.
@query("ks_report", KS_SQL, {**REPORT_DIGITS, "drift_score": 10})
def ks_report(spark, sf):
    return monitoring.drift_report(feature_file(spark, sf), ["series_id"], method="ks")


@query(
    "roc_auc",
    f"""WITH {sq.STEPS} SELECT model, sum(neg * (tp - pos + pos / 2)) / (sum(pos) * sum(neg)) AS auc
    FROM steps GROUP BY model""",
    {"auc": 10},
)
def roc_auc(spark, sf):
    return curves.roc_auc(fx.scored(spark, sf))


@query(
    "average_precision",
    f"""WITH {sq.STEPS} SELECT model, sum(pos / p * tp / (tp + fp)) AS average_precision FROM steps GROUP BY model""",
    {"average_precision": 10},
)
def average_precision(spark, sf):
    return curves.average_precision(fx.scored(spark, sf))


@query(
    "roc_curve",
    f"""WITH {sq.STEPS} SELECT model, score AS threshold, fp / n AS fpr, tp / p AS tpr FROM steps
    UNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), 0e0, 0e0 FROM scored""",
    {"fpr": 10, "tpr": 10},
)
def roc_curve(spark, sf):
    return curves.roc_curve(fx.scored(spark, sf))


@query(
    "pr_curve",
    f"""WITH {sq.STEPS} SELECT model, score AS threshold, tp / (tp + fp) AS precision, tp / p AS recall FROM steps
    UNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), 1e0, 0e0 FROM scored""",
    {"precision": 10, "recall": 10},
)
def pr_curve(spark, sf):
    return curves.pr_curve(fx.scored(spark, sf))


@query(
    "score_histogram",
    f"""WITH {sq.SCORED}, s AS (SELECT model, label, min(score) AS lo, max(score) AS hi, count(*) AS total
      FROM scored GROUP BY model, label),
    b AS (SELECT model, label, lo, hi, total,
                 CAST(least(floor((score - lo) / (hi - lo) * 30), 29) AS INTEGER) AS bin
          FROM scored JOIN s USING (model, label))
    SELECT model, label, bin, lo + bin * ((hi - lo) / 30) AS lower, lo + (bin + 1) * ((hi - lo) / 30) AS upper,
           count(*) AS n, count(*) / (total * ((hi - lo) / 30)) AS density
    FROM b GROUP BY model, label, bin, lo, hi, total""",
    {"lower": 8, "upper": 8, "density": 8},
)
def score_histogram(spark, sf):
    return curves.score_histogram(fx.scored(spark, sf))


@query(
    "forecast_vs_actual",
    f"WITH {sq.PREDICTIONS} SELECT target, model, date, actual, predicted AS forecast FROM predictions",
    {"forecast": 3},
)
def forecast_vs_actual(spark, sf):
    return monitor.forecast_vs_actual(predictions(spark, sf))


@query(
    "stratified_split",
    f"""WITH {sq.BEHAVIOR} SELECT customer_id, early_repayment_event,
    CASE WHEN row_number() OVER (PARTITION BY early_repayment_event ORDER BY md5(concat(CAST(customer_id AS VARCHAR), ':42')))
              <= floor(count(*) OVER (PARTITION BY early_repayment_event) * 0.8e0) THEN 'train' ELSE 'test' END AS split
    FROM behavior""",
)
def run_stratified_split(spark, sf):
    rows = fx.behavior(spark, sf).select("customer_id", "early_repayment_event")
    return stratified_split(rows, "customer_id", "early_repayment_event")


@query(
    "hash_split",
    f"""WITH {sq.BEHAVIOR} SELECT customer_id, early_repayment_event,
    CASE WHEN md5(concat(CAST(customer_id AS VARCHAR), ':42')) < 'cccccccc' THEN 'train' ELSE 'test' END AS split
    FROM behavior""",
)
def run_hash_split(spark, sf):
    return hash_split(fx.behavior(spark, sf).select("customer_id", "early_repayment_event"), "customer_id")


@query(
    "stationarity",
    f"""WITH {sq.RATES}, s AS (SELECT series_id, value - lag(value) OVER w AS dy, lag(value) OVER w AS x
      FROM rates WINDOW w AS (PARTITION BY series_id ORDER BY date)),
    f AS (SELECT series_id, CAST(regr_count(dy, x) AS BIGINT) AS n, regr_slope(dy, x) AS slope, regr_sxx(dy, x) AS sxx,
                 regr_sxy(dy, x) AS sxy, regr_syy(dy, x) AS syy FROM s GROUP BY series_id)
    SELECT series_id, n, slope, slope / sqrt((syy - slope * sxy) / (n - 2) / sxx) AS t_stat,
           slope / sqrt((syy - slope * sxy) / (n - 2) / sxx) < -2.86 AS stationary FROM f""",
    {"slope": 8, "t_stat": 6},
)
def stationarity(spark, sf):
    return evaluate.stationarity(fx.rates(spark, sf), daily=True)


AUDIT_SQL = f"""WITH {sq.FEATURES},
    early AS (SELECT * FROM features WHERE date <= DATE '1998-06-30'),
    scaled AS (SELECT (value - (SELECT min(value) FROM features)) / (SELECT max(value) - min(value) FROM features) AS f,
                      (value - (SELECT min(value) FROM early)) / (SELECT max(value) - min(value) FROM early) AS s
               FROM early),
    counted AS (SELECT count(*) AS n, count(*) FILTER (f <> s) AS changed FROM scaled)
    SELECT feature, n AS rows_compared, CASE WHEN feature = 'value_scaled' THEN changed ELSE 0 END AS rows_changed,
           feature = 'value_scaled' AND changed > 0 AS uses_future
    FROM counted, (VALUES {", ".join(f"('{c}')" for c in ["value", *sq.VALUE_FEATURES, *sq.CALENDAR, "value_scaled"])}) AS f(feature)"""


@query("lookahead_audit", AUDIT_SQL)
def lookahead_audit(spark, sf):
    """All features, and beside them a column scaled on all rows, which does look ahead."""

    def build(rows: DataFrame) -> DataFrame:
        return scaling.minmax_scale(features.all_features(rows, daily=True), ["value"])

    return audit.lookahead_audit(settle(fx.rates(spark, sf)), build, datetime.date(1998, 6, 30))


# --- models -----------------------------------------------------------------------------

# The classifiers have all their trees. The regressors have stated cuts in the number of trees, passed
# as the functions' own arguments; depths, rates,
# shares and all else are the defaults, and rows, columns, targets and labels are whole. The
# README has the measured seconds. Only the forests of all targets are cut in depth too.
BOOSTING = {"trees": 8}
DEEP_FOREST = {"trees": 3}  # a default depth of 30 on few rows
SHALLOW_FOREST = {"trees": 10, "max_depth": 6}

REGRESS_SQL = f"""{wide_sql()},
    prepared AS (SELECT w.* FROM wide w JOIN calendar c ON w.date = c.date
                 WHERE {" AND ".join(f'w."{c}" IS NOT NULL' for c in PREPARED)})"""


def held_out_sql(target: str) -> str:
    """The last fifth of the prepared dates of a target."""
    return f"""SELECT date, "{target}" AS actual FROM prepared WHERE "{target}" IS NOT NULL
    QUALIFY row_number() OVER (ORDER BY date) > floor(count(*) OVER () * 0.8e0)"""


def customers_sql(label: str) -> str:
    """The customers beyond the first four fifths of each class, in the order of a hash."""
    return f"""SELECT customer_id, {label} AS label FROM customers
    WHERE market_volatility IS NOT NULL AND balance_volatility IS NOT NULL AND {label} IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY {label} ORDER BY md5(concat(CAST(customer_id AS VARCHAR), ':42')))
            > floor(count(*) OVER (PARTITION BY {label}) * 0.8e0)"""


PREDICTED_SQL = f"WITH {REGRESS_SQL} SELECT date, actual, true AS predicted_known, true AS beats_mean FROM ({held_out_sql('urgent')}) t"
SCORED_SQL = f"WITH {sq.CUSTOMERS} SELECT customer_id, label, true AS is_probability, true AS beats_chance FROM ({customers_sql('outflow_event')}) t"


def regress_rows(spark, sf):
    prepared = prepare.prepare_ml(settle(wide_features(spark, sf)), "urgent", list(fx.SERIES.values()))
    rows = settle(chrono_split(prepared, ()))
    columns = [c for c in prepared.columns if c not in ("date", "urgent")]
    return rows.filter("split = 'train'"), rows.filter("split = 'test'"), columns


def classify_rows(spark, sf):
    prepared = settle(prepare.prepare_behavioral(settle(customers(spark, sf)), "outflow_event"))
    rows = stratified_split(prepared, "customer_id", "outflow_event", stored=True)
    columns = [c for c in prepared.columns if c not in ("customer_id", "outflow_event")]
    train = models.with_class_weight(rows.filter("split = 'train'"), "outflow_event")
    return settle(train), rows.filter("split = 'test'"), columns


def regress(spark, sf, estimator):
    """Every test row with its actual value, and whether it has a prediction; whether the
    predictions are nearer than the mean of the test rows' actual values."""
    train, test, columns = regress_rows(spark, sf)
    out = settle(models.predict(models.fit(train, columns, estimator), test, ["date"], "urgent"))
    mean = out.agg(F.avg("actual")).scalar()
    gain = F.sum(F.pow(F.col("actual") - F.col("_mean"), 2) - F.pow(F.col("actual") - F.col("predicted"), 2)) > 0
    beats = out.withColumn("_mean", mean).agg(gain).scalar()
    known = F.col("predicted").isNotNull() & ~F.isnan("predicted")
    return out.select("date", "actual", known.alias("predicted_known"), beats.alias("beats_mean"))


def judged(scored: DataFrame) -> DataFrame:
    """Every test customer with the label, whether the score is a probability, and whether
    the area under the ROC curve is above one half."""
    scored = settle(scored)
    auc = curves.roc_auc(scored, ()).select("auc").scalar()
    valid = F.coalesce(F.col("score").between(0, 1), F.lit(False))
    return scored.select("customer_id", "label", valid.alias("is_probability"), (auc > 0.5).alias("beats_chance"))


def classify(spark, sf, build):
    train, test, columns = classify_rows(spark, sf)
    model = models.fit(train, columns, build(train))
    return judged(models.positive_score(model, test, ["customer_id"], "outflow_event"))


@query("rf_regress", PREDICTED_SQL)
def rf_regress(spark, sf):
    return regress(spark, sf, models.rf_regressor("urgent", **DEEP_FOREST))


@query("gbt_regress", PREDICTED_SQL)
def gbt_regress(spark, sf):
    return regress(spark, sf, models.gbt_regressor("urgent", **BOOSTING))


# The features of the regressors: the value features of all series, and the calendar.
IMPORTANCE_SQL = f"""SELECT target, model, feature, true AS is_share, true AS pct_is_share, 1e2 AS pct_total
    FROM (VALUES {", ".join(f"('{n}')" for n in fx.SERIES.values())}) AS t(target),
         (VALUES ('RandomForest'), ('GradientBoosting')) AS m(model),
         (VALUES {", ".join(f"('{c}')" for c in [*PREPARED, *sq.CALENDAR])}) AS f(feature)"""


@query("importance_pct", IMPORTANCE_SQL, {"pct_total": 6})
def importance_pct(spark, sf):
    """Every feature of the fitted regressors of all targets: that its weight is a share of one,
    its percentage the same share of a hundred, and the sum of a model's percentages."""
    importance = settle(fitted_regressors(spark, sf).importance)
    total = importance.groupBy("target", "model").agg(F.sum("importance_pct").alias("pct_total"))
    same = F.abs(F.col("importance_pct") - 100 * F.col("importance")) < 1e-6
    return importance.join(total, ["target", "model"]).select(
        "target",
        "model",
        "feature",
        F.col("importance").between(0, 1).alias("is_share"),
        same.alias("pct_is_share"),
        "pct_total",
    )


@query(
    "importance_of_sums",
    """SELECT feature, importance, importance / sum(importance) OVER () * 100 AS importance_pct
    FROM (SELECT o_orderpriority AS feature, sum(o_totalprice) AS importance FROM orders GROUP BY 1) t""",
    {"importance": 2, "importance_pct": 8},
)
def importance_of_sums(spark, sf):
    """The share of each weight, on weights summed from a table."""
    weights = fx.table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("feature"))
    return evaluate.importance_pct(weights.agg(F.sum("o_totalprice").alias("importance")))


def fitted_regressors(spark, sf, baseline=None, output=None):
    names = list(fx.SERIES.values())
    return training.train_eval_regress(
        settle(wide_features(spark, sf)),
        names,
        names,
        lambda target: training.regressors(target, SHALLOW_FOREST, BOOSTING),
        baseline,
        output=output,
    )


@query(
    "train_eval_regress",
    f"""WITH {REGRESS_SQL}, {sq.METRICS.replace(sq.RATES + ",", "", 1)},
    best AS (SELECT target, model FROM metrics QUALIFY row_number() OVER (PARTITION BY target ORDER BY rmse, model) = 1),
    held AS ({" UNION ALL ".join(f"SELECT '{n}' AS target, count(*) AS n FROM ({held_out_sql(n)}) t" for n in fx.SERIES.values())}),
    names(series_id, target) AS (VALUES {", ".join(f"('{k}', '{v}')" for k, v in fx.SERIES.items())})
    SELECT h.target, m.model, h.n AS n_predictions, true AS metrics_match, b.model AS baseline_model
    FROM held h JOIN names USING (target) JOIN best b ON b.target = names.series_id,
         (VALUES ('RandomForest'), ('GradientBoosting')) AS m(model)""",
)
def train_eval_regress(spark, sf):
    """All targets. The metrics are computed again from the predictions as written."""
    baseline = evaluate.best_baseline(evaluate.regression_metrics(predictions(spark, sf)))
    baseline = baseline.replace(fx.SERIES, subset=["target"])
    result = fitted_regressors(spark, sf, baseline, scratch_path(spark, "regress"))
    again = result.predictions.groupBy("target", "model").agg(
        F.count("predicted").alias("n_predictions"),
        F.sqrt(F.avg(F.pow(F.col("actual") - F.col("predicted"), 2))).alias("_rmse"),
        F.avg(F.abs(F.col("actual") - F.col("predicted"))).alias("_mae"),
    )
    match = (F.abs(F.col("rmse") - F.col("_rmse")) < 1e-6) & (F.abs(F.col("mae") - F.col("_mae")) < 1e-6)
    joined = result.metrics.join(again, ["target", "model"])
    return joined.select("target", "model", "n_predictions", match.alias("metrics_match"), "baseline_model")


@query("logit_classify", SCORED_SQL)
def logit_classify(spark, sf):
    return classify(spark, sf, lambda train: models.logistic_classifier("outflow_event", train.count()))


@query("rf_classify", SCORED_SQL)
def rf_classify(spark, sf):
    return classify(spark, sf, lambda _: models.rf_classifier("outflow_event"))


@query("gbt_classify", SCORED_SQL)
def gbt_classify(spark, sf):
    return classify(spark, sf, lambda _: models.gbt_classifier("outflow_event"))


@query("gbt_classify_sub", SCORED_SQL)
def gbt_classify_sub(spark, sf):
    return classify(spark, sf, lambda _: models.gbt_classifier_sub("outflow_event"))


@query("positive_score", SCORED_SQL)
def positive_score(spark, sf):
    """Every row, whatever its score."""
    train, test, columns = classify_rows(spark, sf)
    model = models.fit(train, columns, models.logistic_classifier("outflow_event", train.count()))
    return judged(models.positive_score(model, test, ["customer_id"], "outflow_event"))


@query(
    "train_eval_classify",
    f"""WITH {sq.CUSTOMERS}, held AS (
      SELECT 'outflow_event' AS target, count(*) AS n FROM ({customers_sql('outflow_event')}) t
      UNION ALL SELECT 'early_repayment_event', count(*) FROM ({customers_sql('early_repayment_event')}) t)
    SELECT target, model, n AS n_scores, true AS is_metric FROM held,
    (VALUES ('LogisticRegression'), ('RandomForest'), ('GradientBoosting'), ('SampledBoosting')) AS m(model)""",
)
def train_eval_classify(spark, sf):
    result = training.train_eval_classify(
        settle(customers(spark, sf)),
        output=scratch_path(spark, "classify"),
    )
    counts = result.scores.groupBy("target", "model").agg(F.count("score").alias("n_scores"))
    valid = F.col("auc").between(0, 1) & F.col("average_precision").between(0, 1)
    return result.metrics.join(counts, ["target", "model"]).select("target", "model", "n_scores", valid.alias("is_metric"))


def forecast_inputs(spark, sf):
    clean = settle(fx.rates(spark, sf))
    cuts = split_dates(clean)
    train = chrono_split(clean).filter("split = 'train'").drop("split")
    return train, cuts.select("series_id", (F.col("n_rows") - F.col("n_train")).alias("horizon"))


@query("forecast_ar")
def run_forecast_ar(spark, sf):
    return forecast_ar(*forecast_inputs(spark, sf), daily=True)


@query("forecast_trend_season")
def run_forecast_trend_season(spark, sf):
    return forecast_trend_season(*forecast_inputs(spark, sf))


FORECAST_SQL = f"""{sq.RATES},
    numbered AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY date) AS i,
                 count(*) OVER (PARTITION BY series_id) AS n FROM rates),
    learned AS (SELECT *, lag(value) OVER (PARTITION BY series_id ORDER BY date) AS before
                FROM numbered WHERE i <= floor(n * 0.8e0)),
    ends AS (SELECT series_id, max(date) AS last_date, max_by(value, date) AS last_value, any_value(n) - count(*) AS h
             FROM learned GROUP BY series_id),
    steps AS (SELECT *, unnest(range(1, CAST(h AS BIGINT) + 1)) AS step FROM ends)"""


@query(
    "forecast_ar_fixed",
    f"""WITH {FORECAST_SQL},
    fit AS (SELECT series_id, regr_slope(value, before) AS w, regr_intercept(value, before) AS c
            FROM learned WHERE i > 7 GROUP BY series_id)
    SELECT series_id, 1 AS p, 0 AS d, CAST(step AS INTEGER) AS step, last_date + CAST(step AS INTEGER) AS date,
           c * (1 - w ** step) / (1 - w) + w ** step * last_value AS predicted FROM steps JOIN fit USING (series_id)""",
    {"predicted": 2},
)
def run_forecast_ar_fixed(spark, sf):
    """One earlier value and no differences, for which SQL has the sums."""
    return forecast_ar(*forecast_inputs(spark, sf), daily=True, fixed=(1, 0))


@query(
    "forecast_trend",
    f"""WITH {FORECAST_SQL},
    fit AS (SELECT series_id, regr_slope(value, datediff('day', DATE '2000-01-01', date)) AS w,
                   regr_intercept(value, datediff('day', DATE '2000-01-01', date)) AS c FROM learned GROUP BY series_id)
    SELECT series_id, CAST(step AS INTEGER) AS step, last_date + CAST(step AS INTEGER) AS date,
           c + w * (datediff('day', DATE '2000-01-01', last_date) + step) AS predicted
    FROM steps JOIN fit USING (series_id)""",
    {"predicted": 2},
)
def run_forecast_trend(spark, sf):
    """Without seasonal terms: a straight line."""
    return forecast_trend_season(*forecast_inputs(spark, sf), yearly=0, weekly=0)


@query(
    "forecast_trend_weekly",
    f"""WITH {FORECAST_SQL},
    waves AS (SELECT series_id, value AS y, datediff('day', DATE '2000-01-01', date) / 365.25e0 AS a,
                     sin(datediff('day', DATE '2000-01-01', date) * (2 * pi() / 7)) AS b,
                     cos(datediff('day', DATE '2000-01-01', date) * (2 * pi() / 7)) AS c FROM learned),
    m AS (SELECT series_id, avg(y) AS y0, avg(a) AS a0, avg(b) AS b0, avg(c) AS c0,
                 covar_pop(a, a) AS aa, covar_pop(b, b) AS bb, covar_pop(c, c) AS cc, covar_pop(a, b) AS ab,
                 covar_pop(a, c) AS ac, covar_pop(b, c) AS bc, covar_pop(a, y) AS ay, covar_pop(b, y) AS wy,
                 covar_pop(c, y) AS cy FROM waves GROUP BY series_id),
    d AS (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det FROM m),
    fit AS (SELECT series_id, y0, a0, b0, c0,
                   (ay * (bb * cc - bc * bc) - ab * (wy * cc - bc * cy) + ac * (wy * bc - bb * cy)) / det AS wa,
                   (aa * (wy * cc - bc * cy) - ay * (ab * cc - bc * ac) + ac * (ab * cy - wy * ac)) / det AS wb,
                   (aa * (bb * cy - wy * bc) - ab * (ab * cy - wy * ac) + ay * (ab * bc - bb * ac)) / det AS wc FROM d),
    days AS (SELECT series_id, step, last_date + CAST(step AS INTEGER) AS date,
                    datediff('day', DATE '2000-01-01', last_date) + step AS day FROM steps)
    SELECT series_id, CAST(step AS INTEGER) AS step, date,
           y0 + wa * (day / 365.25e0 - a0) + wb * (sin(day * (2 * pi() / 7)) - b0) + wc * (cos(day * (2 * pi() / 7)) - c0) AS predicted
    FROM days JOIN fit USING (series_id)""",
    {"predicted": 2},
)
def run_forecast_trend_weekly(spark, sf):
    """One weekly pair of seasonal terms."""
    return forecast_trend_season(*forecast_inputs(spark, sf), yearly=0, weekly=1)


@query(
    "forecast_trend_bends",
    f"""WITH {FORECAST_SQL},
    fit AS (SELECT series_id, regr_slope(value, datediff('day', DATE '2000-01-01', date)) AS w,
                   regr_intercept(value, datediff('day', DATE '2000-01-01', date)) AS c FROM learned GROUP BY series_id)
    SELECT series_id, CAST(step AS INTEGER) AS step, last_date + CAST(step AS INTEGER) AS date,
           c + w * (datediff('day', DATE '2000-01-01', last_date) + step) AS stiff, true AS bends
    FROM steps JOIN fit USING (series_id)""",
    {"stiff": 2},
)
def run_forecast_trend_bends(spark, sf):
    """With the highest price no slope changes; with a low one the trend is another one."""
    train, horizon = forecast_inputs(spark, sf)
    stiff = forecast_trend_season(train, horizon, yearly=0, weekly=0, changepoints=25, penalty=1.0)
    loose = forecast_trend_season(train, horizon, yearly=0, weekly=0, changepoints=25, penalty=0.001)
    both = stiff.withColumnRenamed("predicted", "stiff").join(loose, ["series_id", "step", "date"])
    return both.select("series_id", "step", "date", "stiff", (F.col("stiff") != F.col("predicted")).alias("bends"))


@query(
    "forecast_arma_fixed",
    f"""WITH {FORECAST_SQL},
    lagged AS (SELECT series_id, i, value AS y, lag(value) OVER w AS y1, lag(value, 2) OVER w AS y2
               FROM learned WINDOW w AS (PARTITION BY series_id ORDER BY date)),
    long AS (SELECT series_id, regr_slope(y, y1) AS w, regr_intercept(y, y1) AS c FROM lagged WHERE i > 2 GROUP BY series_id),
    shocks AS (SELECT l.series_id, y, y1, y1 - long.c - long.w * y2 AS e FROM lagged l JOIN long USING (series_id) WHERE i > 2),
    m AS (SELECT series_id, avg(y) AS y0, avg(y1) AS a0, avg(e) AS e0, covar_pop(y1, y1) AS aa, covar_pop(e, e) AS ee,
                 covar_pop(y1, e) AS ae, covar_pop(y1, y) AS ay, covar_pop(e, y) AS ey FROM shocks GROUP BY series_id),
    fit AS (SELECT series_id, (ay * ee - ey * ae) / (aa * ee - ae * ae) AS phi, (aa * ey - ay * ae) / (aa * ee - ae * ae) AS theta,
                   y0 - (ay * ee - ey * ae) / (aa * ee - ae * ae) * a0 - (aa * ey - ay * ae) / (aa * ee - ae * ae) * e0 AS c FROM m),
    last AS (SELECT series_id, max_by(value, date) AS y, max_by(before, date) AS y1 FROM learned GROUP BY series_id),
    one AS (SELECT f.*, f.c + phi * y + theta * (y - long.c - long.w * y1) AS first
            FROM fit f JOIN last USING (series_id) JOIN long USING (series_id))
    SELECT series_id, 1 AS p, 0 AS d, 1 AS q, 0 AS seasonal, CAST(step AS INTEGER) AS step,
           last_date + CAST(step AS INTEGER) AS date,
           c * (1 - phi ** (step - 1)) / (1 - phi) + phi ** (step - 1) * first AS predicted
    FROM steps JOIN one USING (series_id)""",
    {"predicted": 2},
)
def run_forecast_arma_fixed(spark, sf):
    """One earlier value and one earlier residual, whose autoregression has one row: SQL has the sums."""
    return forecast_arma(*forecast_inputs(spark, sf), daily=True, fixed=Order(1, 0, 1), long=1)


@query(
    "forecast_arma",
    f"""WITH {FORECAST_SQL} SELECT series_id, CAST(step AS INTEGER) AS step, last_date + CAST(step AS INTEGER) AS date,
    true AS within FROM steps""",
)
def run_forecast_arma(spark, sf):
    """The order chosen by AIC: that each series has each day, within the range of the series and as much around it."""
    train, horizon = forecast_inputs(spark, sf)
    ends = train.groupBy("series_id").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    found = settle(forecast_arma(train, horizon, daily=True)).join(ends, "series_id")
    width = F.col("high") - F.col("low")
    within = F.col("predicted").between(F.col("low") - width, F.col("high") + width)
    return found.select("series_id", "step", "date", within.alias("within"))


# Two candidates, no earlier change and one, on the rows that have two earlier ones; the normal
# distribution by the rational approximation 7.1.26 of Abramowitz and Stegun.
UNIT_ROOT_SQL = f"""WITH {sq.RATES},
    s AS (SELECT series_id, value - lag(value) OVER w AS dy, lag(value) OVER w AS x,
                 lag(value) OVER w - lag(value, 2) OVER w AS dx
          FROM rates WINDOW w AS (PARTITION BY series_id ORDER BY date)),
    m AS (SELECT series_id, count(*) AS n, count(*) * covar_pop(x, x) AS xx, count(*) * covar_pop(dx, dx) AS dd,
                 count(*) * covar_pop(x, dx) AS xd, count(*) * covar_pop(x, dy) AS xy, count(*) * covar_pop(dx, dy) AS dxy,
                 count(*) * covar_pop(dy, dy) AS yy FROM s WHERE dx IS NOT NULL GROUP BY series_id),
    c AS (SELECT *, xy / xx AS b0, yy - xy * xy / xx AS r0, (xy * dd - dxy * xd) / (xx * dd - xd * xd) AS b1,
                 yy - (xy * (xy * dd - dxy * xd) + dxy * (dxy * xx - xy * xd)) / (xx * dd - xd * xd) AS r1 FROM m),
    t AS (SELECT series_id, n, CASE WHEN n * ln(r1 / n) + 6 < n * ln(r0 / n) + 4 THEN 1 ELSE 0 END AS lags,
                 b0 / sqrt(r0 / (n - 2) / xx) AS t0, b1 / sqrt(r1 / (n - 3) * dd / (xx * dd - xd * xd)) AS t1 FROM c),
    z AS (SELECT series_id, n, lags, CASE lags WHEN 1 THEN t1 ELSE t0 END AS t FROM t),
    p AS (SELECT *, CASE WHEN t <= -1.61e0 THEN 2.1659e0 + 1.4412e0 * t + 0.038269e0 * t * t
                    ELSE 1.7339e0 + 0.93202e0 * t - 0.12745e0 * t * t - 0.010368e0 * t * t * t END / sqrt(2e0) AS v FROM z),
    q AS (SELECT *, 1 / (1 + 0.3275911e0 * abs(v)) AS k FROM p),
    e AS (SELECT *, (1 - sign(v) * (1 - k * (0.254829592e0 + k * (-0.284496736e0 + k * (1.421413741e0
                    + k * (-1.453152027e0 + k * 1.061405429e0)))) * exp(-v * v))) / 2 AS tail FROM q)
    SELECT series_id, CAST(n AS BIGINT) AS n, CAST(lags AS INTEGER) AS lags, t AS t_stat,
           CASE WHEN t > 2.74e0 THEN 1e0 WHEN t < -18.83e0 THEN 0e0 ELSE 1 - tail END AS p_value,
           CASE WHEN t > 2.74e0 THEN false WHEN t < -18.83e0 THEN true ELSE 1 - tail < 5e-2 END AS stationary FROM e"""


@query("unit_root_test", UNIT_ROOT_SQL, {"t_stat": 6, "p_value": 5})
def unit_root_test(spark, sf):
    """Up to one earlier change, for which SQL has the sums."""
    return evaluate.unit_root_test(fx.rates(spark, sf), daily=True, max_lags=1)


@query(
    "train_eval_forecast",
    f"""WITH {FORECAST_SQL} SELECT series_id AS target, model, CAST(h AS BIGINT) AS n_predictions, true AS metrics_match,
    true AS has_best FROM ends, (VALUES ('ARMA'), ('TrendSeason')) AS m(model)""",
)
def train_eval_forecast(spark, sf):
    """All series. The metrics are computed again from the predictions as written, and compared
    with those in the written documents."""
    output = scratch_path(spark, "forecast")
    result = training.train_eval_forecast(settle(fx.rates(spark, sf)), output=output)
    written = spark.read.parquet(f"{output}/predictions")
    columns = {"ARMA": "arma_pred", "TrendSeason": "trendseason_pred"}
    cells = F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).alias("predicted")) for m, c in columns.items()])
    long = written.select("target", "actual", F.inline(cells))
    again = long.groupBy("target", "model").agg(
        F.count("predicted").alias("n_predictions"),
        F.sqrt(F.avg(F.pow(F.col("actual") - F.col("predicted"), 2))).alias("_rmse"),
        F.avg(F.abs(F.col("actual") - F.col("predicted"))).alias("_mae"),
    )
    documents = readers.read_metrics_json(spark, f"{output}/metrics")
    match = (F.abs(F.col("rmse") - F.col("_rmse")) < 1e-6) & (F.abs(F.col("mae") - F.col("_mae")) < 1e-6)
    best = result.best.select("target", "best_model")
    return documents.join(again, ["target", "model"]).join(best, "target").select(
        "target", "model", "n_predictions", match.alias("metrics_match"), F.col("best_model").isNotNull().alias("has_best")
    )


# --- monitoring -----------------------------------------------------------------------

FACT_SQL = f"""WITH {sq.MONITORING}
    SELECT r.target, r.model, r.date, r.actual, r.predicted, r.actual - r.predicted AS error,
           abs(r.actual - r.predicted) AS error_abs, r.rolling_rmse, s.stability_index, s.overall_rmse,
           CAST(year(r.date) AS INTEGER) AS year, CAST(month(r.date) AS INTEGER) AS month,
           CAST(quarter(r.date) AS INTEGER) AS quarter, strftime(r.date, '%Y-%m') AS year_month
    FROM rolled r JOIN scores s ON r.target = s.target AND r.model = s.model"""
FACT_DIGITS = {
    "predicted": 3, "error": 3, "error_abs": 3, "rolling_rmse": 3, "stability_index": 8, "overall_rmse": 3,
}


@query("monitoring_dashboard", FACT_SQL, FACT_DIGITS)
def monitoring_dashboard(spark, sf):
    """The dashboards of each target and model alone, by counting rows as on business days, put together."""
    rows, columns = settle(predictions(spark, sf)), feature_file(spark, sf)
    drifted = settle(monitoring.drift_report(columns, ["series_id"]))
    facts = [
        monitoring.monitoring_dashboard(rows, columns, target, model, drift=drifted).fact
        for target in fx.SERIES
        for model in ("naive", "ma7")
    ]
    return reduce(DataFrame.unionByName, facts)


@query("all_dashboards", FACT_SQL, FACT_DIGITS)
def all_dashboards(spark, sf):
    return monitoring.all_dashboards(
        predictions(spark, sf), feature_file(spark, sf), daily=True, feature_keys=["series_id"]
    ).fact
