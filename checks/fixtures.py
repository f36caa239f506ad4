"""The operators' inputs as views over the test tables.

Each view is one SQL text that Spark and DuckDB both run. Means of money amounts are taken
over whole cents, so that both engines get the same double whatever the order of rows.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from yieldwatch.operators.grid import uniform_calendar

# The five series of the rates view and their column names in wide tables.
SERIES = {
    "1-URGENT": "urgent",
    "2-HIGH": "high",
    "3-MEDIUM": "medium",
    "4-NOT SPECIFIED": "unspecified",
    "5-LOW": "low",
}
RETAIL, CORPORATE = "HOUSEHOLD", "MACHINERY"

RATES_RAW = """
SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS date,
       sum(CAST(round(o_totalprice * 100) AS BIGINT)) / count(*) / 100e0 AS value
FROM {orders} GROUP BY o_orderpriority, CAST(o_orderdate AS DATE)
"""

BEHAVIOR = """
WITH li AS (
  SELECT l_orderkey,
         CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS DOUBLE) / count(*) AS irl,
         CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS DOUBLE) / count(*) / 10e0 AS es,
         round(stddev_samp(l_quantity), 6) AS mv, count(DISTINCT l_partkey) AS np,
         max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS ev
  FROM {lineitem} GROUP BY l_orderkey),
cu AS (
  SELECT o_custkey, round(stddev_samp(o_totalprice) / avg(o_totalprice), 6) AS bv, count(*) AS tf,
         min(year(o_orderdate) * 12 + month(o_orderdate)) AS m0
  FROM {orders} GROUP BY o_custkey)
SELECT o.o_orderkey AS customer_id, CAST(o.o_orderdate AS DATE) AS date, c.c_mktsegment AS customer_segment,
       CAST(year(o.o_orderdate) * 12 + month(o.o_orderdate) - cu.m0 AS INT) AS account_age_months,
       c.c_acctbal AS base_balance, cu.bv AS balance_volatility, li.irl AS interest_rate_level,
       li.es AS economic_stress, li.mv AS market_volatility, CAST(li.np AS INT) AS num_products,
       CAST(cu.tf AS DOUBLE) AS transaction_frequency,
       CAST(500 + (o.o_custkey * 7919) % 351 AS DOUBLE) AS credit_score, li.ev AS outflow_event,
       CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS early_repayment_event
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
     JOIN cu ON cu.o_custkey = o.o_custkey JOIN li ON li.l_orderkey = o.o_orderkey
"""

SCORED = """
SELECT 'n_chars' AS model, l.quality AS label, CAST(d.n_chars AS DOUBLE) AS score
FROM {labels} l JOIN {documents} d ON l.doc_id = d.doc_id
UNION ALL
SELECT 'l_discount', CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END, l_discount FROM {lineitem}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _view(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    return spark.sql(sql, **{name: table(spark, sf_dir, name) for name in names})


def rates_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, RATES_RAW, "orders")


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean daily calendar of rates_raw."""
    return uniform_calendar(rates_raw(spark, sf_dir), ts="date")


def behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, BEHAVIOR, "orders", "customer", "lineitem")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, SCORED, "labels", "documents", "lineitem")


def duck(sql: str) -> str:
    """The DuckDB form of a view text."""
    for name in ("orders", "customer", "lineitem", "labels", "documents"):
        sql = sql.replace("{" + name + "}", name)
    return sql
