"""Query catalog: every registered query is a Spark plan over the driver
tables plus (where SQL can say it) the equivalent DuckDB SQL used as the
correctness oracle.  Column names and rounding are identical on both sides.

The registry is filled by the ``plans.q_*`` modules; ``__spark_entry__``
exposes it to the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    group: str


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, group: str = "misc"):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, group)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # importing registers the queries
    import importlib
    for mod in ("q_orders", "q_panel", "q_models", "q_checks"):
        try:
            importlib.import_module(f"salescope.plans.{mod}")
        except ModuleNotFoundError as e:
            if e.name != f"salescope.plans.{mod}":
                raise
    return REGISTRY


# ------------------------------------------------------------------ SQL pieces
# The order view and the panel view written once for the oracle side.

FLAT_CTE = """flat AS (
  SELECT l_orderkey AS Order_ID, CAST(o_orderdate AS DATE) AS Order_Date,
         c_name AS Customer_Name, c_mktsegment AS City, n_name AS State, r_name AS Region,
         'ONE' AS Country, p_type AS Category, p_brand AS Sub_Category, p_name AS Product_Name,
         CAST(l_quantity AS INTEGER) AS Quantity, p_retailprice AS Unit_Price,
         round(l_quantity * p_retailprice, 2) AS Revenue,
         round(l_quantity * p_retailprice * (0.3 - l_discount), 4) AS Profit,
         l_linenumber, l_partkey, l_suppkey, l_extendedprice
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN part ON l_partkey = p_partkey
       JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey)"""

PANEL_OBS_CTE = """obs AS (
  SELECT CAST(o_orderdate AS DATE) AS date, n_regionkey AS store_nbr, p_type AS family,
         sum(l_quantity) AS sales,
         CAST(sum(CASE WHEN l_discount >= 0.08 THEN 1 ELSE 0 END) AS BIGINT) AS onpromotion
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN part ON l_partkey = p_partkey
       JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2, 3)"""

# complete panel: every series on every day between the first and last date
PANEL_CTE = PANEL_OBS_CTE + """,
bounds AS (SELECT min(date) AS lo, max(date) AS hi FROM obs),
series AS (SELECT DISTINCT store_nbr, family FROM obs),
spine AS (SELECT s.store_nbr, s.family, CAST(d.date AS DATE) AS date
          FROM series s, bounds b, unnest(generate_series(b.lo, b.hi, INTERVAL 1 DAY)) AS d(date)),
panel AS (
  SELECT sp.date, sp.store_nbr, sp.family,
         CAST(coalesce(o.sales, 0) AS DOUBLE) AS sales,
         CAST(coalesce(o.onpromotion, 0) AS INTEGER) AS onpromotion
  FROM spine sp LEFT JOIN obs o
    ON o.store_nbr = sp.store_nbr AND o.family = sp.family AND o.date = sp.date)"""

STORES_CTE = """stores AS (
  SELECT CAST(r_regionkey AS INTEGER) AS store_nbr, r_name AS city, r_name AS state,
         substr('ABCDE', CAST(r_regionkey % 5 AS INTEGER) + 1, 1) AS type,
         CAST(r_regionkey % 3 AS INTEGER) AS cluster
  FROM region)"""

OIL_CTE = """oil AS (
  SELECT CAST(o_orderdate AS DATE) AS date, min(o_totalprice) / 10000.0 AS dcoilwtico
  FROM orders WHERE isodow(CAST(o_orderdate AS DATE)) <= 5
  GROUP BY 1)"""

HOLIDAYS_CTE = """holidays_events AS (
  SELECT d.date, r.type, r.locale, isodow(d.date) >= 6 AS transferred
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders) d
  JOIN (VALUES (1, 1, 'Holiday', 'National'), (12, 25, 'Holiday', 'National'),
               (5, 1, 'Holiday', 'Regional'), (7, 4, 'Work Day', 'National'))
       AS r(h_month, h_day, type, locale)
    ON month(d.date) = r.h_month AND day(d.date) = r.h_day)"""

TRANSACTIONS_CTE = """transactions AS (
  SELECT CAST(o_orderdate AS DATE) AS date, CAST(n_regionkey AS INTEGER) AS store_nbr,
         CAST(count(DISTINCT o_orderkey) AS INTEGER) AS transactions
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body
