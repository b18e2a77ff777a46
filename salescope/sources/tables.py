"""Driver parquet tables and the two analysis views built from them.

``order_view`` is the flat, one-row-per-order-line table the order-revenue
operators expect (FIXTURES 2.1); ``panel_sales`` is the daily
(date, store_nbr, family) sales panel the forecasting operators expect
(FIXTURES 2.2).  Both are plain DataFrame plans: Catalyst prunes the parquet
columns and the join strategy is chosen from (runtime) sizes, except for the
two dimension tables whose row count is checked before broadcasting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.operators.joins import sized_broadcast

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Promotion rule of the panel stand-in: a line counts as promoted when its
# discount is at least this value (fixed value of the test-data mapping).
PROMO_DISCOUNT = 0.08


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLE_NAMES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _customer_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer + nation + region; the two dimension tables are size-checked."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    geo = nation.join(sized_broadcast(region), nation.n_regionkey == region.r_regionkey)
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return customer.join(sized_broadcast(geo), customer.c_nationkey == geo.n_nationkey)


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined to orders, part and the customer geography."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    # the customer of an order first, the part of a line first: lines, the
    # largest table, go through two joins, not three
    geo = _customer_geo(spark, sf_dir)
    sold = orders.join(geo, orders.o_custkey == geo.c_custkey)
    lines = li.join(part, li.l_partkey == part.p_partkey)
    return lines.join(sold, lines.l_orderkey == sold.o_orderkey)


def order_view(spark: SparkSession, sf_dir: str, with_keys: bool = False) -> DataFrame:
    """The flat order table (14 columns) on the driver tables.

    ``with_keys`` adds the line key (l_linenumber, l_partkey, l_suppkey) that
    makes rows unique, for operators that need a total row order.
    """
    lines = _order_lines(spark, sf_dir)
    cols = [
        F.col("l_orderkey").alias("Order_ID"),
        F.col("o_orderdate").cast("date").alias("Order_Date"),
        F.col("c_name").alias("Customer_Name"),
        F.col("c_mktsegment").alias("City"),
        F.col("n_name").alias("State"),
        F.col("r_name").alias("Region"),
        F.lit("ONE").alias("Country"),
        F.col("p_type").alias("Category"),
        F.col("p_brand").alias("Sub_Category"),
        F.col("p_name").alias("Product_Name"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        F.col("p_retailprice").alias("Unit_Price"),
        F.round(F.col("l_quantity") * F.col("p_retailprice"), 2).alias("Revenue"),
        # 2-decimal price x quantity x 2-decimal margin has 4 decimals exactly,
        # so rounding at 4 never meets a tie
        F.round(F.col("l_quantity") * F.col("p_retailprice") * (F.lit(0.3) - F.col("l_discount")), 4)
        .alias("Profit"),
    ]
    if with_keys:
        cols += [F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"),
                 F.col("l_extendedprice")]
    return lines.select(*cols)


def panel_sales(spark: SparkSession, sf_dir: str, store_key: str = "n_regionkey") -> DataFrame:
    """Daily sales per (store_nbr, family) as observed (no zero rows).

    ``store_key`` = ``n_regionkey`` gives 5 stores; ``n_nationkey`` 25.
    """
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    cust = customer.join(sized_broadcast(nation), customer.c_nationkey == nation.n_nationkey)
    # the day and store of an order first, the family of a line first: lines,
    # the largest table, go through two joins, not three, and as few columns
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    sold = orders.join(cust, orders.o_custkey == cust.c_custkey).select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("date"), F.col(store_key).alias("store_nbr"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", (F.col("l_discount") >= PROMO_DISCOUNT).alias("__promo"))
    lines = li.join(part, li.l_partkey == part.p_partkey).select(
        "l_orderkey", F.col("p_type").alias("family"), "l_quantity", "__promo")
    return (lines.join(sold, lines.l_orderkey == sold.o_orderkey)
                 .groupBy("date", "store_nbr", "family")
                 .agg(F.sum("l_quantity").alias("sales"), F.count_if("__promo").alias("onpromotion")))
