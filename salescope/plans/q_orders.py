"""Registered queries over the flat order table (order-revenue problem):
quality checks, projections, summaries, calendar bins, moments, chart
tables and the train-only lookup features."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.functions import dates as D
from salescope.operators import aggregates as A
from salescope.operators import chartdata as CH
from salescope.operators import quality as Q
from salescope.operators import windows as WN
from salescope.plans import order_model as OM
from salescope.plans.catalog import FLAT_CTE, register, with_ctes
from salescope.session import materialize
from salescope.sources.tables import order_view

KEY = ["Order_ID", "l_linenumber", "l_partkey", "l_suppkey"]
ORDER_COLS = ["Order_ID", "Order_Date", "Customer_Name", "City", "State", "Region", "Country",
              "Category", "Sub_Category", "Product_Name", "Quantity", "Unit_Price", "Revenue", "Profit"]

#: Orders of a file of the flat table: model fits take tens of microseconds a row.
ROWS_A_FILE = 50_000


_FLAT: dict = {}


def flat(spark: SparkSession, sf: str) -> DataFrame:
    """The flat order table, derived once per session and input folder and
    kept as parquet in the shared checkpoint folder (the star join runs
    once; every query then scans only its columns)."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FLAT:
        _FLAT[key] = materialize(order_view(spark, sf, with_keys=True), "orders_flat", rows_a_file=ROWS_A_FILE)
        gc.collect()
        spark.sparkContext._jvm.System.gc()  # what the joins shuffled can go from the disks
    return _FLAT[key]


_PREP: dict = {}


def prepared(spark: SparkSession, sf: str) -> OM.Prepared:
    """Split + train-only lookups on the flat table, once per session and input."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _PREP:
        _PREP[key] = OM.prepare_model_data(flat(spark, sf))
    return _PREP[key]


def _sql(body: str, *extra: str) -> str:
    return with_ctes(FLAT_CTE, *extra, body=body)


# ------------------------------------------------------------- group_sales x 6

_GROUP_KEYS = {"category": "Category", "sub_category": "Sub_Category", "product": "Product_Name",
               "region": "Region", "state": "State", "city": "City"}


def _group_sales_query(col: str):
    def build(spark, sf):
        return A.group_sales(flat(spark, sf), col, 10)
    return build


for _k, _col in _GROUP_KEYS.items():
    register(f"group_sales_{_k}", group="summary", sql=_sql(f"""
SELECT {_col}, count(Order_ID) AS orders, CAST(sum(Quantity) AS BIGINT) AS quantity,
       round(sum(Revenue), 2) AS revenue, round(avg(Revenue), 2) AS avg_revenue,
       round(median(Revenue), 3) AS median_revenue
FROM flat WHERE {_col} IS NOT NULL GROUP BY {_col}
ORDER BY revenue DESC, {_col} LIMIT 10"""))(_group_sales_query(_col))


# ---------------------------------------------------------------- top-k sums

def _top_sum_query(col: str, n: int):
    def build(spark, sf):
        return A.top_sum(flat(spark, sf), col, "Revenue", n, "revenue")
    return build


for _k, _col, _n in (("category", "Category", 15), ("region", "Region", 15),
                     ("product", "Product_Name", 15), ("state", "State", 15)):
    register(f"revenue_by_{_k}_top15", group="summary", sql=_sql(f"""
SELECT {_col}, round(sum(Revenue), 2) AS revenue FROM flat WHERE {_col} IS NOT NULL
GROUP BY {_col} ORDER BY revenue DESC, {_col} LIMIT {_n}"""))(_top_sum_query(_col, _n))


# ---------------------------------------------------------------- quality

@register("dataset_checks", group="quality", sql=_sql("""
SELECT count(*) AS rows, 14 AS columns, 0 AS stripped_columns,
       CAST(0 AS BIGINT) AS missing_total,
       count(*) FILTER (WHERE Order_Date IS NULL) AS date_parse_failures,
       CAST(min(Order_Date) AS VARCHAR) AS date_min, CAST(max(Order_Date) AS VARCHAR) AS date_max,
       count(*) FILTER (WHERE abs(round(Revenue, 2) - round(Quantity * Unit_Price, 2)) > 0.01)
         AS revenue_formula_mismatch_rows,
       round(max(abs(round(Revenue, 2) - round(Quantity * Unit_Price, 2))), 4)
         AS revenue_formula_max_abs_diff,
       (SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT Order_ID, Order_Date,
               Customer_Name, City, State, Region, Country, Category, Sub_Category, Product_Name,
               Quantity, Unit_Price, Revenue, Profit FROM flat)) AS BIGINT) FROM flat)
         AS duplicate_rows
FROM flat"""))
def q_dataset_checks(spark, sf):
    df = flat(spark, sf).select(*ORDER_COLS)
    return Q.dataset_checks(df).withColumn("missing_total", F.col("missing_total").cast("long"))


@register("missing_total", group="quality", sql=_sql("""
SELECT CAST(sum((Order_ID IS NULL)::INT + (Order_Date IS NULL)::INT + (Customer_Name IS NULL)::INT
  + (City IS NULL)::INT + (State IS NULL)::INT + (Region IS NULL)::INT + (Country IS NULL)::INT
  + (Category IS NULL)::INT + (Sub_Category IS NULL)::INT + (Product_Name IS NULL)::INT
  + (Quantity IS NULL)::INT + (Unit_Price IS NULL)::INT + (Revenue IS NULL)::INT
  + (Profit IS NULL)::INT) AS BIGINT) AS missing_total FROM flat"""))
def q_missing_total(spark, sf):
    return Q.missing_total(flat(spark, sf).select(*ORDER_COLS))


@register("duplicate_rows_orders", group="quality", sql=_sql("""
SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicate_rows FROM (
  SELECT count(*) AS c FROM flat GROUP BY Order_ID, Order_Date, Customer_Name, City, State,
    Region, Country, Category, Sub_Category, Product_Name, Quantity, Unit_Price, Revenue, Profit)"""))
def q_duplicate_rows(spark, sf):
    return Q.duplicate_rows(flat(spark, sf).select(*ORDER_COLS))


@register("duplicate_rows_order_keys", group="quality", sql="""
SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicate_rows FROM (
  SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def q_duplicate_keys(spark, sf):
    from salescope.sources.tables import table
    return Q.duplicate_rows(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"))


_PARSE_SQL = """CASE WHEN regexp_matches(trim(t),
    '^(1[0-2]|0[1-9]|[1-9])-(3[01]|[12][0-9]|0[1-9]|[1-9])-([0-9]{2})$')
  THEN CAST(try_strptime(
    CAST(CASE WHEN CAST(regexp_extract(trim(t), '-([0-9]{2})$', 1) AS INTEGER) >= 69
              THEN 1900 ELSE 2000 END
         + CAST(regexp_extract(trim(t), '-([0-9]{2})$', 1) AS INTEGER) AS VARCHAR)
    || '-' || lpad(regexp_extract(trim(t), '^([0-9]+)-', 1), 2, '0')
    || '-' || lpad(regexp_extract(trim(t), '^[0-9]+-([0-9]+)-', 1), 2, '0'),
    '%Y-%m-%d') AS DATE) END"""


@register("parse_order_date", group="projection", sql=_sql(f"""
SELECT Order_ID, l_linenumber, l_partkey, l_suppkey, t AS Order_Date_text,
       {_PARSE_SQL} AS Order_Date
FROM (SELECT *, strftime(Order_Date, '%m-%d-%y') AS t FROM flat)"""))
def q_parse_order_date(spark, sf):
    df = flat(spark, sf).withColumn("Order_Date_text", F.date_format("Order_Date", "MM-dd-yy"))
    return df.select(*KEY, "Order_Date_text", D.parse_mdy("Order_Date_text").alias("Order_Date"))


@register("date_parse_failures", group="quality", sql=_sql(f"""
SELECT count(*) FILTER (WHERE ({_PARSE_SQL}) IS NULL) AS date_parse_failures
FROM (SELECT CASE WHEN Quantity % 7 = 0 THEN strftime(Order_Date, '%m/%d/%Y')
                  WHEN Quantity % 11 = 0 THEN strftime(Order_Date, '%m-%d-%y') || 'x'
                  ELSE strftime(Order_Date, '%m-%d-%y') END AS t FROM flat)"""))
def q_date_parse_failures(spark, sf):
    # dates in files are sometimes written in another layout or carry junk;
    # the count of those is the check (computed on every row)
    d = F.col("Order_Date")
    text = (F.when(F.col("Quantity") % 7 == 0, F.date_format(d, "MM/dd/yyyy"))
             .when(F.col("Quantity") % 11 == 0, F.concat(F.date_format(d, "MM-dd-yy"), F.lit("x")))
             .otherwise(F.date_format(d, "MM-dd-yy")))
    return Q.date_parse_failures(flat(spark, sf).select(text.alias("t")), "t")


@register("formula_check", group="quality", sql=_sql("""
SELECT count(*) FILTER (WHERE abs(round(Revenue, 2) - round(Quantity * Unit_Price, 2)) > 0.01)
         AS revenue_formula_mismatch_rows,
       round(max(abs(round(Revenue, 2) - round(Quantity * Unit_Price, 2))), 4)
         AS revenue_formula_max_abs_diff FROM flat"""))
def q_formula_check(spark, sf):
    return Q.formula_check(flat(spark, sf))


@register("formula_check_extendedprice", group="quality", sql=_sql("""
SELECT count(*) FILTER (WHERE abs(round(l_extendedprice, 2) - round(Quantity * Unit_Price, 2)) > 0.01)
         AS revenue_formula_mismatch_rows,
       round(max(abs(round(l_extendedprice, 2) - round(Quantity * Unit_Price, 2))), 4)
         AS revenue_formula_max_abs_diff FROM flat"""))
def q_formula_check_ext(spark, sf):
    return Q.formula_check(flat(spark, sf), revenue="l_extendedprice")


@register("cardinality_orders", group="quality", sql=_sql("""
SELECT column_name AS "column", distinct_values FROM (
  SELECT 'Order_ID' AS column_name, count(DISTINCT Order_ID) AS distinct_values FROM flat UNION ALL
  SELECT 'Order_Date', count(DISTINCT Order_Date) FROM flat UNION ALL
  SELECT 'Customer_Name', count(DISTINCT Customer_Name) FROM flat UNION ALL
  SELECT 'City', count(DISTINCT City) FROM flat UNION ALL
  SELECT 'State', count(DISTINCT State) FROM flat UNION ALL
  SELECT 'Region', count(DISTINCT Region) FROM flat UNION ALL
  SELECT 'Country', count(DISTINCT Country) FROM flat UNION ALL
  SELECT 'Category', count(DISTINCT Category) FROM flat UNION ALL
  SELECT 'Sub_Category', count(DISTINCT Sub_Category) FROM flat UNION ALL
  SELECT 'Product_Name', count(DISTINCT Product_Name) FROM flat UNION ALL
  SELECT 'Quantity', count(DISTINCT Quantity) FROM flat UNION ALL
  SELECT 'Unit_Price', count(DISTINCT Unit_Price) FROM flat UNION ALL
  SELECT 'Revenue', count(DISTINCT Revenue) FROM flat UNION ALL
  SELECT 'Profit', count(DISTINCT Profit) FROM flat)
ORDER BY distinct_values DESC, "column" """))
def q_cardinality(spark, sf):
    return A.cardinality(flat(spark, sf).select(*ORDER_COLS))


# ---------------------------------------------------------------- projections

@register("time_features", group="projection", sql=_sql("""
SELECT Order_ID, l_linenumber, l_partkey, l_suppkey, Order_Date,
       CAST(year(Order_Date) AS INTEGER) AS year, CAST(month(Order_Date) AS INTEGER) AS month,
       CAST(quarter(Order_Date) AS INTEGER) AS quarter,
       CAST(isodow(Order_Date) - 1 AS INTEGER) AS day_of_week,
       CAST(CASE WHEN isodow(Order_Date) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
       dayname(Order_Date) AS day_name, strftime(Order_Date, '%Y-%m') AS month_period,
       CAST(year(Order_Date) AS VARCHAR) || 'Q' || CAST(quarter(Order_Date) AS VARCHAR) AS quarter_period
FROM flat"""))
def q_time_features(spark, sf):
    df = D.add_time_features(flat(spark, sf))
    return df.select(*KEY, "Order_Date", "year", "month", "quarter", "day_of_week", "is_weekend",
                     D.day_name("Order_Date").alias("day_name"),
                     D.month_period("Order_Date").alias("month_period"),
                     D.quarter_period("Order_Date").alias("quarter_period"))


@register("time_split", group="projection", sql=_sql(f"""
SELECT CASE WHEN Order_Date < DATE '{OM.TEST_START}' THEN 'train' ELSE 'test' END AS split,
       count(*) AS rows, min(Order_Date) AS date_min, max(Order_Date) AS date_max,
       round(sum(Revenue), 2) AS revenue
FROM flat WHERE Order_Date IS NOT NULL GROUP BY 1"""))
def q_time_split(spark, sf):
    train, test = OM.time_split(flat(spark, sf))
    def summ(df, name):
        return df.agg(F.lit(name).alias("split"), F.count(F.lit(1)).alias("rows"),
                      F.min("Order_Date").alias("date_min"), F.max("Order_Date").alias("date_max"),
                      F.round(F.sum("Revenue"), 2).alias("revenue"))
    return summ(train, "train").unionByName(summ(test, "test"))


@register("assert_time_order", group="quality", sql=_sql(f"""
SELECT (SELECT max(Order_Date) FROM flat WHERE Order_Date < DATE '{OM.TEST_START}') AS train_max,
       (SELECT min(Order_Date) FROM flat WHERE Order_Date >= DATE '{OM.TEST_START}') AS test_min,
       (SELECT max(Order_Date) FROM flat WHERE Order_Date < DATE '{OM.TEST_START}')
         < (SELECT min(Order_Date) FROM flat WHERE Order_Date >= DATE '{OM.TEST_START}') AS ordered"""))
def q_time_order(spark, sf):
    train, test = OM.time_split(flat(spark, sf))
    return Q.time_order(train, test, "Order_Date")


# ---------------------------------------------------------------- calendar bins

@register("monthly_revenue", group="summary", sql=with_ctes(
    FLAT_CTE,
    """m AS (SELECT last_day(Order_Date) AS month_end, round(sum(Revenue), 2) AS revenue
        FROM flat WHERE Order_Date IS NOT NULL GROUP BY 1)""",
    """b AS (SELECT date_trunc('month', min(Order_Date)) AS lo,
        date_trunc('month', max(Order_Date)) AS hi FROM flat)""",
    """spine AS (SELECT last_day(CAST(d AS DATE)) AS month_end
        FROM b, unnest(generate_series(b.lo, b.hi, INTERVAL 1 MONTH)) AS t(d))""",
    body="""
SELECT spine.month_end, coalesce(m.revenue, 0) AS revenue
FROM spine LEFT JOIN m ON spine.month_end = m.month_end"""))
def q_monthly_revenue(spark, sf):
    return A.monthly_sum(flat(spark, sf), "Order_Date", "Revenue", "revenue")


@register("best_month", group="summary", sql=with_ctes(FLAT_CTE, """m AS (
  SELECT last_day(Order_Date) AS month_end, round(sum(Revenue), 2) AS revenue
  FROM flat WHERE Order_Date IS NOT NULL GROUP BY 1)""", body="""
SELECT arg_max(month_end, revenue) AS month_end, max(revenue) AS revenue FROM m"""))
def q_best_month(spark, sf):
    return A.best_bin(A.monthly_sum(flat(spark, sf), "Order_Date", "Revenue", "revenue"),
                      "month_end", "revenue")


@register("quarterly_revenue", group="summary", sql=_sql("""
SELECT CAST(year(Order_Date) AS VARCHAR) || 'Q' || CAST(quarter(Order_Date) AS VARCHAR) AS quarter,
       round(sum(Revenue), 2) AS revenue FROM flat WHERE Order_Date IS NOT NULL GROUP BY 1"""))
def q_quarterly(spark, sf):
    return A.quarterly_sum(flat(spark, sf), "Order_Date", "Revenue")


@register("yearly_revenue", group="summary", sql=_sql("""
SELECT CAST(year(Order_Date) AS INTEGER) AS year, round(sum(Revenue), 2) AS revenue
FROM flat WHERE Order_Date IS NOT NULL GROUP BY 1"""))
def q_yearly(spark, sf):
    return A.yearly_sum(flat(spark, sf), "Order_Date", "Revenue")


@register("weekday_revenue", group="summary", sql=_sql("""
SELECT dayname(Order_Date) AS weekday, round(sum(Revenue), 2) AS revenue
FROM flat WHERE Order_Date IS NOT NULL GROUP BY 1 ORDER BY revenue DESC"""))
def q_weekday(spark, sf):
    return A.weekday_sum(flat(spark, sf), "Order_Date", "Revenue")


@register("best_weekday", group="summary", sql=_sql("""
SELECT arg_max(weekday, revenue) AS weekday, max(revenue) AS revenue FROM (
  SELECT dayname(Order_Date) AS weekday, round(sum(Revenue), 2) AS revenue
  FROM flat WHERE Order_Date IS NOT NULL GROUP BY 1)"""))
def q_best_weekday(spark, sf):
    return A.best_bin(A.weekday_sum(flat(spark, sf), "Order_Date", "Revenue"), "weekday", "revenue")


_DAILY_SQL = with_ctes(FLAT_CTE, """d AS (SELECT Order_Date AS day, sum(Revenue) AS revenue
        FROM flat WHERE Order_Date IS NOT NULL GROUP BY 1)""", """b AS (SELECT min(Order_Date) AS lo, max(Order_Date) AS hi FROM flat)""",
                       """spine AS (SELECT CAST(x AS DATE) AS day FROM b,
          unnest(generate_series(b.lo, b.hi, INTERVAL 1 DAY)) AS t(x))""",
                       """daily AS (SELECT spine.day, coalesce(d.revenue, 0) AS revenue
          FROM spine LEFT JOIN d ON spine.day = d.day)""", body="{body}")


@register("daily_revenue", group="summary",
          sql=_DAILY_SQL.format(body="SELECT day, round(revenue, 2) AS revenue FROM daily"))
def q_daily(spark, sf):
    return A.daily_sum(flat(spark, sf), "Order_Date", "Revenue", "revenue")


@register("rolling_daily_revenue", group="window", sql=_DAILY_SQL.format(body="""
SELECT day, round(revenue, 2) AS revenue,
       round(avg(revenue) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4) AS rolling_7,
       round(avg(revenue) OVER (ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 4) AS rolling_30
FROM daily"""))
def q_rolling_daily(spark, sf):
    daily = A.binned_over_spine(flat(spark, sf), "Order_Date", {"revenue": F.sum("Revenue")},
                                "day", "day", zero_fill=["revenue"])
    out = WN.rolling_daily(daily, "day", "revenue", (7, 30))
    return out.select("day", F.round("revenue", 2).alias("revenue"),
                      F.round("rolling_7", 4).alias("rolling_7"),
                      F.round("rolling_30", 4).alias("rolling_30"))


# ---------------------------------------------------------------- moments

@register("target_summary", group="summary", sql=_sql("""
SELECT round(avg(Revenue), 4) AS mean, round(stddev_samp(Revenue), 4) AS std,
       min(Revenue) AS min, max(Revenue) AS max, round(skewness(Revenue), 4) AS skew,
       round(skewness(ln(1 + Revenue)), 4) AS log_skew,
       round(quantile_cont(Revenue, 0.5), 2) AS median,
       round(quantile_cont(Revenue, 0.01), 2) AS p01, round(quantile_cont(Revenue, 0.05), 2) AS p05,
       round(quantile_cont(Revenue, 0.25), 2) AS p25, round(quantile_cont(Revenue, 0.5), 2) AS p50,
       round(quantile_cont(Revenue, 0.75), 2) AS p75, round(quantile_cont(Revenue, 0.95), 2) AS p95,
       round(quantile_cont(Revenue, 0.99), 2) AS p99
FROM flat"""))
def q_target_summary(spark, sf):
    return A.target_summary(flat(spark, sf), "Revenue")


_NUM = ("Quantity", "Unit_Price", "Revenue", "Profit")


@register("describe_numeric", group="summary", sql=_sql(" UNION ALL ".join(f"""
SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 2) AS mean,
       round(stddev_samp({c}), 2) AS std, round(CAST(min({c}) AS DOUBLE), 2) AS min,
       round(CAST(max({c}) AS DOUBLE), 2) AS max,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.01), 2) AS p01,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.05), 2) AS p05,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 2) AS p25,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 2) AS p50,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 2) AS p75,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.95), 2) AS p95,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.99), 2) AS p99 FROM flat""" for c in _NUM)))
def q_describe(spark, sf):
    return A.describe_numeric(flat(spark, sf), _NUM, (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99))


@register("correlation_matrix", group="summary", sql=_sql(" UNION ALL ".join(
    f"SELECT '{a}' AS \"row\", '{b}' AS col, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 4) + 0.0 AS corr FROM flat"
    for a in _NUM for b in _NUM)))
def q_correlation(spark, sf):
    return A.correlation_long(flat(spark, sf), _NUM)


@register("value_counts_category", group="summary", sql=_sql("""
SELECT Category, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS share
FROM flat WHERE Category IS NOT NULL GROUP BY Category"""))
def q_vc_category(spark, sf):
    return A.value_counts(flat(spark, sf), "Category")


@register("value_counts_quantity", group="summary", sql=_sql("""
SELECT Quantity, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS share
FROM flat WHERE Quantity IS NOT NULL GROUP BY Quantity"""))
def q_vc_quantity(spark, sf):
    return A.value_counts(flat(spark, sf), "Quantity")


# ---------------------------------------------------------------- chart tables

def _hist_sql(expr: str, bins: int) -> str:
    return with_ctes(FLAT_CTE, f"""x AS (SELECT CAST({expr} AS DOUBLE) AS v FROM flat WHERE {expr} IS NOT NULL)""",
                     """s AS (SELECT min(v) AS lo, max(v) AS hi, count(*) AS n FROM x)""",
                     f"""b AS (SELECT CAST(least(floor((v - lo) / ((hi - lo) / {bins})), {bins} - 1) AS INTEGER) AS bin,
          count(*) AS c FROM x, s GROUP BY 1)""",
                     f"""sp AS (SELECT CAST(i AS INTEGER) AS bin FROM range(0, {bins}) AS t(i))""", body=f"""
SELECT sp.bin, round(lo + sp.bin * (hi - lo) / {bins}, 4) AS bin_start,
       round(lo + (sp.bin + 1) * (hi - lo) / {bins}, 4) AS bin_end,
       coalesce(b.c, 0) AS count,
       round(coalesce(b.c, 0) / (n * ((hi - lo) / {bins})), 10) AS density
FROM sp CROSS JOIN s LEFT JOIN b ON sp.bin = b.bin""")


@register("histogram_revenue", group="chart", sql=_hist_sql("Revenue", 60))
def q_hist(spark, sf):
    return CH.histogram(flat(spark, sf), F.col("Revenue"), 60)


@register("histogram_log_revenue", group="chart", sql=_hist_sql("ln(1 + Revenue)", 60))
def q_hist_log(spark, sf):
    return CH.histogram(flat(spark, sf), F.log1p("Revenue"), 60)


def _box_sql(group: str) -> str:
    return with_ctes(FLAT_CTE, f"""q AS (SELECT {group}, quantile_cont(Revenue, 0.25) AS q1,
          quantile_cont(Revenue, 0.5) AS median, quantile_cont(Revenue, 0.75) AS q3
          FROM flat WHERE {group} IS NOT NULL AND Revenue IS NOT NULL GROUP BY {group})""", body=f"""
SELECT q.{group}, round(q1, 3) AS q1, round(median, 3) AS median, round(q3, 3) AS q3,
       round(min(Revenue) FILTER (WHERE Revenue >= q1 - 1.5 * (q3 - q1)), 3) AS whisker_low,
       round(max(Revenue) FILTER (WHERE Revenue <= q3 + 1.5 * (q3 - q1)), 3) AS whisker_high,
       count(*) FILTER (WHERE Revenue < q1 - 1.5 * (q3 - q1) OR Revenue > q3 + 1.5 * (q3 - q1))
         AS outliers,
       count(*) AS count
FROM flat JOIN q ON flat.{group} = q.{group}
GROUP BY q.{group}, q1, median, q3""")


@register("box_stats_category", group="chart", sql=_box_sql("Category"))
def q_box_category(spark, sf):
    return CH.box_stats(flat(spark, sf), "Revenue", "Category")


@register("box_stats_region", group="chart", sql=_box_sql("Region"))
def q_box_region(spark, sf):
    return CH.box_stats(flat(spark, sf), "Revenue", "Region")


@register("reg_line_price_revenue", group="chart", sql=_sql("""
SELECT round(regr_slope(Revenue, Unit_Price), 6) AS slope,
       round(regr_intercept(Revenue, Unit_Price), 4) AS intercept,
       count(*) FILTER (WHERE Revenue IS NOT NULL AND Unit_Price IS NOT NULL) AS n FROM flat"""))
def q_reg_line(spark, sf):
    return CH.reg_line(flat(spark, sf), "Unit_Price", "Revenue")


@register("scaled_values", group="chart", sql=_sql("""
SELECT Order_ID, l_linenumber, l_partkey, l_suppkey,
       round((Unit_Price - avg(Unit_Price) OVER ()) / stddev_pop(Unit_Price) OVER (), 6) AS Unit_Price_z,
       round((Revenue - avg(Revenue) OVER ()) / stddev_pop(Revenue) OVER (), 6) AS Revenue_z
FROM flat"""))
def q_scaled(spark, sf):
    return CH.scaled_values(flat(spark, sf), ["Unit_Price", "Revenue"], KEY)


@register("head_n_orders", group="topk", sql=_sql("""
SELECT Order_ID, l_linenumber, l_partkey, l_suppkey, Order_Date, Revenue FROM flat
ORDER BY Order_Date, Order_ID, l_linenumber, l_partkey, l_suppkey LIMIT 1000"""))
def q_head_n(spark, sf):
    return WN.head_n(flat(spark, sf), ["Order_Date"] + KEY, 1000).select(*KEY, "Order_Date", "Revenue")


# ------------------------------------------------------- train-only lookup features

_LOOKUP_SQL = f"""train AS (SELECT * FROM flat WHERE Order_Date < DATE '{OM.TEST_START}')"""


@register("aggregate_lookups", group="features", sql=with_ctes(FLAT_CTE, _LOOKUP_SQL, body="""
SELECT 'product_order_count' AS feature, Product_Name AS key, CAST(count(*) AS DOUBLE) AS value
  FROM train WHERE Product_Name IS NOT NULL GROUP BY 2 UNION ALL
SELECT 'product_avg_revenue', Product_Name, round(avg(Revenue), 6) FROM train WHERE Product_Name IS NOT NULL GROUP BY 2 UNION ALL
SELECT 'product_avg_quantity', Product_Name, round(avg(Quantity), 6) FROM train WHERE Product_Name IS NOT NULL GROUP BY 2 UNION ALL
SELECT 'category_avg_revenue', Category, round(avg(Revenue), 6) FROM train WHERE Category IS NOT NULL GROUP BY 2 UNION ALL
SELECT 'category_avg_quantity', Category, round(avg(Quantity), 6) FROM train WHERE Category IS NOT NULL GROUP BY 2 UNION ALL
SELECT 'sub_category_avg_quantity', Sub_Category, round(avg(Quantity), 6) FROM train WHERE Sub_Category IS NOT NULL GROUP BY 2 UNION ALL
SELECT 'state_avg_revenue', State, round(avg(Revenue), 6) FROM train WHERE State IS NOT NULL GROUP BY 2 UNION ALL
SELECT 'state_avg_quantity', State, round(avg(Quantity), 6) FROM train WHERE State IS NOT NULL GROUP BY 2 UNION ALL
SELECT 'region_avg_revenue', Region, round(avg(Revenue), 6) FROM train WHERE Region IS NOT NULL GROUP BY 2 UNION ALL
SELECT 'region_avg_quantity', Region, round(avg(Quantity), 6) FROM train WHERE Region IS NOT NULL GROUP BY 2"""))
def q_lookups(spark, sf):
    train, _ = OM.time_split(flat(spark, sf))
    return OM.lookups_long(OM.fit_lookups(train))


@register("aggregate_defaults", group="features", sql=with_ctes(FLAT_CTE, _LOOKUP_SQL, body="""
SELECT round((SELECT median(c) FROM (SELECT count(*) AS c FROM train WHERE Product_Name IS NOT NULL
              GROUP BY Product_Name)), 6) AS product_order_count_default,
       round(avg(Quantity), 6) AS quantity_default, round(avg(Revenue), 6) AS revenue_default
FROM train"""))
def q_defaults(spark, sf):
    train, _ = OM.time_split(flat(spark, sf))
    d = OM.fit_defaults(train, OM.fit_lookups(train))
    return d.select(*[F.round(c, 6).alias(c) for c in d.columns])


def _features_sql(split: str) -> str:
    cond = "<" if split == "train" else ">="
    feats = []
    for key, cols in OM.LOOKUP_SPECS.items():
        for name, (agg, _src) in cols.items():
            feats.append((key, name))
    body_cols = []
    joins = []
    for i, key in enumerate(OM.LOOKUP_SPECS):
        joins.append(f"LEFT JOIN lk_{i} ON rows.{key} = lk_{i}.k")
    ctes = [FLAT_CTE, _LOOKUP_SQL,
            f"rows AS (SELECT * FROM flat WHERE Order_Date {cond} DATE '{OM.TEST_START}')",
            """dflt AS (SELECT (SELECT median(c) FROM (SELECT count(*) AS c FROM train
                 WHERE Product_Name IS NOT NULL GROUP BY Product_Name)) AS cnt_d,
               avg(Quantity) AS qty_d, avg(Revenue) AS rev_d FROM train)"""]
    for i, (key, cols) in enumerate(OM.LOOKUP_SPECS.items()):
        sel = []
        for name, (agg, src) in cols.items():
            sel.append(("count(*)" if agg == "count" else f"avg({src})") + f" AS {name}")
        ctes.append(f"lk_{i} AS (SELECT {key} AS k, {', '.join(sel)} FROM train "
                    f"WHERE {key} IS NOT NULL GROUP BY {key})")
        for name, (agg, src) in cols.items():
            d = "cnt_d" if agg == "count" else ("qty_d" if src == "Quantity" else "rev_d")
            body_cols.append(f"round(coalesce(lk_{i}.{name}, dflt.{d}), 6) AS {name}")
    for exp_name, qty_feat in OM.EXPECTED_REVENUE.items():
        key_i, d = next((i, "qty_d") for i, (k, cols) in enumerate(OM.LOOKUP_SPECS.items())
                        if qty_feat in cols)
        body_cols.append(f"round(Unit_Price * coalesce(lk_{key_i}.{qty_feat}, dflt.{d}), 4) AS {exp_name}")
    body = (f"SELECT rows.Order_ID, rows.l_linenumber, rows.l_partkey, rows.l_suppkey, "
            f"{', '.join(body_cols)} FROM rows CROSS JOIN dflt {' '.join(joins)}")
    return with_ctes(*ctes, body=body)


@register("aggregate_features_test", group="features", sql=_features_sql("test"))
def q_features_test(spark, sf):
    return OM.feature_output(prepared(spark, sf).test, KEY)


@register("aggregate_features_train", group="features", sql=_features_sql("train"))
def q_features_train(spark, sf):
    return OM.feature_output(prepared(spark, sf).train, KEY)


@register("global_split_metadata", group="features", sql=with_ctes(FLAT_CTE, _LOOKUP_SQL, f"""test AS (
  SELECT * FROM flat WHERE Order_Date >= DATE '{OM.TEST_START}')""", body="""
SELECT (SELECT count(*) FROM train) AS train_rows, (SELECT count(*) FROM test) AS test_rows,
       (SELECT min(Order_Date) FROM train) AS train_start, (SELECT max(Order_Date) FROM train) AS train_end,
       (SELECT min(Order_Date) FROM test) AS test_start, (SELECT max(Order_Date) FROM test) AS test_end,
       (SELECT count(DISTINCT Product_Name) FROM train) AS products,
       (SELECT count(DISTINCT Category) FROM train) AS categories,
       (SELECT count(DISTINCT Sub_Category) FROM train) AS sub_categories,
       (SELECT count(DISTINCT State) FROM train) AS states,
       (SELECT count(DISTINCT Region) FROM train) AS regions"""))
def q_split_meta(spark, sf):
    return OM.split_metadata(flat(spark, sf))


# ------------------------------------------- naive forecast diagnostics (expected revenue)
# The expected-revenue feature (price x train mean quantity of the product) is
# the simplest forecaster of this problem; its residual tables run end to end
# in SQL as well.

def _diag_sql(body: str) -> str:
    base = _features_sql("test")
    # wrap the feature query as a CTE and join the actual values back
    inner = base.split("\nSELECT rows.Order_ID", 1)
    head = inner[0]
    sel = "SELECT rows.Order_ID" + inner[1]
    sel = sel.replace("SELECT rows.Order_ID, rows.l_linenumber, rows.l_partkey, rows.l_suppkey,",
                      "SELECT rows.Order_ID, rows.l_linenumber, rows.l_partkey, rows.l_suppkey, "
                      "rows.Order_Date, rows.Category, rows.Revenue,", 1)
    return head + ",\nfeat AS (" + sel + "),\n" + \
        "pred AS (SELECT *, Revenue AS actual, expected_revenue_product AS predicted, " \
        "Revenue - expected_revenue_product AS residual FROM feat)\n" + body


@register("naive_regression_metrics", group="metrics", sql=_diag_sql("""
SELECT round(avg(abs(residual)), 4) AS MAE, round(avg(residual * residual), 4) AS MSE,
       round(sqrt(avg(residual * residual)), 4) AS RMSE,
       round(CASE WHEN var_pop(actual) > 0 THEN 1 - sum(residual * residual) / (var_pop(actual) * count(*))
             WHEN sum(residual * residual) = 0 THEN 1.0 ELSE 0.0 END, 4) AS R2
FROM pred"""))
def q_naive_metrics(spark, sf):
    return OM.naive_metrics(flat(spark, sf), KEY, prepared(spark, sf))


@register("residual_by_category", group="metrics", sql=_diag_sql("""
SELECT Category, round(avg(residual), 4) AS mean_residual, round(stddev_samp(residual), 4) AS std_residual,
       count(residual) AS count, round(median(residual), 4) AS median_residual
FROM pred WHERE Category IS NOT NULL GROUP BY Category"""))
def q_resid_category(spark, sf):
    pred = OM.naive_predictions(flat(spark, sf), KEY, prepared(spark, sf))
    return A.residual_summary(pred, "Category", "residual")


@register("residual_by_month", group="metrics", sql=_diag_sql("""
SELECT strftime(Order_Date, '%Y-%m') AS month, round(avg(residual), 4) AS mean_residual,
       round(stddev_samp(residual), 4) AS std_residual, count(residual) AS count,
       round(median(residual), 4) AS median_residual
FROM pred WHERE Order_Date IS NOT NULL GROUP BY 1"""))
def q_resid_month(spark, sf):
    pred = OM.naive_predictions(flat(spark, sf), KEY, prepared(spark, sf))
    return A.residual_summary(pred, D.month_period("Order_Date"), "residual", name="month")


@register("pred_vs_actual", group="chart", sql=_diag_sql("""
SELECT Order_ID, l_linenumber, l_partkey, l_suppkey, round(actual, 4) AS actual,
       round(predicted, 4) AS predicted, round(residual, 4) AS residual,
       round(max(greatest(actual, predicted)) OVER (), 4) AS axis_max
FROM pred"""))
def q_pred_vs_actual(spark, sf):
    pred = OM.naive_predictions(flat(spark, sf), KEY, prepared(spark, sf))
    return CH.pred_vs_actual(pred, "actual", "predicted", KEY)


@register("epsilon_tube", group="chart", sql=_diag_sql("""
SELECT round(m.mae, 4) AS epsilon,
       round(avg(CASE WHEN abs(residual) <= m.mae THEN 1.0 ELSE 0.0 END), 6) AS inside_share,
       round(min(actual), 4) AS band_start, round(max(actual), 4) AS band_end
FROM pred CROSS JOIN (SELECT avg(abs(residual)) AS mae FROM pred) m GROUP BY m.mae"""))
def q_epsilon_tube(spark, sf):
    pred = OM.naive_predictions(flat(spark, sf), KEY, prepared(spark, sf))
    return CH.epsilon_tube(pred, "actual", "predicted")


@register("bin2d_actual_predicted", group="chart", sql=_diag_sql("""
SELECT CAST(least(floor((actual - lo) / ((hi - lo) / 40)), 39) AS INTEGER) AS x_bin,
       CAST(least(floor((predicted - lo) / ((hi - lo) / 40)), 39) AS INTEGER) AS y_bin,
       count(*) AS count
FROM pred CROSS JOIN (SELECT least(min(actual), min(predicted)) AS lo,
                             greatest(max(actual), max(predicted)) AS hi FROM pred) b
GROUP BY 1, 2"""))
def q_bin2d(spark, sf):
    pred = OM.naive_predictions(flat(spark, sf), KEY, prepared(spark, sf))
    return CH.bin2d(pred, "actual", "predicted", 40)


@register("ordered_prediction_line", group="window", sql=_diag_sql("""
SELECT Order_ID, l_linenumber, l_partkey, l_suppkey, Order_Date, round(actual, 4) AS actual,
       round(predicted, 4) AS predicted, n
FROM (SELECT *, row_number() OVER (ORDER BY Order_Date, Order_ID, l_linenumber, l_partkey, l_suppkey) AS n
      FROM pred) WHERE n <= 500"""))
def q_prediction_line(spark, sf):
    pred = OM.naive_predictions(flat(spark, sf), KEY, prepared(spark, sf))
    out = WN.ordered_head(pred, ["Order_Date"] + KEY, 500, "n")
    return out.select(*KEY, "Order_Date", F.round("actual", 4).alias("actual"),
                      F.round("predicted", 4).alias("predicted"), "n")


@register("order_text_roundtrip", group="sources", sql=_sql(f"""
SELECT count(*) AS rows, count(*) FILTER (WHERE parsed = Order_Date) AS same_date
FROM (SELECT Order_Date, {_PARSE_SQL} AS parsed
      FROM (SELECT Order_Date, strftime(Order_Date, '%m-%d-%y') AS t FROM flat))"""))
def q_text_roundtrip(spark, sf):
    """Dates written as text the way order files carry them parse back to the
    same day (covers the 19xx / 20xx two-digit-year rule)."""
    both = flat(spark, sf).select("Order_Date").withColumn(
        "t", F.date_format("Order_Date", "MM-dd-yy"))
    return both.agg(F.count(F.lit(1)).alias("rows"),
                    F.count_if(D.parse_mdy("t") == F.col("Order_Date")).alias("same_date"))


@register("load_clean_validate_csv", group="sources", sql=_sql("""
SELECT count(*) AS rows, 14 AS columns, 3 AS stripped_columns,
       CAST(0 AS BIGINT) AS missing_total,
       count(*) FILTER (WHERE Order_Date IS NULL) AS date_parse_failures,
       CAST(min(Order_Date) AS VARCHAR) AS date_min, CAST(max(Order_Date) AS VARCHAR) AS date_max,
       count(*) FILTER (WHERE abs(round(Revenue, 2) - round(Quantity * Unit_Price, 2)) > 0.01)
         AS revenue_formula_mismatch_rows,
       round(max(abs(round(Revenue, 2) - round(Quantity * Unit_Price, 2))), 4)
         AS revenue_formula_max_abs_diff,
       (SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT Order_ID, Order_Date,
               Customer_Name, City, State, Region, Country, Category, Sub_Category, Product_Name,
               Quantity, Unit_Price, Revenue, Profit FROM flat)) AS BIGINT) FROM flat)
         AS duplicate_rows
FROM flat"""))
def q_load_clean_validate(spark, sf):
    """The order table written as the source CSV (text dates, blank-padded
    money headers) into the shared folder, then loaded, cleaned and checked."""
    import uuid

    from salescope.session import checkpoint_dir
    from salescope.sources.orders import load_clean_validate, write_order_csv
    path = f"{checkpoint_dir(spark)}/orders-csv-{uuid.uuid4().hex}"
    write_order_csv(flat(spark, sf).select(*ORDER_COLS), path)
    _, checks = load_clean_validate(spark, path)
    return checks.withColumn("missing_total", F.col("missing_total").cast("long"))
