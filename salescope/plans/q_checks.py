"""Registered queries that put further operators next to SQL: imputation,
scaling, codes and bins fitted on train rows, constant and naive forecasts,
selection among the baselines, source round trips, samples and chart tables."""

from __future__ import annotations

import uuid
from statistics import NormalDist

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from salescope.functions import columns as C
from salescope.operators import aggregates as A
from salescope.operators import chartdata as CH
from salescope.operators import encoders as EN
from salescope.operators import gram as GR
from salescope.operators import joins as J
from salescope.operators import metrics as M
from salescope.operators import models as MD
from salescope.operators import quality as Q
from salescope.operators import windows as WN
from salescope.plans import modeling as ML
from salescope.plans import order_model as OM
from salescope.plans import store_sales as S
from salescope.plans.catalog import (FLAT_CTE, HOLIDAYS_CTE, OIL_CTE, PANEL_CTE, STORES_CTE,
                                     TRANSACTIONS_CTE, register, with_ctes)
from salescope.plans.q_orders import KEY, ORDER_COLS, _diag_sql, flat, prepared
from salescope.plans.q_panel import (_SPLIT_CTES, _TEST_CTES, feature_frame, ff_sql, tables, train)
from salescope.plans.scoring import parse_json_orders
from salescope.session import checkpoint_dir
from salescope.sources.panel import PANEL_SCHEMAS, read_panel
from salescope.sources.sinks import write_metrics, write_sections

_TRAIN_CTE = f"train AS (SELECT * FROM flat WHERE Order_Date < DATE '{OM.TEST_START}')"
_TEST_CTE = f"test AS (SELECT * FROM flat WHERE Order_Date >= DATE '{OM.TEST_START}')"


def _orders_sql(body: str, *ctes: str) -> str:
    return with_ctes(FLAT_CTE, *ctes, body=body)


def _train(spark, sf):
    return OM.time_split(flat(spark, sf))[0]


def _test(spark, sf):
    return OM.time_split(flat(spark, sf))[1]


# ------------------------------------------------------------ fitted state (train rows only)

_NUMERIC = ("Unit_Price", "Quantity", "Profit")
_CODED = ("Region", "Category", "Sub_Category", "Product_Name")


@register("imputation_medians", group="features", sql=_orders_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(median(CAST({c} AS DOUBLE)), 4) AS value FROM train" for c in _NUMERIC),
    _TRAIN_CTE))
def q_medians(spark, sf):
    got = EN.fit_medians(_train(spark, sf), _NUMERIC)
    return spark.createDataFrame(list(got.items()), "column string, value double").withColumn(
        "value", F.round("value", 4))


@register("imputation_modes", group="features", sql=_orders_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", (SELECT {c} FROM train WHERE {c} IS NOT NULL GROUP BY {c} "
    f"ORDER BY count(*) DESC, {c} LIMIT 1) AS value" for c in _CODED), _TRAIN_CTE))
def q_modes(spark, sf):
    got = EN.fit_modes(_train(spark, sf), _CODED)
    return spark.createDataFrame(list(got.items()), "column string, value string")


@register("standard_scaling", group="features", sql=_orders_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std FROM train"
    for c in _NUMERIC), _TRAIN_CTE))
def q_scaling(spark, sf):
    got = EN.fit_scaling(_train(spark, sf), _NUMERIC, {})
    return spark.createDataFrame([(c, m, s) for c, (m, s) in got.items()],
                                 "column string, mean double, std double").select(
        "column", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@register("ordinal_codes", group="features", sql=_orders_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c} AS value, CAST(row_number() OVER (ORDER BY {c}) - 1 AS INTEGER) AS code "
    f"FROM (SELECT DISTINCT {c} FROM train WHERE {c} IS NOT NULL)" for c in _CODED), _TRAIN_CTE))
def q_codes(spark, sf):
    tables_ = EN.fit_code_tables(_train(spark, sf), _CODED)
    return ML.union_all([t.select(F.lit(c).alias("column"), F.col(c).alias("value"),
                                  F.col(f"{c}__code").alias("code")) for c, t in tables_.items()])


_LEVELS = "[" + ", ".join(repr(i / 255) for i in range(256)) + "]"


@register("quantile_bins", group="features", sql=_orders_sql("""
SELECT CAST(len(list_filter(inner_edges, lambda e: e <= Unit_Price)) AS INTEGER) AS bin, count(*) AS count,
       round(min(Unit_Price), 4) AS lowest, round(max(Unit_Price), 4) AS highest
FROM test, edges GROUP BY 1""", _TRAIN_CTE, _TEST_CTE, f"""edges AS (SELECT e[2:len(e) - 1] AS inner_edges FROM (
  SELECT list_sort(list_distinct(quantile_cont(CAST(Unit_Price AS DOUBLE), {_LEVELS}))) AS e FROM train))"""))
def q_bins(spark, sf):
    """Test rows by the percentile bin of their price (edges from train)."""
    edges = EN.quantile_bin_edges(_train(spark, sf), ["Unit_Price"])
    binned = EN.bin_columns(_test(spark, sf), edges)
    return binned.groupBy(F.col("Unit_Price__b").cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("count"), F.round(F.min("Unit_Price"), 4).alias("lowest"),
        F.round(F.max("Unit_Price"), 4).alias("highest"))


@register("variant_notes", group="models", sql=_orders_sql("""
SELECT v.variant, v.note AS feature_set_note, count(*) AS test_rows FROM test
CROSS JOIN (VALUES """ + ", ".join(f"('{k}', '{v}')" for k, v in C.VARIANT_NOTES.items()) + """) v(variant, note)
GROUP BY 1, 2""", _TEST_CTE))
def q_variant_notes(spark, sf):
    """Both variants with their note and the test rows that they are measured on."""
    each = _test(spark, sf).select(F.explode(F.array(*[F.lit(v) for v in ML.VARIANTS])).alias("variant"))
    return each.groupBy("variant").agg(F.count(F.lit(1)).alias("test_rows")).withColumn(
        "feature_set_note", C.variant_note("variant"))


# ------------------------------------------------------------ constant and naive forecasts

def _metric_sql(err: str, y: str) -> str:
    return f"""round(avg(abs({err})), 4) AS MAE, round(avg(({err}) * ({err})), 4) AS MSE,
       round(sqrt(avg(({err}) * ({err}))), 4) AS RMSE,
       round(CASE WHEN var_pop({y}) > 0 THEN 1 - sum(({err}) * ({err})) / (var_pop({y}) * count(*))
             WHEN sum(({err}) * ({err})) = 0 THEN 1.0 ELSE 0.0 END, 4) AS R2"""


@register("constant_baselines", group="metrics", sql=_orders_sql(" UNION ALL ".join(
    f"SELECT 'Baseline_{n}' AS model, {_metric_sql('Revenue - c', 'Revenue')} "
    f"FROM test, (SELECT {f}(CAST(Revenue AS DOUBLE)) AS c FROM train)"
    for n, f in (("Mean", "avg"), ("Median", "median"))), _TRAIN_CTE, _TEST_CTE))
def q_constants(spark, sf):
    tr, te = _train(spark, sf), _test(spark, sf)
    return ML.union_all([M.metrics_row(fit(tr, "Revenue").predict(te), "Revenue", "prediction", {"model": name})
                         for name, fit in (("Baseline_Mean", MD.mean_fit), ("Baseline_Median", MD.median_fit))])


_QUANTITY_CTES = """,
bounds AS (SELECT min(Quantity) AS lo, max(Quantity) AS hi FROM flat),
q AS (SELECT f.Quantity AS y, f.Unit_Price, f.Revenue, p.product_avg_quantity AS p,
             round_even(greatest(least(p.product_avg_quantity, hi), lo), 0) AS r
      FROM pred p JOIN flat f USING (Order_ID, l_linenumber, l_partkey, l_suppkey), bounds)
"""


def _naive_quantity(spark, sf):
    rows = prepared(spark, sf).test
    b = flat(spark, sf).agg(F.min("Quantity").alias("lo"), F.max("Quantity").alias("hi")).first()
    return rows, float(b["lo"]), float(b["hi"])


@register("naive_quantity_metrics", group="metrics", sql=_diag_sql(_QUANTITY_CTES + """
SELECT round(avg(abs(y - p)), 4) AS MAE, round(sqrt(avg((y - p) * (y - p))), 4) AS RMSE,
       round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 4) AS R2,
       round(avg(abs(y - r)), 4) AS MAE_rounded, round(avg(CAST(y = r AS DOUBLE)), 4) AS Exact_Accuracy,
       round(avg(CAST(abs(y - r) <= 1 AS DOUBLE)), 4) AS Within_1_Accuracy FROM q"""))
def q_naive_quantity(spark, sf):
    rows, lo, hi = _naive_quantity(spark, sf)
    return M.quantity_metrics(rows, "Quantity", "product_avg_quantity", lo, hi)


@register("naive_downstream_revenue", group="metrics", sql=_diag_sql(_QUANTITY_CTES + " UNION ALL ".join(
    f"SELECT '{name}' AS method, {_metric_sql(f'Revenue - Unit_Price * {c}', 'Revenue')} FROM q"
    for name, c in (("Unit_Price * Quantity_hat", "p"), ("Unit_Price * rounded_Quantity_hat", "r")))))
def q_naive_downstream(spark, sf):
    rows, lo, hi = _naive_quantity(spark, sf)
    return ML.downstream_revenue(rows, "product_avg_quantity", lo, hi)


@register("rounded_quantity_counts", group="projection", sql=_diag_sql(_QUANTITY_CTES + """
SELECT CAST(r AS DOUBLE) AS rounded, count(*) AS count FROM q GROUP BY 1"""))
def q_rounded(spark, sf):
    rows, lo, hi = _naive_quantity(spark, sf)
    return rows.groupBy(C.rounded_quantity("product_avg_quantity", lo, hi).alias("rounded")).agg(
        F.count(F.lit(1)).alias("count"))


# ------------------------------------------------------------ selection among the baselines

def _sales_sql(by: str = "", model: str = "") -> str:
    parts = []
    for i, (name, col) in enumerate(S.BASELINES.items()):
        p = f"greatest({col}, 0)"
        parts.append(f"""SELECT {by + ',' if by else ''} '{model}{name}' AS model, {i} AS listing_order,
  round(sqrt(avg(power(ln(1 + sales) - ln(1 + {p}), 2))), 4) AS RMSLE, round(avg(abs(sales - {p})), 4) AS MAE,
  round(sqrt(avg(power(sales - {p}, 2))), 4) AS RMSE FROM ff, vb WHERE ff.date >= vb.vs
  {'GROUP BY ' + by if by else ''}""")
    return " UNION ALL ".join(parts)


def _baseline_rows(valid, by=()):
    return ML.union_all([M.metrics_row(valid, "sales", col, {"model": name, "listing_order": i}, "sales", by=by)
                         for i, (name, col) in enumerate(S.BASELINES.items())])


@register("best_baseline_by_store", group="topk", sql=ff_sql(f"""
SELECT store_nbr AS variant, model, listing_order, RMSLE, MAE, RMSE FROM ({_sales_sql('store_nbr')})
QUALIFY row_number() OVER (PARTITION BY store_nbr ORDER BY RMSE, listing_order) = 1""", extra_ctes=_SPLIT_CTES))
def q_best_by_store(spark, sf):
    valid = S.recent_window_split(feature_frame(spark, sf)).valid
    rows = _baseline_rows(valid, ["store_nbr"]).withColumnRenamed("store_nbr", "variant").drop("R2")
    return ML.best_by_variant(rows)


@register("selected_baseline", group="topk", sql=ff_sql(f"""
SELECT model, RMSLE, MAE, RMSE FROM ({_sales_sql()}) ORDER BY RMSLE, listing_order LIMIT 1""",
                                                      extra_ctes=_SPLIT_CTES))
def q_selected_baseline(spark, sf):
    rows = _baseline_rows(S.recent_window_split(feature_frame(spark, sf)).valid).persist()
    name = ML.select_model(rows, "RMSLE")
    return rows.where(F.col("model") == name).select("model", "RMSLE", "MAE", "RMSE")


# ------------------------------------------------------------ sources

@register("panel_csv_roundtrip", group="sources", sql=with_ctes(
    PANEL_CTE, *_TEST_CTES, STORES_CTE, OIL_CTE, HOLIDAYS_CTE, TRANSACTIONS_CTE, body="""
SELECT 'train' AS "table", count(*) AS rows, count(sales) AS filled, round(sum(sales), 2) AS total FROM ids
UNION ALL SELECT 'test', count(*), count(onpromotion), CAST(sum(id) AS DOUBLE) FROM test_rows
UNION ALL SELECT 'stores', count(*), count(type), CAST(sum(cluster) AS DOUBLE) FROM stores
UNION ALL SELECT 'oil', count(*), count(dcoilwtico), round(sum(dcoilwtico), 2) FROM oil
UNION ALL SELECT 'holidays_events', count(*), count(locale), CAST(count(*) FILTER (WHERE transferred) AS DOUBLE) FROM holidays_events
UNION ALL SELECT 'transactions', count(*), count(transactions), CAST(sum(transactions) AS DOUBLE) FROM transactions"""))
def q_panel_roundtrip(spark, sf):
    """The six panel tables written as CSV files into the shared folder and
    read back with the declared schemas."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/panel-csv-{uuid.uuid4().hex}"
    t = tables(spark, sf)
    for name, schema in PANEL_SCHEMAS.items():
        have = set(t[name].columns)
        cols = [F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
                for f in schema]
        t[name].select(*cols).write.option("header", True).csv(f"{folder}/{name}.csv")
    got = read_panel(spark, folder)
    what = {"train": ("sales", F.round(F.sum("sales"), 2)), "test": ("onpromotion", F.sum("id")),
            "stores": ("type", F.sum("cluster")), "oil": ("dcoilwtico", F.round(F.sum("dcoilwtico"), 2)),
            "holidays_events": ("locale", F.count_if("transferred")),
            "transactions": ("transactions", F.sum("transactions"))}
    return ML.union_all([got[n].agg(F.lit(n).alias("table"), F.count(F.lit(1)).alias("rows"),
                                    F.count(c).alias("filled"), total.cast("double").alias("total"))
                         for n, (c, total) in what.items()])


@register("json_orders", group="sources", sql=_orders_sql("""
SELECT Category, count(*) AS orders, round(sum(Unit_Price), 2) AS price, CAST(sum(Quantity) AS BIGINT) AS quantity,
       min(strftime(Order_Date, '%m-%d-%y')) AS first_text, max(Product_Name) AS last_product
FROM test GROUP BY Category""", _TEST_CTE))
def q_json_orders(spark, sf):
    """Test orders as JSON text, parsed back with the declared schema."""
    text = _test(spark, sf).select(F.to_json(F.struct(
        F.date_format("Order_Date", "MM-dd-yy").alias("Order_Date"), "City", "State", "Region", "Category",
        "Sub_Category", "Product_Name", "Unit_Price", "Quantity")).alias("value"))
    return parse_json_orders(text).groupBy("Category").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("Unit_Price"), 2).alias("price"),
        F.sum("Quantity").alias("quantity"), F.min("Order_Date").alias("first_text"),
        F.max("Product_Name").alias("last_product"))


# ------------------------------------------------------------ samples and chart tables

_KEYS = ", ".join(KEY)


@register("scatter_sample", group="chart", sql=_orders_sql(f"""
SELECT {_KEYS}, Unit_Price, Quantity, Revenue, Profit FROM flat
ORDER BY md5(concat_ws('|', {_KEYS}, 42)), {_KEYS} LIMIT 15000"""))
def q_scatter(spark, sf):
    cols = ["Unit_Price", "Quantity", "Revenue", "Profit"]
    return WN.hash_sample(flat(spark, sf), 15000, KEY, seed=42).select(*KEY, *cols)


@register("scatter_six_features", group="chart", sql=_orders_sql(f"""
SELECT {_KEYS}, Quantity, Unit_Price, Profit, CAST(month(Order_Date) AS INTEGER) AS month,
       CAST(isodow(Order_Date) - 1 AS INTEGER) AS day_of_week, CAST(quarter(Order_Date) AS INTEGER) AS quarter, Revenue
FROM flat ORDER BY md5(concat_ws('|', {_KEYS}, 42)), {_KEYS} LIMIT 20000"""))
def q_scatter_six(spark, sf):
    rows = WN.hash_sample(flat(spark, sf), 20000, KEY, seed=42)
    return rows.select(*KEY, "Quantity", "Unit_Price", "Profit", F.month("Order_Date").alias("month"),
                       F.weekday("Order_Date").alias("day_of_week"), F.quarter("Order_Date").alias("quarter"), "Revenue")


@register("sample_n_panel", group="topk", sql=with_ctes(PANEL_CTE, *_TEST_CTES, body="""
SELECT id, date, store_nbr, family, sales, onpromotion FROM ids ORDER BY md5(concat_ws('|', id, 42)), id LIMIT 1000"""))
def q_sample_panel(spark, sf):
    return WN.hash_sample(train(spark, sf), 1000, ["id"], seed=42).select(
        "id", "date", "store_nbr", "family", "sales", "onpromotion")


@register("kde_revenue", group="chart", sql=_orders_sql("""
SELECT CAST(i AS INTEGER) AS i, round(a + i * ((b - a) / 299), 6) AS x,
       round(sum(w * exp(-0.5 * power((a + i * ((b - a) / 299) - v) / h, 2))) / (n * h * sqrt(2 * pi())), 10) AS density
FROM w, s, range(0, 300) AS t(i) GROUP BY i, a, b, n, h""",
    "w AS (SELECT CAST(Revenue AS DOUBLE) AS v, count(*) AS w FROM flat WHERE Revenue IS NOT NULL GROUP BY 1)",
    """s AS (SELECT quantile_cont(CAST(Revenue AS DOUBLE), 0.005) AS a, quantile_cont(CAST(Revenue AS DOUBLE), 0.995) AS b,
       count(Revenue) AS n, stddev_samp(CAST(Revenue AS DOUBLE)) * power(count(Revenue), -0.2) AS h FROM flat)"""))
def q_kde(spark, sf):
    return CH.kde(flat(spark, sf), F.col("Revenue"), 300).select(
        "i", F.round("x", 6).alias("x"), F.round("density", 10).alias("density"))


_QQ = CH.plotting_positions(500)


@register("qq_points_revenue", group="chart", sql=_orders_sql(f"""
SELECT CAST(i - 1 AS INTEGER) AS i, round(t[i], 6) AS theoretical, round(q[i], 6) AS sample
FROM (SELECT quantile_cont(CAST(Revenue AS DOUBLE), {_QQ}) AS q,
             {[NormalDist().inv_cdf(p) for p in _QQ]} AS t FROM flat), range(1, 501) AS r(i)"""))
def q_qq(spark, sf):
    return CH.qq_points(flat(spark, sf), F.col("Revenue"), 500).select(
        "i", F.round("theoretical", 6).alias("theoretical"), F.round("sample", 6).alias("sample"))


def _hist(bins: int) -> tuple:
    return ("s AS (SELECT min(v) AS lo, max(v) AS hi, count(*) AS n FROM x)",
            f"""b AS (SELECT CAST(least(floor((v - lo) / ((hi - lo) / {bins})), {bins} - 1) AS INTEGER) AS bin,
       count(*) AS c FROM x, s GROUP BY 1)""",
            f"sp AS (SELECT CAST(i AS INTEGER) AS bin FROM range(0, {bins}) AS t(i))"), f"""
SELECT sp.bin, round(lo + sp.bin * (hi - lo) / {bins}, 4) AS bin_start,
       round(lo + (sp.bin + 1) * (hi - lo) / {bins}, 4) AS bin_end, coalesce(b.c, 0) AS count,
       round(coalesce(b.c, 0) / (n * ((hi - lo) / {bins})), 10) AS density
FROM sp CROSS JOIN s LEFT JOIN b ON sp.bin = b.bin"""


def _box(group: str) -> str:
    return f"""SELECT q.{group}, round(q1, 3) AS q1, round(median, 3) AS median, round(q3, 3) AS q3,
       round(min(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1)), 3) AS whisker_low,
       round(max(v) FILTER (WHERE v <= q3 + 1.5 * (q3 - q1)), 3) AS whisker_high,
       count(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS outliers, count(*) AS count
FROM j JOIN (SELECT {group}, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
                    quantile_cont(v, 0.75) AS q3 FROM j GROUP BY {group}) q ON j.{group} = q.{group}
GROUP BY q.{group}, q1, median, q3"""


_H80, _H80_BODY = _hist(80)


@register("histogram_sales", group="chart", sql=with_ctes(
    PANEL_CTE, "x AS (SELECT sales AS v FROM panel)", *_H80, body=_H80_BODY))
def q_hist_sales(spark, sf):
    return CH.histogram(train(spark, sf), F.col("sales"), 80)


@register("histogram_log_sales", group="chart", sql=with_ctes(
    PANEL_CTE, "x AS (SELECT ln(1 + sales) AS v FROM panel)", *_H80, body=_H80_BODY))
def q_hist_log_sales(spark, sf):
    return CH.histogram(train(spark, sf), C.log1p_target("sales"), 80)


@register("histogram_residual_lag28", group="chart", sql=ff_sql(_H80_BODY, extra_ctes=_SPLIT_CTES).replace(
    "\nSELECT sp.bin", ",\nx AS (SELECT greatest(least(sales - lag_28, 1000.0), -1000.0) AS v FROM ff, vb "
    "WHERE ff.date >= vb.vs),\n" + ",\n".join(_H80) + "\nSELECT sp.bin", 1))
def q_hist_residual(spark, sf):
    valid = S.recent_window_split(feature_frame(spark, sf)).valid
    return CH.histogram(valid, C.clip_range(C.residual("sales", "lag_28"), -1000.0, 1000.0), 80)


@register("box_stats_revenue", group="chart", sql=_orders_sql(
    _box("all_rows"), "j AS (SELECT 'all' AS all_rows, CAST(Revenue AS DOUBLE) AS v FROM flat WHERE Revenue IS NOT NULL)"))
def q_box_all(spark, sf):
    return CH.box_stats(flat(spark, sf).withColumn("all_rows", F.lit("all")), "Revenue", "all_rows")


@register("box_stats_holiday", group="chart", sql=with_ctes(PANEL_CTE, HOLIDAYS_CTE, """j AS (
  SELECT CASE WHEN date IN (SELECT date FROM holidays_events WHERE locale = 'National' AND NOT transferred)
         THEN 'Holiday' ELSE 'Normal Day' END AS day_kind, sum(sales) AS v FROM panel GROUP BY date)""",
                                                              body=_box("day_kind")))
def q_box_holiday(spark, sf):
    t = tables(spark, sf)
    daily = t["train"].groupBy("date").agg(F.sum("sales").alias("sales"))
    national = t["holidays_events"].where((F.col("locale") == "National") & ~F.col("transferred")).select("date")
    marked = J.holiday_flag(daily, "date", national, "is_holiday")
    return CH.box_stats(marked.withColumn("day_kind", F.when(F.col("is_holiday"), "Holiday").otherwise("Normal Day")),
                        "sales", "day_kind")


@register("box_stats_residual_lag28", group="chart", sql=ff_sql(_box("type"), extra_ctes=_SPLIT_CTES).replace(
    "\nSELECT q.type", ",\nj AS (SELECT type, sales - lag_28 AS v FROM ff, vb WHERE ff.date >= vb.vs)\nSELECT q.type", 1)
    .replace("SELECT q.type, round(q1, 3)", "SELECT q.type, round(q1, 3)", 1))
def q_box_residual(spark, sf):
    valid = S.recent_window_split(feature_frame(spark, sf)).valid
    return CH.box_stats(valid.withColumn("residual", C.residual("sales", "lag_28")), "residual", "type")


def _line_sql(x: str, y: str, frame: str) -> str:
    return f"""SELECT round(regr_slope({y}, {x}), 6) AS slope, round(regr_intercept({y}, {x}), 4) AS intercept,
       count(*) FILTER (WHERE {y} IS NOT NULL AND {x} IS NOT NULL) AS n FROM {frame}"""


@register("reg_line_promotion_sales", group="chart", sql=with_ctes(
    PANEL_CTE, body=_line_sql("onpromotion", "sales", "panel")))
def q_line_promotion(spark, sf):
    return CH.reg_line(train(spark, sf), "onpromotion", "sales")


@register("reg_line_oil_sales", group="chart", sql=with_ctes(PANEL_CTE, OIL_CTE, body=_line_sql(
    "dcoilwtico", "sales", "(SELECT date, sum(sales) AS sales FROM panel GROUP BY date) d LEFT JOIN oil USING (date)")))
def q_line_oil(spark, sf):
    t = tables(spark, sf)
    daily = t["train"].groupBy("date").agg(F.sum("sales").alias("sales"))
    return CH.reg_line(J.join_small(daily, t["oil"], "date"), "dcoilwtico", "sales")


@register("describe_panel", group="summary", sql=with_ctes(PANEL_CTE, body=" UNION ALL ".join(f"""
SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 2) AS mean, round(stddev_samp({c}), 2) AS std,
       round(CAST(min({c}) AS DOUBLE), 2) AS min, round(CAST(max({c}) AS DOUBLE), 2) AS max,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 2) AS p25, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 2) AS p50,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 2) AS p75 FROM panel""" for c in ("sales", "onpromotion"))))
def q_describe_panel(spark, sf):
    return A.describe_numeric(train(spark, sf), ("sales", "onpromotion"))


# ------------------------------------------------------------ written reports

def eda_sections(orders) -> dict:
    """The sections of the exploratory summary, each a small table."""
    numeric = ("Quantity", "Unit_Price", "Revenue", "Profit")
    return {
        "checks": Q.dataset_checks(orders, []), "missing": Q.missing_by_column(orders, "orders"),
        "target": A.target_summary(orders), "describe": A.describe_numeric(orders, numeric),
        "cardinality": A.cardinality(orders), "correlation": A.correlation_long(orders, numeric),
        "categories": A.value_counts(orders, "Category"), "regions": A.group_sales(orders, "Region"),
    }


@register("eda_summary_written", group="sinks", sql=_orders_sql("""
SELECT 'checks' AS section, 1 AS rows UNION ALL SELECT 'missing', 0 UNION ALL SELECT 'target', 1
UNION ALL SELECT 'describe', 4 UNION ALL SELECT 'cardinality', 14 UNION ALL SELECT 'correlation', 16
UNION ALL SELECT 'categories', count(DISTINCT Category) FROM flat
UNION ALL SELECT 'regions', least(count(DISTINCT Region), 10) FROM flat"""))
def q_eda_written(spark, sf):
    """The exploratory summary written as JSON sections, read back and counted."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/eda-{uuid.uuid4().hex}"
    sections = eda_sections(flat(spark, sf).select(*ORDER_COLS))
    write_sections(sections, path)
    return ML.union_all([spark.read.schema(df.schema).json(f"{path}/{name}").agg(
        F.lit(name).alias("section"), F.count(F.lit(1)).alias("rows")) for name, df in sections.items()])


@register("metrics_written", group="sinks", sql=_orders_sql(" UNION ALL ".join(
    f"SELECT 'Baseline_{n}' AS model, {_metric_sql('Revenue - c', 'Revenue')}, 28 AS feature_count "
    f"FROM test, (SELECT {f}(CAST(Revenue AS DOUBLE)) AS c FROM train)"
    for n, f in (("Mean", "avg"), ("Median", "median"))), _TRAIN_CTE, _TEST_CTE))
def q_metrics_written(spark, sf):
    """Metric rows with their feature list written as JSON lines and read back."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/metrics-{uuid.uuid4().hex}"
    rows = q_constants(spark, sf).withColumn("features", F.array(*[F.lit(c) for c in OM.feature_sets(True)[2]]))
    write_metrics(rows, path)
    return spark.read.schema("model string, MAE double, MSE double, RMSE double, R2 double, feature_count int").json(path)


# ------------------------------------------------------------ normal equations and one-hot cells

# Whole numbers, so that sums of products are exact in both engines.
_GRAM_NUMBERS = {"cents": "round(Unit_Price * 100)", "month": "month(Order_Date)", "units": "Quantity"}
_GRAM_CATEGORIES = ("Category", "Region", "State")


@register("gram_entries", group="features", sql=_orders_sql("""
SELECT x.f[i].n AS a, x.f[j].n AS b, sum(x.f[i].v * x.f[j].v) AS value
FROM x, range(1, len(f) + 1) AS p(i), range(1, len(f) + 1) AS q(j) WHERE i <= j GROUP BY 1, 2 HAVING value <> 0""",
    _TRAIN_CTE, "x AS (SELECT [" + ", ".join(
        [f"{{'n': '{c}=' || {c}, 'v': 1.0::DOUBLE}}" for c in _GRAM_CATEGORIES] + ["{'n': '1', 'v': 1.0::DOUBLE}"]
        + [f"{{'n': '{n}', 'v': CAST({e} AS DOUBLE)}}" for n, e in _GRAM_NUMBERS.items()]) + "] AS f FROM train)"))
def q_gram(spark, sf):
    rows = _train(spark, sf).withColumns({n: F.expr(e).cast("double") for n, e in _GRAM_NUMBERS.items()})
    return GR.sparse_gram(rows, ["cents", "month"], _GRAM_CATEGORIES, "units")


_ENCODED = ("Category", "Region", "State")
_SCALED = ("Unit_Price", "Quantity")


@register("one_hot_cells", group="features", sql=_orders_sql(" UNION ALL ".join(
    f"""SELECT {', '.join(KEY)}, '{c}' AS "column", CAST(code AS INTEGER) AS cell FROM test JOIN (
    SELECT {c} AS v, row_number() OVER (ORDER BY {c}) - 1 AS code FROM (
        SELECT DISTINCT {c} FROM train WHERE {c} IS NOT NULL)) ON {c} = v""" for c in _ENCODED), _TRAIN_CTE, _TEST_CTE))
def q_one_hot(spark, sf):
    """The one cell of each test row's one-hot blocks that is 1 (none for a
    value that train doesn't have), read from the encoded vectors."""
    prep = EN.FeaturePrep([], list(_ENCODED), "onehot", scale=False).fit(_train(spark, sf))
    rows = prep.transform(_test(spark, sf))
    cell = lambda c: F.array_position(vector_to_array(F.col(f"{c}__oh")), F.lit(1.0)) - 1
    return ML.union_all([rows.select(*KEY, F.lit(c).alias("column"), cell(c).cast("int").alias("cell"))
                         .where("cell >= 0") for c in _ENCODED])


def _block_sql(kind: str) -> str:
    """Nonzero cells of the assembled block: numeric columns first (scaled in
    the one-hot block), then a column a category (its code) or a value."""
    parts, at = [], 0
    for c in _SCALED:
        value = f"({c} - (SELECT avg({c}) FROM train)) / (SELECT stddev_pop({c}) FROM train)" if kind == "onehot" else c
        parts.append(f"SELECT {', '.join(KEY)}, {at} AS cell, round(CAST({value} AS DOUBLE), 6) AS value FROM test")
        at += 1
    before = str(at)
    for c in _ENCODED:
        codes = f"(SELECT {c} AS v, row_number() OVER (ORDER BY {c}) - 1 AS code FROM (SELECT DISTINCT {c} FROM train))"
        where, value = (f"{before} + code", "1.0::DOUBLE") if kind == "onehot" else (before, "code::DOUBLE")
        parts.append(f"SELECT {', '.join(KEY)}, {where}, {value} FROM test JOIN {codes} ON {c} = v")
        before += f" + (SELECT count(DISTINCT {c}) FROM train)" if kind == "onehot" else " + 1"
    body = " UNION ALL ".join(parts)
    return _orders_sql(f"SELECT {', '.join(KEY)}, CAST(cell AS INTEGER) AS cell, value FROM ({body}) WHERE value <> 0",
                       _TRAIN_CTE, _TEST_CTE)


def _block(kind: str):
    def build(spark, sf):
        prep = EN.FeaturePrep(list(_SCALED), list(_ENCODED), kind).fit(_train(spark, sf))
        rows = prep.transform(_test(spark, sf))
        cells = rows.select(*KEY, F.posexplode(vector_to_array("features")).alias("cell", "value"))
        return cells.withColumn("value", F.round("value", 6)).where("value <> 0")
    return build


register("one_hot_preprocessor_cells", group="features", sql=_block_sql("onehot"))(_block("onehot"))
register("ordinal_preprocessor_cells", group="features", sql=_block_sql("ordinal"))(_block("ordinal"))


# ------------------------------------------------------------ further chart and quality tables

@register("missing_by_column_orders", group="quality", sql=_orders_sql(" UNION ALL ".join(
    f"""SELECT 'orders' AS "table", '{c}' AS "column", count(*) - count({c}) AS missing,
       round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 4) AS missing_pct FROM late HAVING missing > 0"""
    for c in ORDER_COLS), """late AS (SELECT * REPLACE (
    CASE WHEN l_linenumber > 5 THEN NULL ELSE Profit END AS Profit,
    CASE WHEN Quantity > 48 THEN NULL ELSE Sub_Category END AS Sub_Category) FROM flat)"""))
def q_missing_orders(spark, sf):
    """The order table with two columns in which some cells are blank (the
    driver's rows have none)."""
    orders = flat(spark, sf).withColumns({
        "Profit": F.when(F.col("l_linenumber") <= 5, F.col("Profit")),
        "Sub_Category": F.when(F.col("Quantity") <= 48, F.col("Sub_Category"))})
    return Q.missing_by_column(orders.select(*ORDER_COLS), "orders")


@register("hexbin_actual_predicted", group="chart", sql=_diag_sql("""
SELECT round(x0 + cx * sx, 4) AS x, round(y0 + cy * sy, 4) AS y, count(*) AS count FROM (
  SELECT x0, y0, sx, sy, CASE WHEN d1 < d2 THEN floor(ix + 0.5) ELSE floor(ix) + 0.5 END AS cx,
         CASE WHEN d1 < d2 THEN floor(iy + 0.5) ELSE floor(iy) + 0.5 END AS cy
  FROM (SELECT *, power(ix - floor(ix + 0.5), 2) + 3 * power(iy - floor(iy + 0.5), 2) AS d1,
               power(ix - (floor(ix) + 0.5), 2) + 3 * power(iy - (floor(iy) + 0.5), 2) AS d2
        FROM (SELECT *, (actual - x0) / sx AS ix, (predicted - y0) / sy AS iy FROM pred CROSS JOIN (
                SELECT min(actual) AS x0, min(predicted) AS y0, (max(actual) - min(actual)) / 40 AS sx,
                       (max(predicted) - min(predicted)) / 23 AS sy FROM pred) b)))
GROUP BY x0, y0, sx, sy, cx, cy"""))
def q_hexagons(spark, sf):
    pred = OM.naive_predictions(flat(spark, sf), KEY, prepared(spark, sf))
    return CH.hexbin(pred, "actual", "predicted", 40).select(
        F.round("x", 4).alias("x"), F.round("y", 4).alias("y"), "count")


@register("kde_residual_lag28", group="chart", sql=ff_sql("""
SELECT CAST(i AS INTEGER) AS i, round(a + i * ((b - a) / 299), 6) AS x,
       round(sum(w * exp(-0.5 * power((a + i * ((b - a) / 299) - v) / h, 2))) / (n * h * sqrt(2 * pi())), 10) AS density
FROM w, s, range(0, 300) AS t(i) GROUP BY i, a, b, n, h""", extra_ctes=_SPLIT_CTES).replace(
    "\nSELECT CAST(i", ",\nr AS (SELECT greatest(least(sales - lag_28, 1000.0), -1000.0)::DOUBLE AS v FROM ff, vb "
    "WHERE ff.date >= vb.vs),\nw AS (SELECT v, count(*) AS w FROM r GROUP BY v),\n"
    "s AS (SELECT quantile_cont(v, 0.005) AS a, quantile_cont(v, 0.995) AS b, count(v) AS n, "
    "stddev_samp(v) * power(count(v), -0.2) AS h FROM r)\nSELECT CAST(i", 1))
def q_kde_residual(spark, sf):
    valid = S.recent_window_split(feature_frame(spark, sf)).valid
    return CH.kde(valid, C.clip_range(C.residual("sales", "lag_28"), -1000.0, 1000.0), 300).select(
        "i", F.round("x", 6).alias("x"), F.round("density", 10).alias("density"))
