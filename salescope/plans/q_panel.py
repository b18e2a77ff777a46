"""Registered queries over the store panel (store-sales problem): panel
quality, daily / monthly / category summaries, pivots, joins with the side
tables, the lag / rolling feature frame, split windows and baselines."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.functions import columns as C
from salescope.functions import dates as D
from salescope.operators import aggregates as A
from salescope.operators import joins as J
from salescope.operators import metrics as M
from salescope.operators import quality as Q
from salescope.operators import windows as WN
from salescope.plans import store_sales as S
from salescope.plans.catalog import (HOLIDAYS_CTE, OIL_CTE, PANEL_CTE, STORES_CTE,
                                     TRANSACTIONS_CTE, register, with_ctes)
from salescope.session import MONTH, materialize
from salescope.sources.panel import TablesOnDemand, panel_tables

_CACHE: dict = {}


def tables(spark: SparkSession, sf: str) -> Mapping[str, DataFrame]:
    """The six panel tables, each derived once per session and input folder
    when a query first asks for it; the panel itself (train / test) is kept as
    parquet in the shared checkpoint folder, and so are the side tables (one
    row per day / store)."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _CACHE:
        t = panel_tables(spark, sf)

        def kept(name: str) -> Callable[[], DataFrame]:
            return lambda: materialize(t[name], f"panel_{name}")

        out = TablesOnDemand({
            "observed": lambda: t["observed"],
            # by month, so that a window of days reads only its folders
            "train_by_month": lambda: materialize(t["train"], "panel_train", by_month_of="date"),
            "train": lambda: out["train_by_month"].drop(MONTH),
            # kept, so that the planner knows the bytes of the day- and
            # store-sized tables and no later plan derives them again
            **{name: kept(name) for name in ("test", "stores", "oil", "holidays_events", "transactions")},
        })
        _CACHE[key] = out
    return _CACHE[key]


def train(spark, sf) -> DataFrame:
    return tables(spark, sf)["train"]


def _sql(*ctes: str, body: str) -> str:
    return with_ctes(PANEL_CTE, *ctes, body=body)


IDS_CTE = """ids AS (
  SELECT p.*, CAST((date_diff('day', (SELECT lo FROM bounds), p.date)) * (SELECT count(*) FROM series)
                   + sr.s AS BIGINT) AS id
  FROM panel p JOIN (SELECT store_nbr, family, row_number() OVER (ORDER BY store_nbr, family) - 1 AS s
                     FROM series) sr USING (store_nbr, family))"""


# ---------------------------------------------------------------- panel quality

@register("panel_table_summary", group="quality", sql=_sql(body="""
SELECT 'train' AS "table", count(*) AS rows, min(date) AS date_min, max(date) AS date_max,
       count(DISTINCT store_nbr) AS stores, count(DISTINCT family) AS families FROM panel
UNION ALL
SELECT 'observed', count(*), min(date), max(date), count(DISTINCT store_nbr), count(DISTINCT family)
FROM obs"""))
def q_panel_summary(spark, sf):
    t = tables(spark, sf)
    return Q.table_summary(t["train"], "train").unionByName(Q.table_summary(t["observed"], "observed"))


@register("panel_zero_share", group="quality", sql=_sql(body="""
SELECT round(avg(CASE WHEN sales = 0 THEN 1.0 ELSE 0.0 END) * 100, 4) AS zero_share_pct FROM panel"""))
def q_zero_share(spark, sf):
    return Q.zero_share(train(spark, sf), "sales")


@register("panel_duplicate_rows", group="quality", sql=_sql(body="""
SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicate_rows FROM (
  SELECT count(*) AS c FROM panel GROUP BY date, store_nbr, family, sales, onpromotion)"""))
def q_panel_dups(spark, sf):
    return Q.duplicate_rows(train(spark, sf).drop("id"))


@register("missing_by_column_oil_on_sales_dates", group="quality", sql=_sql(OIL_CTE, body="""
SELECT 'sales_oil' AS "table", column_name AS "column", missing, missing_pct FROM (
  SELECT 'date' AS column_name, count(*) FILTER (WHERE d.date IS NULL) AS missing,
         round(count(*) FILTER (WHERE d.date IS NULL) * 100.0 / count(*), 4) AS missing_pct
  FROM (SELECT DISTINCT date FROM panel) d LEFT JOIN oil o ON d.date = o.date
  UNION ALL
  SELECT 'dcoilwtico', count(*) FILTER (WHERE o.dcoilwtico IS NULL),
         round(count(*) FILTER (WHERE o.dcoilwtico IS NULL) * 100.0 / count(*), 4)
  FROM (SELECT DISTINCT date FROM panel) d LEFT JOIN oil o ON d.date = o.date)
WHERE missing > 0"""))
def q_missing_oil(spark, sf):
    t = tables(spark, sf)
    joined = t["train"].select("date").distinct().join(t["oil"], "date", "left")
    return Q.missing_by_column(joined, "sales_oil")


# ---------------------------------------------------------------- summaries

@register("daily_sales", group="summary", sql=_sql(body="""
SELECT date, round(sum(sales), 2) AS sales FROM panel GROUP BY date"""))
def q_daily_sales(spark, sf):
    return train(spark, sf).groupBy("date").agg(F.round(F.sum("sales"), 2).alias("sales"))


@register("daily_store_sales", group="summary", sql=_sql(body="""
SELECT date, store_nbr, round(sum(sales), 2) AS sales FROM panel GROUP BY date, store_nbr"""))
def q_daily_store_sales(spark, sf):
    return train(spark, sf).groupBy("date", "store_nbr").agg(F.round(F.sum("sales"), 2).alias("sales"))


@register("family_total_top15", group="summary", sql=_sql(body="""
SELECT family, round(sum(sales), 2) AS sales FROM panel GROUP BY family
ORDER BY sales DESC, family LIMIT 15"""))
def q_family_top(spark, sf):
    return A.top_sum(train(spark, sf), "family", "sales", 15, "sales")


# SQL needs its columns named: the years of the driver data.  The plans take the
# years from the rows, so another year is a column more than the SQL has.
YEARS = [str(y) for y in range(1995, 2002)]
_YEAR_COLUMNS = ", ".join(f'round(sum(sales) FILTER (WHERE year(date) = {y}), 2) AS "{y}"' for y in YEARS)


@register("family_year_pivot", group="summary", sql=with_ctes(
    PANEL_CTE,
    """top AS (SELECT family FROM panel GROUP BY family ORDER BY sum(sales) DESC, family LIMIT 15)""",
    body="""
SELECT family, """ + _YEAR_COLUMNS + """ FROM panel
WHERE family IN (SELECT family FROM top) GROUP BY family"""))
def q_family_year_pivot(spark, sf):
    t = train(spark, sf)
    top = A.top_sum(t, "family", "sales", 15, "sales")
    rows = J.restrict_to_top(t, top, "family").withColumn("yr", F.year("date").cast("string"))
    return A.pivot_sum(rows, "family", "yr", "sales")


@register("month_year_pivot", group="summary", sql=with_ctes(PANEL_CTE, body="""
SELECT CAST(month(date) AS INTEGER) AS month, """ + _YEAR_COLUMNS + """ FROM panel GROUP BY 1"""))
def q_month_year_pivot(spark, sf):
    t = train(spark, sf).select(F.month("date").alias("month"),
                                F.year("date").cast("string").alias("yr"), "sales")
    return A.pivot_sum(t, "month", "yr", "sales")


_PROMO_SQL = """CASE WHEN onpromotion IS NULL THEN NULL WHEN onpromotion <= 0 THEN '0'
     WHEN onpromotion <= 5 THEN '1-5' WHEN onpromotion <= 20 THEN '6-20' ELSE '20+' END"""


@register("promo_summary", group="summary", sql=_sql(body=f"""
SELECT {_PROMO_SQL} AS promo_bucket, count(*) AS count, round(avg(sales), 4) AS mean_sales,
       round(median(sales), 4) AS median_sales FROM panel GROUP BY 1"""))
def q_promo_summary(spark, sf):
    return A.promo_summary(train(spark, sf), C.promo_bucket("onpromotion"), "sales")


@register("promo_monthly_mean", group="summary", sql=with_ctes(
    PANEL_CTE,
    """m AS (SELECT last_day(date) AS month_end, round(avg(onpromotion), 4) AS mean_onpromotion
        FROM panel GROUP BY 1)""",
    """mb AS (SELECT date_trunc('month', min(date)) AS lo, date_trunc('month', max(date)) AS hi FROM panel)""",
    """ms AS (SELECT last_day(CAST(d AS DATE)) AS month_end FROM mb,
        unnest(generate_series(mb.lo, mb.hi, INTERVAL 1 MONTH)) AS t(d))""",
    body="SELECT ms.month_end, m.mean_onpromotion FROM ms LEFT JOIN m USING (month_end)"))
def q_promo_monthly(spark, sf):
    return A.binned_over_spine(train(spark, sf), "date",
                               {"mean_onpromotion": F.round(F.avg("onpromotion"), 4)},
                               "month", "month_end")


@register("store_type_total", group="summary", sql=_sql(STORES_CTE, body="""
SELECT type, round(sum(sales), 2) AS sales FROM panel LEFT JOIN stores USING (store_nbr)
WHERE type IS NOT NULL GROUP BY type ORDER BY sales DESC"""))
def q_store_type(spark, sf):
    t = tables(spark, sf)
    j = J.join_small(t["train"], t["stores"], "store_nbr")
    return A.top_sum(j, "type", "sales", None, "sales")


@register("cluster_mean", group="summary", sql=_sql(STORES_CTE, body="""
SELECT cluster, round(avg(sales), 4) AS mean_sales FROM panel LEFT JOIN stores USING (store_nbr)
WHERE cluster IS NOT NULL GROUP BY cluster ORDER BY mean_sales DESC"""))
def q_cluster_mean(spark, sf):
    t = tables(spark, sf)
    j = J.join_small(t["train"], t["stores"], "store_nbr")
    return (j.where(F.col("cluster").isNotNull()).groupBy("cluster")
             .agg(F.round(F.avg("sales"), 4).alias("mean_sales")).orderBy(F.col("mean_sales").desc()))


@register("sales_oil_monthly", group="summary", sql=with_ctes(
    PANEL_CTE, OIL_CTE,
    """d AS (SELECT date, sum(sales) AS sales FROM panel GROUP BY date)""",
    """j AS (SELECT d.date, d.sales, o.dcoilwtico FROM d LEFT JOIN oil o USING (date))""",
    """m AS (SELECT last_day(date) AS month_end, round(sum(sales), 2) AS sales,
        round(avg(dcoilwtico), 4) AS mean_oil FROM j GROUP BY 1)""",
    """mb AS (SELECT date_trunc('month', min(date)) AS lo, date_trunc('month', max(date)) AS hi FROM j)""",
    """ms AS (SELECT last_day(CAST(x AS DATE)) AS month_end FROM mb,
        unnest(generate_series(mb.lo, mb.hi, INTERVAL 1 MONTH)) AS t(x))""",
    body="""SELECT ms.month_end, coalesce(m.sales, 0) AS sales, m.mean_oil
FROM ms LEFT JOIN m USING (month_end)"""))
def q_sales_oil_monthly(spark, sf):
    t = tables(spark, sf)
    daily = t["train"].groupBy("date").agg(F.sum("sales").alias("sales"))
    j = J.join_small(daily, t["oil"], "date")
    return A.binned_over_spine(j, "date", {"sales": F.round(F.sum("sales"), 2),
                                           "mean_oil": F.round(F.avg("dcoilwtico"), 4)},
                               "month", "month_end", zero_fill=["sales"])


@register("sales_oil_corr", group="summary", sql=with_ctes(
    PANEL_CTE, OIL_CTE, body="""
SELECT round(corr(d.sales, o.dcoilwtico), 6) AS corr, count(*) AS n
FROM (SELECT date, sum(sales) AS sales FROM panel GROUP BY date) d JOIN oil o USING (date)"""))
def q_sales_oil_corr(spark, sf):
    t = tables(spark, sf)
    daily = t["train"].groupBy("date").agg(F.sum("sales").alias("sales"))
    j = daily.join(J.sized_broadcast(t["oil"]), "date", "inner")
    return j.agg(F.round(F.corr("sales", "dcoilwtico"), 6).alias("corr"),
                 F.count(F.lit(1)).alias("n"))


@register("holiday_daily", group="summary", sql=with_ctes(HOLIDAYS_CTE, body="""
SELECT date, max(CASE WHEN type <> 'Work Day' THEN 1 ELSE 0 END) AS is_holiday,
       count(*) AS holiday_count FROM holidays_events WHERE NOT transferred GROUP BY date"""))
def q_holiday_daily(spark, sf):
    return A.holiday_daily(tables(spark, sf)["holidays_events"])


@register("value_counts_holiday_type", group="summary", sql=with_ctes(HOLIDAYS_CTE, body="""
SELECT type, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS share
FROM holidays_events WHERE type IS NOT NULL GROUP BY type"""))
def q_vc_holiday(spark, sf):
    return A.value_counts(tables(spark, sf)["holidays_events"], "type")


@register("transactions_sales_join", group="join", sql=_sql(TRANSACTIONS_CTE, body="""
SELECT d.date, d.store_nbr, round(d.sales, 2) AS sales, t.transactions
FROM (SELECT date, store_nbr, sum(sales) AS sales FROM panel GROUP BY date, store_nbr) d
JOIN transactions t ON d.date = t.date AND d.store_nbr = t.store_nbr"""))
def q_transactions_join(spark, sf):
    t = tables(spark, sf)
    d = t["train"].groupBy("date", "store_nbr").agg(F.sum("sales").alias("sales"))
    j = d.join(t["transactions"], ["date", "store_nbr"], "inner")
    return j.select("date", "store_nbr", F.round("sales", 2).alias("sales"), "transactions")


@register("transactions_sales_corr", group="summary", sql=_sql(TRANSACTIONS_CTE, body="""
SELECT round(corr(d.sales, t.transactions), 6) AS corr,
       round(regr_slope(d.sales, t.transactions), 6) AS slope,
       round(regr_intercept(d.sales, t.transactions), 4) AS intercept
FROM (SELECT date, store_nbr, sum(sales) AS sales FROM panel GROUP BY date, store_nbr) d
JOIN transactions t ON d.date = t.date AND d.store_nbr = t.store_nbr"""))
def q_transactions_corr(spark, sf):
    t = tables(spark, sf)
    d = t["train"].groupBy("date", "store_nbr").agg(F.sum("sales").alias("sales"))
    j = d.join(t["transactions"], ["date", "store_nbr"], "inner")
    return j.agg(F.round(F.corr("sales", "transactions"), 6).alias("corr"),
                 F.round(F.regr_slope("sales", "transactions"), 6).alias("slope"),
                 F.round(F.regr_intercept("sales", "transactions"), 4).alias("intercept"))


@register("top_sales_days", group="topk", sql=_sql(HOLIDAYS_CTE, body="""
SELECT d.date, round(d.sales, 2) AS sales, dayname(d.date) AS day_name,
       d.date IN (SELECT date FROM holidays_events WHERE locale = 'National' AND NOT transferred)
         AS is_national_holiday
FROM (SELECT date, sum(sales) AS sales FROM panel GROUP BY date) d
ORDER BY d.sales DESC, d.date LIMIT 5"""))
def q_top_days(spark, sf):
    t = tables(spark, sf)
    daily = t["train"].groupBy("date").agg(F.sum("sales").alias("sales"))
    top = daily.orderBy(F.col("sales").desc(), "date").limit(5)
    nat = t["holidays_events"].where((F.col("locale") == "National") & ~F.col("transferred")).select("date")
    out = J.holiday_flag(top, "date", nat, "is_national_holiday")
    return out.select("date", F.round("sales", 2).alias("sales"), D.day_name("date").alias("day_name"),
                      "is_national_holiday")


@register("weekday_mean_sales", group="summary", sql=_sql(body="""
SELECT w.dayofweek, w.weekday, m.mean_sales FROM
  (SELECT CAST(i AS INTEGER) AS dayofweek,
          ['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'][i + 1] AS weekday
   FROM range(0, 7) t(i)) w
LEFT JOIN (SELECT CAST(isodow(date) - 1 AS INTEGER) AS dayofweek, round(avg(sales), 4) AS mean_sales
           FROM panel GROUP BY 1) m USING (dayofweek)
ORDER BY w.dayofweek"""))
def q_weekday_mean(spark, sf):
    return A.weekday_mean(train(spark, sf), "date", "sales")


@register("rolling_daily_sales", group="window", sql=_sql(body="""
SELECT date, round(sales, 2) AS sales,
       round(avg(sales) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4) AS rolling_7,
       round(avg(sales) OVER (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 4) AS rolling_30
FROM (SELECT date, sum(sales) AS sales FROM panel GROUP BY date)"""))
def q_rolling_sales(spark, sf):
    daily = train(spark, sf).groupBy("date").agg(F.sum("sales").alias("sales"))
    out = WN.rolling_daily(daily, "date", "sales", (7, 30))
    return out.select("date", F.round("sales", 2).alias("sales"), F.round("rolling_7", 4).alias("rolling_7"),
                      F.round("rolling_30", 4).alias("rolling_30"))


# ---------------------------------------------------------------- feature frame

OIL_FILLED_CTES = (
    OIL_CTE,
    """oil_clean AS (SELECT date, coalesce(
        last_value(dcoilwtico IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        first_value(dcoilwtico IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
        AS dcoilwtico FROM oil)""",
    """oil_sd AS (SELECT sd.date, coalesce(
        last_value(o.dcoilwtico IGNORE NULLS) OVER (ORDER BY sd.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        first_value(o.dcoilwtico IGNORE NULLS) OVER (ORDER BY sd.date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
        AS dcoilwtico FROM (SELECT DISTINCT date FROM base) sd LEFT JOIN oil_clean o ON sd.date = o.date)""",
)

FF_BODY = """ff AS (
  SELECT b.date, b.store_nbr, b.family, b.sales, b.onpromotion,
         s.city, s.state, s.type, s.cluster, od.dcoilwtico,
         coalesce(hd.is_holiday, 0) AS is_holiday, coalesce(hd.holiday_count, 0) AS holiday_count,
         CAST(isodow(b.date) - 1 AS INTEGER) AS dayofweek, CAST(month(b.date) AS INTEGER) AS month,
         CAST(year(b.date) AS INTEGER) AS year, CAST(day(b.date) AS INTEGER) AS dayofmonth,
         CAST(CASE WHEN isodow(b.date) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
         coalesce(lag(b.sales, 16) OVER w, 0) AS lag_16,
         coalesce(lag(b.sales, 28) OVER w, 0) AS lag_28,
         coalesce(lag(b.sales, 364) OVER w, 0) AS lag_364,
         coalesce(avg(b.sales) OVER (w ROWS BETWEEN 22 PRECEDING AND 16 PRECEDING), 0) AS rolling_mean_7_shift16,
         coalesce(avg(b.sales) OVER (w ROWS BETWEEN 43 PRECEDING AND 16 PRECEDING), 0) AS rolling_mean_28_shift16,
         coalesce(avg(b.sales) OVER (w ROWS BETWEEN 71 PRECEDING AND 16 PRECEDING), 0) AS rolling_mean_56_shift16
         {extra}
  FROM base b LEFT JOIN stores s ON b.store_nbr = s.store_nbr
       LEFT JOIN oil_sd od ON b.date = od.date
       LEFT JOIN (SELECT date, max(CASE WHEN type <> 'Work Day' THEN 1 ELSE 0 END) AS is_holiday,
                         count(*) AS holiday_count FROM holidays_events WHERE NOT transferred
                  GROUP BY date) hd ON b.date = hd.date
  WINDOW w AS (PARTITION BY b.store_nbr, b.family ORDER BY b.date))"""


def ff_sql(body: str, base: str = "base AS (SELECT * FROM panel)", extra: str = "",
           extra_ctes: tuple = ()) -> str:
    return with_ctes(PANEL_CTE, *extra_ctes, base, STORES_CTE, HOLIDAYS_CTE, *OIL_FILLED_CTES,
                     FF_BODY.replace("{extra}", extra), body=body)


FF_COLS = ("date, store_nbr, family, sales, onpromotion, city, state, type, cluster, "
           "round(dcoilwtico, 6) AS dcoilwtico, is_holiday, holiday_count, dayofweek, month, year, "
           "dayofmonth, is_weekend, lag_16, lag_28, lag_364, "
           "round(rolling_mean_7_shift16, 6) AS rolling_mean_7_shift16, "
           "round(rolling_mean_28_shift16, 6) AS rolling_mean_28_shift16, "
           "round(rolling_mean_56_shift16, 6) AS rolling_mean_56_shift16")


def feature_frame(spark, sf) -> DataFrame:
    key = (id(spark), sf, "ff")
    if key not in _CACHE:
        t = tables(spark, sf)
        ff = S.build_feature_frame(t["train"].drop("id"), t["stores"], t["oil"], t["holidays_events"])
        _CACHE[key] = materialize(ff, "feature_frame", by_month_of="date")
    return _CACHE[key]


def _ff_out(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(*extra, "date", "store_nbr", "family", "sales", "onpromotion", "city", "state", "type",
                     "cluster", F.round("dcoilwtico", 6).alias("dcoilwtico"), "is_holiday",
                     "holiday_count", "dayofweek", "month", "year", "dayofmonth", "is_weekend",
                     "lag_16", "lag_28", "lag_364",
                     # a mean of at most 56 integer sales terminates within 5
                     # decimals, so 6 decimals never meet a rounding tie
                     *[F.round(c, 6).alias(c) for c in ("rolling_mean_7_shift16",
                                                         "rolling_mean_28_shift16",
                                                         "rolling_mean_56_shift16")])


@register("feature_frame", group="window", sql=ff_sql(f"SELECT {FF_COLS} FROM ff"))
def q_feature_frame(spark, sf):
    # the plan itself (not the kept copy), so this query measures the build
    t = tables(spark, sf)
    return _ff_out(S.build_feature_frame(t["train"].drop("id"), t["stores"], t["oil"],
                                         t["holidays_events"]))


@register("oil_filled_on_sales_dates", group="window", sql=with_ctes(
    PANEL_CTE, "base AS (SELECT * FROM panel)", *OIL_FILLED_CTES,
    body="SELECT date, round(dcoilwtico, 6) AS dcoilwtico FROM oil_sd"))
def q_oil_filled(spark, sf):
    t = tables(spark, sf)
    out = S.oil_on_dates(t["train"], t["oil"])
    return out.select("date", F.round("dcoilwtico", 6).alias("dcoilwtico"))


_SPLIT_CTES = ("""vb AS (SELECT max(date) - INTERVAL 15 DAY AS vs,
        max(date) - INTERVAL 15 DAY - INTERVAL 365 DAY AS fs, max(date) AS mx FROM panel)""",)


@register("recent_window_split", group="projection", sql=with_ctes(PANEL_CTE, *_SPLIT_CTES, body="""
SELECT 'fit' AS split, count(*) AS rows, min(date) AS date_min, max(date) AS date_max
FROM panel, vb WHERE date < vs AND date >= fs
UNION ALL
SELECT 'valid', count(*), min(date), max(date) FROM panel, vb WHERE date >= vs"""))
def q_recent_split(spark, sf):
    sp = S.recent_window_split(train(spark, sf))
    def summ(df, name):
        return df.agg(F.lit(name).alias("split"), F.count(F.lit(1)).alias("rows"),
                      F.min("date").alias("date_min"), F.max("date").alias("date_max"))
    return summ(sp.fit, "fit").unionByName(summ(sp.valid, "valid"))


@register("final_fit_window", group="projection", sql=_sql(body="""
SELECT count(*) AS rows, min(date) AS date_min, max(date) AS date_max, count(DISTINCT date) AS days
FROM panel WHERE date >= (SELECT max(date) FROM panel) - INTERVAL 365 DAY"""))
def q_final_window(spark, sf):
    t = train(spark, sf)
    end = t.agg(F.max("date")).first()[0]
    w = S.final_fit_window(t, end)
    return w.agg(F.count(F.lit(1)).alias("rows"), F.min("date").alias("date_min"),
                 F.max("date").alias("date_max"), F.count_distinct("date").alias("days"))


def _baseline_sql() -> str:
    parts = []
    for name, col in S.BASELINES.items():
        p = f"greatest({col}, 0)"
        parts.append(f"""SELECT '{name}' AS model,
  round(sqrt(avg(power(ln(1 + sales) - ln(1 + {p}), 2))), 4) AS RMSLE,
  round(avg(abs(sales - {p})), 4) AS MAE, round(sqrt(avg(power(sales - {p}, 2))), 4) AS RMSE,
  round(CASE WHEN var_pop(sales) > 0 THEN 1 - sum(power(sales - {p}, 2)) / (var_pop(sales) * count(*))
        WHEN sum(power(sales - {p}, 2)) = 0 THEN 1.0 ELSE 0.0 END, 4) AS R2
FROM ff, vb WHERE ff.date >= vb.vs""")
    return ff_sql(" UNION ALL ".join(parts), extra_ctes=_SPLIT_CTES)


@register("lag_baselines", group="metrics", sql=_baseline_sql())
def q_lag_baselines(spark, sf):
    sp = S.recent_window_split(feature_frame(spark, sf))
    rows = [M.metrics_row(sp.valid, "sales", col, {"model": name}, "sales")
            for name, col in S.BASELINES.items()]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.orderBy("RMSLE")


_CORR_COLS = ["sales", "onpromotion", "dcoilwtico", "dayofweek", "month", "year", "dayofmonth",
              "is_weekend", "lag_16", "lag_28", "lag_364", "rolling_mean_7_shift16",
              "rolling_mean_28_shift16", "rolling_mean_56_shift16"]


@register("correlation_matrix_panel", group="summary", sql=ff_sql(" UNION ALL ".join(
    f"SELECT '{a}' AS \"row\", '{b}' AS col, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 4) + 0.0 AS corr FROM ff"
    for a in _CORR_COLS for b in _CORR_COLS)))
def q_corr_panel(spark, sf):
    return A.correlation_long(feature_frame(spark, sf), _CORR_COLS)


@register("residual_by_day_lag28", group="metrics", sql=ff_sql("""
SELECT ff.date, round(avg(sales - lag_28), 4) AS mean_residual, count(*) AS count
FROM ff, vb WHERE ff.date >= vb.vs GROUP BY ff.date""", extra_ctes=_SPLIT_CTES))
def q_resid_day(spark, sf):
    sp = S.recent_window_split(feature_frame(spark, sf))
    return sp.valid.groupBy("date").agg(F.round(F.avg(F.col("sales") - F.col("lag_28")), 4)
                                        .alias("mean_residual"), F.count(F.lit(1)).alias("count"))


@register("family_error_top15_lag28", group="metrics", sql=ff_sql("""
SELECT family, round(avg(abs(sales - lag_28)), 4) AS mae, round(sum(sales), 2) AS total_sales
FROM ff, vb WHERE ff.date >= vb.vs GROUP BY family ORDER BY mae DESC, family LIMIT 15""",
                                                                 extra_ctes=_SPLIT_CTES))
def q_family_error(spark, sf):
    sp = S.recent_window_split(feature_frame(spark, sf))
    return A.error_by_group_top(sp.valid, "family", "sales", "lag_28", 15)


@register("interaction_features", group="projection", sql=ff_sql("""
SELECT ff.date, store_nbr, family, onpromotion * lag_28 AS promo_x_lag28,
       is_weekend * lag_28 AS weekend_x_lag28,
       """ + _PROMO_SQL + """ AS promo_bucket,
       round(ln(1 + sales), 6) AS log_sales
FROM ff, vb WHERE ff.date >= vb.vs""", extra_ctes=_SPLIT_CTES))
def q_interactions(spark, sf):
    sp = S.recent_window_split(feature_frame(spark, sf))
    return sp.valid.select("date", "store_nbr", "family",
                           C.interaction("onpromotion", "lag_28").alias("promo_x_lag28"),
                           C.interaction("is_weekend", "lag_28").alias("weekend_x_lag28"),
                           C.promo_bucket("onpromotion").alias("promo_bucket"),
                           F.round(C.log1p_target("sales"), 6).alias("log_sales"))


# ------------------------------------------------------------ train + test union

_TEST_CTES = (IDS_CTE, """test_rows AS (
  SELECT CAST(d AS DATE) AS date, s.store_nbr, s.family, CAST(NULL AS DOUBLE) AS sales,
         CAST(0 AS INTEGER) AS onpromotion,
         CAST((date_diff('day', (SELECT lo FROM bounds), CAST(d AS DATE))) * (SELECT count(*) FROM series)
              + s.s AS BIGINT) AS id
  FROM (SELECT store_nbr, family, row_number() OVER (ORDER BY store_nbr, family) - 1 AS s FROM series) s,
       bounds b, unnest(generate_series(b.hi + INTERVAL 1 DAY, b.hi + INTERVAL 16 DAY, INTERVAL 1 DAY)) AS t(d))""")


@register("test_feature_rows", group="window", sql=ff_sql(
    f"SELECT id, {FF_COLS.replace('sales, onpromotion,', 'onpromotion,', 1)} FROM ff "
    "WHERE id IN (SELECT id FROM test_rows)",
    base="base AS (SELECT date, store_nbr, family, sales, onpromotion, id FROM ids "
         "UNION ALL SELECT date, store_nbr, family, sales, onpromotion, id FROM test_rows)",
    extra=", b.id", extra_ctes=_TEST_CTES))
def q_test_features(spark, sf):
    t = tables(spark, sf)
    both = S.union_train_test(t["train"], t["test"])
    ff = S.build_feature_frame(both, t["stores"], t["oil"], t["holidays_events"])
    test_rows = J.split_by_id(ff, t["test"], "id")
    return _ff_out(test_rows, "id").drop("sales")


@register("split_by_id_counts", group="join", sql=with_ctes(PANEL_CTE, *_TEST_CTES, body="""
SELECT (SELECT count(*) FROM ids) AS train_rows, (SELECT count(*) FROM test_rows) AS test_rows,
       (SELECT min(id) FROM test_rows) AS first_test_id, (SELECT max(id) FROM ids) AS last_train_id"""))
def q_split_ids(spark, sf):
    t = tables(spark, sf)
    both = S.union_train_test(t["train"], t["test"])
    tr = J.split_by_id(both, t["train"], "id")
    te = J.split_by_id(both, t["test"], "id")
    a = tr.agg(F.count(F.lit(1)).alias("train_rows"), F.max("id").alias("last_train_id"))
    b = te.agg(F.count(F.lit(1)).alias("test_rows"), F.min("id").alias("first_test_id"))
    return a.withColumn("__k", F.lit(1)).join(b.withColumn("__k", F.lit(1)), "__k").drop("__k") \
            .select("train_rows", "test_rows", "first_test_id", "last_train_id")


@register("box_stats_store_type", group="chart", sql=with_ctes(
    PANEL_CTE, STORES_CTE,
    """j AS (SELECT s.type, p.sales AS v FROM panel p JOIN stores s USING (store_nbr))""",
    """q AS (SELECT type, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
                   quantile_cont(v, 0.75) AS q3 FROM j GROUP BY type)""",
    body="""
SELECT q.type, round(q1, 3) AS q1, round(median, 3) AS median, round(q3, 3) AS q3,
       round(min(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1)), 3) AS whisker_low,
       round(max(v) FILTER (WHERE v <= q3 + 1.5 * (q3 - q1)), 3) AS whisker_high,
       count(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS outliers,
       count(*) AS count
FROM j JOIN q ON j.type = q.type GROUP BY q.type, q1, median, q3"""))
def q_box_store_type(spark, sf):
    from salescope.operators import chartdata as CH
    t = tables(spark, sf)
    j = J.join_small(t["train"], t["stores"], "store_nbr", how="inner")
    return CH.box_stats(j, "sales", "type")
