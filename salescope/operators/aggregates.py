"""Grouped summaries, calendar bins, pivots, moments and correlations.

Conventions
* groups with a NULL key are dropped (pandas ``groupby`` default);
* calendar bins that pandas ``resample`` would emit empty are generated from
  a spine (``explode(sequence(min, max))`` on a one-row aggregate, no
  collect, no cross join) and get sum 0 / mean NULL;
* medians and quantiles go through :func:`exact_percentiles` (bounded
  per-task memory, exact result);
* every aggregate here is decomposable or sketch based, so Spark combines
  map-side before the shuffle; a hot key costs one partial row per task.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salescope.functions.dates import day_name, quarter_period
from salescope.operators.joins import sized_broadcast
from salescope.operators.quantiles import exact_percentiles


# workers need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- group tables

def group_sales(df: DataFrame, group_col: str, n: int | None = 10, id_col: str = "Order_ID",
                qty_col: str = "Quantity", target: str = "Revenue") -> DataFrame:
    """orders, quantity, revenue, avg_revenue, median_revenue per group,
    revenue descending, first ``n`` rows, rounded to 2 decimals."""
    keyed = df.where(F.col(group_col).isNotNull())
    agg = keyed.groupBy(group_col).agg(
        F.count(id_col).alias("orders"),
        F.sum(qty_col).cast("long").alias("quantity"),
        F.sum(target).alias("revenue"),
        F.avg(target).alias("avg_revenue"))
    med = exact_percentiles(keyed, target, [0.5], by=group_col, names=["median_revenue"])
    out = agg.join(med, on=group_col, how="left").select(
        group_col, "orders", "quantity",
        F.round("revenue", 2).alias("revenue"),
        F.round("avg_revenue", 2).alias("avg_revenue"),
        # 3 decimals: a median of cents can end in a half cent
        F.round("median_revenue", 3).alias("median_revenue"))
    out = out.orderBy(F.col("revenue").desc(), F.col(group_col))
    return out.limit(n) if n else out


def top_sum(df: DataFrame, group_col: str, value: str, n: int = 15, name: str | None = None,
            decimals: int = 2) -> DataFrame:
    """sum(value) by group, descending, head n (category / region / product /
    state revenue, family totals)."""
    name = name or value
    out = (df.where(F.col(group_col).isNotNull()).groupBy(group_col)
             .agg(F.round(F.sum(value), decimals).alias(name))
             .orderBy(F.col(name).desc(), F.col(group_col)))
    return out.limit(n) if n else out


def value_counts(df: DataFrame, col: str, name: str = "count", share: str = "share") -> DataFrame:
    """Counts per value with the share of all non-NULL rows (percent)."""
    rows = df.where(F.col(col).isNotNull())
    counts = rows.groupBy(col).agg(F.count(F.lit(1)).alias(name))
    total = rows.agg(F.count(F.lit(1)).alias("__total"))  # one row
    return (counts.crossJoin(F.broadcast(total))
            .withColumn(share, F.round(F.col(name) * 100.0 / F.col("__total"), 4)).drop("__total"))


def cardinality(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct non-NULL values per column, sorted descending (long form)."""
    # a narrow scan and a two-step group-by per column: nothing is expanded,
    # and a hot value is one partial row a task
    out = None
    for c in cols or df.columns:
        one = (df.select(c).where(F.col(c).isNotNull()).distinct()
               .agg(F.count(F.lit(1)).alias("distinct_values"))
               .select(F.lit(c).alias("column"), "distinct_values"))
        out = one if out is None else out.union(one)
    return out.orderBy(F.col("distinct_values").desc(), "column")


# ---------------------------------------------------------------- calendar bins

def calendar_spine(df: DataFrame, date_col: str, step: str = "day", out: str = "period") -> DataFrame:
    """All days (or month ends) between min and max of ``date_col``."""
    b = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    if step == "day":
        return b.select(F.explode(F.sequence("lo", "hi")).alias(out))
    if step == "month":
        seq = F.sequence(F.trunc("lo", "MM"), F.trunc("hi", "MM"), F.expr("INTERVAL 1 MONTH"))
        return b.select(F.explode(seq).alias("__m")).select(F.last_day("__m").alias(out))
    raise ValueError(step)


def binned_over_spine(df: DataFrame, date_col: str, aggs: dict[str, Column], step: str = "month",
                      out: str = "period", zero_fill: Sequence[str] = ()) -> DataFrame:
    """resample-like bins: aggregate per bin, left join onto the calendar
    spine, sums of empty bins become 0 (means stay NULL)."""
    key = F.last_day(date_col) if step == "month" else F.col(date_col)
    binned = df.where(F.col(date_col).isNotNull()).groupBy(key.alias(out)).agg(
        *[e.alias(k) for k, e in aggs.items()])
    spine = calendar_spine(df, date_col, step, out)
    res = spine.join(binned, on=out, how="left")
    return res.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zero_fill})


def monthly_sum(df: DataFrame, date_col: str, value: str, name: str = "revenue",
                decimals: int = 2) -> DataFrame:
    return binned_over_spine(df, date_col, {name: F.round(F.sum(value), decimals)},
                             "month", "month_end", zero_fill=[name])


def daily_sum(df: DataFrame, date_col: str, value: str, name: str = "revenue",
              decimals: int = 2) -> DataFrame:
    return binned_over_spine(df, date_col, {name: F.round(F.sum(value), decimals)},
                             "day", "day", zero_fill=[name])


def quarterly_sum(df: DataFrame, date_col: str, value: str, name: str = "revenue") -> DataFrame:
    return (df.where(F.col(date_col).isNotNull())
              .groupBy(quarter_period(date_col).alias("quarter"))
              .agg(F.round(F.sum(value), 2).alias(name)))


def yearly_sum(df: DataFrame, date_col: str, value: str, name: str = "revenue") -> DataFrame:
    return (df.where(F.col(date_col).isNotNull())
              .groupBy(F.year(date_col).alias("year"))
              .agg(F.round(F.sum(value), 2).alias(name)))


def weekday_sum(df: DataFrame, date_col: str, value: str, name: str = "revenue") -> DataFrame:
    return (df.where(F.col(date_col).isNotNull())
              .groupBy(day_name(date_col).alias("weekday"))
              .agg(F.round(F.sum(value), 2).alias(name))
              .orderBy(F.col(name).desc()))


# Weekday names, Monday first (Monday = 0).
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def weekday_mean(df: DataFrame, date_col: str, value: str, name: str = "mean_sales") -> DataFrame:
    """Mean by weekday in Monday..Sunday order; absent days keep NULL."""
    spark = df.sparkSession
    days = spark.range(7).select(F.col("id").cast("int").alias("dayofweek"),
                                 F.get(F.array(*map(F.lit, WEEKDAYS)), F.col("id").cast("int"))
                                 .alias("weekday"))
    means = (df.where(F.col(date_col).isNotNull())
               .groupBy(F.weekday(date_col).alias("dayofweek"))
               .agg(F.round(F.avg(value), 4).alias(name)))
    return days.join(F.broadcast(means), "dayofweek", "left").orderBy("dayofweek")


def best_bin(binned: DataFrame, label: str, value: str) -> DataFrame:
    """argmax row of a small binned table (best month / best weekday)."""
    return binned.agg(F.max_by(label, value).alias(label), F.max(value).alias(value))


# ---------------------------------------------------------------- pivots

def pivot_sum(df: DataFrame, row: str, col: str, value: str, values: Sequence | None = None,
              decimals: int = 2) -> DataFrame:
    """sum(value) in a row x col grid; absent cells NULL.  The pivot values
    are passed explicitly when known (saves the extra distinct job)."""
    g = df.where(F.col(row).isNotNull() & F.col(col).isNotNull()).groupBy(row)
    p = g.pivot(col, list(values)) if values is not None else g.pivot(col)
    out = p.agg(F.round(F.sum(value), decimals))
    return out.select(row, *[F.col(c).alias(str(c)) for c in out.columns if c != row])


# ---------------------------------------------------------------- moments

def _sample_skew(c: Column) -> Column:
    """Bias-corrected sample skewness (pandas ``skew``)."""
    n = F.count(c)
    return F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2)


def target_summary(df: DataFrame, target: str = "Revenue",
                   probs: Sequence[float] = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99),
                   decimals: int = 4) -> DataFrame:
    """mean, median, std, min, max, skew and quantiles of the target (one row)."""
    t = F.col(target)
    moments = df.agg(
        F.round(F.avg(t), decimals).alias("mean"),
        F.round(F.stddev_samp(t), decimals).alias("std"),
        F.min(t).alias("min"), F.max(t).alias("max"),
        F.round(_sample_skew(t), decimals).alias("skew"),
        F.round(_sample_skew(F.log1p(t)), decimals).alias("log_skew"))
    names = ["median"] + [f"p{int(round(p * 100)):02d}" for p in probs]
    q = exact_percentiles(df, target, [0.5] + list(probs), names=names)
    q = q.select(*[F.round(c, 2).alias(c) for c in names])
    return _one_row_join(moments, q)


def _one_row_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Side by side of two one-row frames (joined on a constant key)."""
    return a.withColumn("__k", F.lit(1)).join(b.withColumn("__k", F.lit(1)), "__k").drop("__k")


def describe_numeric(df: DataFrame, cols: Sequence[str],
                     probs: Sequence[float] = (0.25, 0.5, 0.75),
                     decimals: int = 2) -> DataFrame:
    """pandas ``describe`` in long form: one row per column."""
    cols = list(cols)
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    long = df.selectExpr(f"stack({len(cols)}, {stack}) as (column, value)")
    mom = long.groupBy("column").agg(
        F.count("value").alias("count"),
        F.round(F.avg("value"), decimals).alias("mean"),
        F.round(F.stddev_samp("value"), decimals).alias("std"),
        F.round(F.min("value"), decimals).alias("min"),
        F.round(F.max("value"), decimals).alias("max"))
    names = [f"p{int(round(p * 100)):02d}" for p in probs]
    q = exact_percentiles(long, "value", probs, by="column", names=names)
    q = q.select("column", *[F.round(c, decimals).alias(c) for c in names])
    return mom.join(q, "column", "left")


def correlation_long(df: DataFrame, cols: Sequence[str], decimals: int = 4) -> DataFrame:
    """Pearson correlation for every ordered pair, long form (row, col, corr);
    NULL pairs are skipped per pair.  Two passes: the means, then the sums of
    centred products of all pairs, one set of small matrices a task."""
    cols = list(cols)
    k = len(cols)
    x = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    centre = x.agg(*[F.avg(f"c{i}").alias(f"c{i}") for i in range(k)]).first()
    centre = np.array([0.0 if v is None else v for v in centre])

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((4, k, k))
        for b in batches:
            v = b.to_numpy(np.float64) - centre
            there = ~np.isnan(v)
            v, m = np.where(there, v, 0.0), there.astype(np.float64)
            # per pair: rows with both, sum of the first, its square, the product
            total += np.stack([m.T @ m, v.T @ m, (v * v).T @ m, v.T @ v])
        yield pd.DataFrame({"g": [total.ravel()]})

    parts = x.mapInPandas(sums, "g array<double>").rdd.map(lambda r: np.asarray(r[0]))
    n, s, q, p = parts.treeReduce(lambda a, b: a + b).reshape(4, k, k)
    with np.errstate(divide="ignore", invalid="ignore"):
        spread = q - s * s / n
        corr = (p - s * s.T / n) / np.sqrt(spread * spread.T)
    rows = [(a, b, float(corr[i, j]) if np.isfinite(corr[i, j]) else None)
            for i, a in enumerate(cols) for j, b in enumerate(cols)]
    long = df.sparkSession.createDataFrame(rows, "row string, col string, corr double")
    # + 0.0 turns a rounded -0.0 into 0.0
    return long.withColumn("corr", F.round("corr", decimals) + F.lit(0.0))


# ---------------------------------------------------------------- residual tables

def residual_summary(df: DataFrame, by: str | Column, residual: str = "residual",
                     name: str | None = None, decimals: int = 4) -> DataFrame:
    """mean, median, std, count of the residual per group."""
    key = _c(by).alias(name or (by if isinstance(by, str) else "group"))
    k = name or (by if isinstance(by, str) else "group")
    keyed = df.select(key, F.col(residual)).where(F.col(k).isNotNull())
    agg = keyed.groupBy(k).agg(
        F.round(F.avg(residual), decimals).alias("mean_residual"),
        F.round(F.stddev_samp(residual), decimals).alias("std_residual"),
        F.count(residual).alias("count"))
    med = exact_percentiles(keyed, residual, [0.5], by=k, names=["median_residual"])
    return agg.join(med.select(k, F.round("median_residual", decimals).alias("median_residual")),
                    k, "left")


def error_by_group_top(df: DataFrame, group: str, actual: str, pred: str, n: int = 15) -> DataFrame:
    """MAE and total actual per group, MAE descending, head n."""
    out = (df.groupBy(group)
             .agg(F.round(F.avg(F.abs(F.col(actual) - F.col(pred))), 4).alias("mae"),
                  F.round(F.sum(actual), 2).alias("total_sales"))
             .orderBy(F.col("mae").desc(), group))
    return out.limit(n)


def holiday_daily(holidays: DataFrame, date_col: str = "date") -> DataFrame:
    """Per date over non-transferred rows: is_holiday = any type <> 'Work Day',
    holiday_count = rows."""
    active = holidays.where(~F.col("transferred"))
    return active.groupBy(date_col).agg(
        F.max((F.col("type") != "Work Day").cast("int")).alias("is_holiday"),
        F.count(F.lit(1)).alias("holiday_count"))


def promo_summary(df: DataFrame, bucket: Column, value: str = "sales") -> DataFrame:
    keyed = df.select(bucket.alias("promo_bucket"), F.col(value))
    agg = keyed.groupBy("promo_bucket").agg(
        F.count(F.lit(1)).alias("count"), F.round(F.avg(value), 4).alias("mean_sales"))
    med = exact_percentiles(keyed, value, [0.5], by="promo_bucket", names=["median_sales"])
    return agg.join(med.select("promo_bucket", F.round("median_sales", 4).alias("median_sales")),
                    "promo_bucket", "left")
