import datetime as dt

import numpy as np
import pandas as pd

from salescope.operators import aggregates as A
from salescope.operators import metrics as M


def test_monthly_spine_fills_empty_months(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 5), 10.0), (dt.date(2024, 1, 20), 5.0),
                                (dt.date(2024, 4, 2), 1.0)], "d date, v double")
    rows = A.monthly_sum(df, "d", "v", "revenue").orderBy("month_end").collect()
    assert [(r["month_end"], r["revenue"]) for r in rows] == [
        (dt.date(2024, 1, 31), 15.0), (dt.date(2024, 2, 29), 0.0),
        (dt.date(2024, 3, 31), 0.0), (dt.date(2024, 4, 30), 1.0)]


def test_weekday_mean_keeps_absent_days_null(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 2.0), (dt.date(2024, 1, 8), 4.0),
                                (dt.date(2024, 1, 3), 1.0)], "d date, v double")
    rows = A.weekday_mean(df, "d", "v").collect()
    assert [r["weekday"] for r in rows][:2] == ["Monday", "Tuesday"]
    assert rows[0]["mean_sales"] == 3.0 and rows[1]["mean_sales"] is None and rows[2]["mean_sales"] == 1.0


def test_target_summary_matches_pandas(spark):
    rng = np.random.default_rng(0)
    vals = np.round(rng.gamma(2, 300, 4000), 2)
    df = spark.createDataFrame([(float(v),) for v in vals], "Revenue double")
    r = A.target_summary(df, "Revenue").first()
    s = pd.Series(vals)
    assert abs(r["skew"] - round(s.skew(), 4)) < 1e-4  # bias-corrected sample skew
    assert abs(r["std"] - round(s.std(), 4)) < 1e-4
    assert r["median"] == round(float(s.median()), 2)
    assert abs(r["log_skew"] - round(np.log1p(s).skew(), 4)) < 1e-4


def test_group_sales_drops_null_keys_and_orders(spark):
    df = spark.createDataFrame([(1, "a", 2, 10.0), (2, "a", 1, 20.0), (3, "b", 5, 100.0),
                                (4, None, 1, 1000.0)],
                               "Order_ID long, Category string, Quantity int, Revenue double")
    rows = A.group_sales(df, "Category", 10).collect()
    assert [r["Category"] for r in rows] == ["b", "a"]
    assert rows[1]["orders"] == 2 and rows[1]["quantity"] == 3 and rows[1]["median_revenue"] == 15.0


def test_correlation_long_symmetric(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(size=500)
    b = 2 * a + rng.normal(size=500)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double")
    got = {(r["row"], r["col"]): r["corr"] for r in A.correlation_long(df, ["a", "b"]).collect()}
    assert got[("a", "a")] == 1.0 and got[("a", "b")] == got[("b", "a")]
    assert abs(got[("a", "b")] - round(np.corrcoef(a, b)[0, 1], 4)) < 1e-4


def test_metrics_against_numpy_and_guards(spark):
    y = np.array([3.0, 0.0, 5.0, 2.0])
    p = np.array([2.5, -1.0, 4.0, 2.0])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    r = M.regression_metrics(df, "y", "p", decimals=None).first()
    assert abs(r["MAE"] - np.mean(np.abs(y - p))) < 1e-12
    assert abs(r["R2"] - (1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))) < 1e-12
    s = M.sales_metrics(df, "y", "p", decimals=None).first()
    pc = np.clip(p, 0, None)  # predictions clipped before every store metric
    assert abs(s["RMSLE"] - np.sqrt(np.mean((np.log1p(y) - np.log1p(pc)) ** 2))) < 1e-12
    assert abs(s["MAE"] - np.mean(np.abs(y - pc))) < 1e-12
    const = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "y double, p double")
    assert M.regression_metrics(const, "y", "p").first()["R2"] == 1.0
    q = M.quantity_metrics(df, "y", "p", 1, 11, decimals=None).first()
    r_ = np.rint(np.clip(p, 1, 11))
    assert abs(q["Exact_Accuracy"] - np.mean(y == r_)) < 1e-12
    assert abs(q["Within_1_Accuracy"] - np.mean(np.abs(y - r_) <= 1)) < 1e-12
