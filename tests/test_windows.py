import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from salescope.operators import windows as WN
from salescope.sources.panel import fill_panel


def _panel(spark, days=80, missing=(10,)):
    start = dt.date(2024, 1, 1)
    rows = []
    for store in (1, 2):
        for i in range(days):
            if store == 1 and i in missing:
                continue
            rows.append((start + dt.timedelta(days=i), store, "F", float((i * 7 + store) % 13)))
    return spark.createDataFrame(rows, "date date, store_nbr int, family string, sales double")


def test_fill_then_lag_counts_days(spark):
    filled = fill_panel(_panel(spark), fill={"sales": 0.0})
    assert filled.count() == 160
    out = WN.add_lag_features(filled).toPandas().sort_values(["store_nbr", "date"])
    for _, g in out.groupby("store_nbr"):
        s = g["sales"].reset_index(drop=True)
        assert np.allclose(g["lag_16"].fillna(-1).to_numpy(), s.shift(16).fillna(-1).to_numpy())
        ref = s.shift(16).rolling(28, min_periods=1).mean()
        assert np.allclose(g["rolling_mean_28_shift16"].fillna(-1).to_numpy(), ref.fillna(-1).to_numpy())


def test_rolling_skips_nulls_like_pandas(spark):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), 1, "F", None if i > 60 else float(i))
            for i in range(80)]
    df = spark.createDataFrame(rows, "date date, store_nbr int, family string, sales double")
    out = WN.add_lag_features(df).toPandas().sort_values("date")
    s = pd.Series([r[3] for r in rows], dtype="float64")
    for n in (7, 28, 56):
        ref = s.shift(16).rolling(n, min_periods=1).mean()
        assert np.allclose(out[f"rolling_mean_{n}_shift16"].fillna(-1).to_numpy(), ref.fillna(-1).to_numpy())


def test_horizon_invariant(spark):
    """Features of the last 16 days do not move when those days' sales change."""
    base = fill_panel(_panel(spark), fill={"sales": 0.0})
    last = base.agg(F.max("date")).first()[0]
    cut = last - dt.timedelta(days=15)
    changed = base.withColumn("sales", F.when(F.col("date") >= F.lit(cut), F.lit(999.0))
                              .otherwise(F.col("sales")))
    cols = WN.lag_feature_columns()
    a = WN.add_lag_features(base).where(F.col("date") >= F.lit(cut)).select("date", "store_nbr", *cols)
    b = WN.add_lag_features(changed).where(F.col("date") >= F.lit(cut)).select("date", "store_nbr", *cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_ffill_bfill(spark):
    rows = [(dt.date(2024, 1, i), v) for i, v in [(1, None), (2, 5.0), (3, None), (4, 7.0), (5, None)]]
    df = spark.createDataFrame(rows, "date date, x double")
    got = [r["x"] for r in WN.ffill_bfill(df, "date", "x").orderBy("date").collect()]
    assert got == [5.0, 5.0, 5.0, 7.0, 7.0]


def test_best_by_tie_goes_to_first_listed(spark):
    df = spark.createDataFrame([("v", "m1", 1.0, 0), ("v", "m2", 1.0, 1), ("v", "m3", 2.0, 2)],
                               "variant string, model string, RMSE double, listing_order int")
    assert WN.best_by(df, "variant", "RMSE", "listing_order").first()["model"] == "m1"


def test_recent_windows_read_only_their_months(spark):
    import datetime

    from salescope.plans import store_sales as S
    from salescope.session import materialize
    rows = [(datetime.date(2020, 1, 1) + datetime.timedelta(days=i), float(i)) for i in range(900)]
    kept = materialize(spark.createDataFrame(rows, "date date, sales double"), "by-month", by_month_of="date")
    sp = S.recent_window_split(kept)
    plan = sp.valid._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_start" in plan and "month_start" in plan
    assert sp.valid.count() == 16 and sp.fit.count() == 365


def test_forecast_history_is_all_that_features_reach(spark):
    """Features of the pruned history are those of the whole one, also where
    days are missing; of a table kept by month older folders are not read."""
    import datetime
    from salescope.plans import store_sales as S
    from salescope.session import MONTH, materialize
    day = lambda n: datetime.date(2000, 1, 1) + datetime.timedelta(days=n)
    rows = [(n * 10 + f, day(n), 1, f"f{f}", float((n * 7 + f) % 13), n % 3) for n in range(2200) for f in range(2)
            if f == 0 or n % 2 or n > 2100]  # the second series lacks every other day
    train = spark.createDataFrame(rows, "id long, date date, store_nbr int, family string, sales double, onpromotion int")
    test = spark.createDataFrame([(90000 + n * 10 + f, day(n), 1, f"f{f}", 0) for n in range(2200, 2216)
                                  for f in range(3)], "id long, date date, store_nbr int, family string, onpromotion int")
    stores = spark.createDataFrame([(1, "c", "s", "A", 1)], "store_nbr int, city string, state string, type string, cluster int")
    oil = spark.createDataFrame([(day(n), float(n)) for n in range(0, 2216, 3)], "date date, dcoilwtico double")
    holidays = spark.createDataFrame([(day(40), "Holiday", "National", False)],
                                     "date date, type string, locale string, transferred boolean")
    start = day(2199 - S.RECENT_TRAIN_DAYS)
    by_month = materialize(train, "by-month-test", by_month_of="date")
    known = test.where("family <> 'f2'")  # a series without any history asks for all
    part = S.forecast_history(by_month, known, start)
    assert part.agg({"date": "min"}).first()[0] > day(300)
    assert "PartitionFilters: [isnotnull(month_start" in part._jdf.queryExecution().executedPlan().toString()
    whole, some = [S.build_feature_frame(S.union_train_test(t, known), stores, oil, holidays).where(
        S.F.col("date") >= S.F.lit(start)).orderBy("id").collect() for t in (train, part.drop(MONTH))]
    assert len(whole) > 500 and [r.asDict() for r in whole] == [{k: r[k] for k in whole[0].asDict()} for r in some]
    assert S.forecast_history(by_month, test, start).count() == train.count()
    assert S.forecast_history(by_month.limit(0), test, start).count() == 0
