"""Store-sales forecasting frame.

build_feature_frame: panel  -> + store attributes (small, size-checked
broadcast) -> + oil price filled over the sales dates and daily holiday flags
(one row per day, size-checked broadcast) -> calendar columns -> lag and
shifted rolling means (one shuffle + sort by series) -> NULL lags to 0.

Daily side tables are bounded by the number of calendar days, the store
table by the number of stores; only the panel itself grows with the data,
and it is shuffled once (for the series windows).
"""

from __future__ import annotations

from collections import namedtuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.functions.dates import add_calendar_features
from salescope.operators.aggregates import holiday_daily
from salescope.operators.joins import sized_broadcast
from salescope.operators.windows import (LAGS, ROLLING, SHIFT, add_lag_features, ffill_bfill,
                                         lag_feature_columns)
from salescope.session import since

DATE = "date"
TARGET = "sales"
SERIES = ("store_nbr", "family")
# Fixed values of the forecast set-up.
VALIDATION_DAYS = 16
RECENT_TRAIN_DAYS = 365
NUMERIC_FEATURES = [
    "onpromotion", "dcoilwtico", "dayofweek", "month", "year", "dayofmonth", "is_weekend",
    "is_holiday", "holiday_count", "lag_16", "lag_28", "lag_364",
    "rolling_mean_7_shift16", "rolling_mean_28_shift16", "rolling_mean_56_shift16",
]
CATEGORICAL_FEATURES = ["store_nbr", "family", "city", "state", "type", "cluster"]
FEATURE_COLUMNS = NUMERIC_FEATURES + CATEGORICAL_FEATURES
BASELINES = {
    "Lag_16": "lag_16", "Lag_28": "lag_28",
    "Rolling_Mean_28_Shift16": "rolling_mean_28_shift16",
    "Rolling_Mean_56_Shift16": "rolling_mean_56_shift16",
}

Split = namedtuple("Split", "fit valid validation_start fit_start")


def clean_oil(oil: DataFrame) -> DataFrame:
    """Oil price filled forward then backward over its own dates."""
    return ffill_bfill(oil.select(DATE, "dcoilwtico"), DATE, "dcoilwtico")


def oil_on_dates(dates: DataFrame, oil: DataFrame) -> DataFrame:
    """Oil price on each given date: the cleaned price when the oil table has
    the date, else filled forward (then backward) over the given dates."""
    joined = dates.select(DATE).distinct().join(sized_broadcast(clean_oil(oil)), DATE, "left")
    return ffill_bfill(joined, DATE, "dcoilwtico")


def build_feature_frame(sales: DataFrame, stores: DataFrame, oil: DataFrame,
                        holidays: DataFrame) -> DataFrame:
    hd = holiday_daily(holidays, DATE)
    oil_d = oil_on_dates(sales, oil)
    out = (sales.join(sized_broadcast(stores), "store_nbr", "left")
                .join(sized_broadcast(oil_d), DATE, "left")
                .join(sized_broadcast(hd), DATE, "left"))
    out = out.withColumns({"is_holiday": F.coalesce("is_holiday", F.lit(0)),
                           "holiday_count": F.coalesce("holiday_count", F.lit(0))})
    out = add_calendar_features(out, DATE)
    out = add_lag_features(out, SERIES, DATE, TARGET)
    lag_cols = lag_feature_columns()
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in lag_cols})


def recent_window_split(frame: DataFrame, end=None) -> Split:
    """valid = last 16 calendar days (inclusive); fit = the 365 days before."""
    if end is None:
        end = frame.agg(F.max(DATE)).first()[0]
    import datetime as _dt
    validation_start = end - _dt.timedelta(days=VALIDATION_DAYS - 1)
    fit_start = validation_start - _dt.timedelta(days=RECENT_TRAIN_DAYS)
    fit = since(frame, DATE, fit_start).where(F.col(DATE) < F.lit(validation_start))
    valid = since(frame, DATE, validation_start)
    return Split(fit, valid, validation_start, fit_start)


def final_fit_window(frame: DataFrame, end) -> DataFrame:
    """Rows with date >= end - 365 days (366 days including both ends)."""
    import datetime as _dt
    return since(frame, DATE, end - _dt.timedelta(days=RECENT_TRAIN_DAYS))


#: Rows of a series before a row that its lags and rolling means reach.
REACH_ROWS = max(*LAGS, SHIFT + max(ROLLING) - 1)


def forecast_history(train: DataFrame, test: DataFrame, fit_start) -> DataFrame:
    """The rows of ``train`` that the features of its rows from ``fit_start``
    on, and of ``test``, can reach.  Lags count rows, not days: the start goes
    back until every series has ``REACH_ROWS`` rows before ``fit_start`` (days
    may be missing) or there is nothing older.  Of a table kept by month only
    the folders from there on are read."""
    import datetime as _dt
    first = train.agg(F.min(DATE)).first()[0]
    wanted, days = test.select(*SERIES).distinct(), REACH_ROWS
    while first is not None:
        start = fit_start - _dt.timedelta(days=days)
        part = since(train, DATE, start)
        if start <= first:
            return part
        older = part.groupBy(*SERIES).agg(F.count_if(F.col(DATE) < F.lit(fit_start)).alias("__older"))
        older = older.join(wanted, list(SERIES), "full")
        if older.where(F.coalesce("__older", F.lit(0)) < REACH_ROWS).isEmpty():
            return part
        days *= 2
    return train


def union_train_test(train: DataFrame, test: DataFrame) -> DataFrame:
    """Stack train and test (test sales NULL) for a shared feature build."""
    return train.unionByName(test, allowMissingColumns=True)
