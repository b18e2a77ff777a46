"""Date parsing and calendar columns (built-in expressions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The order file writes dates as month-day-two-digit-year; a
# two-digit year 69..99 means 19xx and 00..68 means 20xx (C strptime rule).
ORDER_DATE_PATTERN = r"^(1[0-2]|0[1-9]|[1-9])-(3[01]|[12][0-9]|0[1-9]|[1-9])-([0-9]{2})$"
CENTURY_PIVOT = 69


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_mdy(text: str | Column) -> Column:
    """Text ``M-D-YY`` -> date; anything unparseable or not a calendar day ->
    NULL (never an error, so failures can be counted)."""
    t = F.trim(_c(text))
    ok = t.rlike(ORDER_DATE_PATTERN)
    m = F.regexp_extract(t, ORDER_DATE_PATTERN, 1)
    d = F.regexp_extract(t, ORDER_DATE_PATTERN, 2)
    yy = F.regexp_extract(t, ORDER_DATE_PATTERN, 3).cast("int")
    year = F.when(yy >= CENTURY_PIVOT, yy + 1900).otherwise(yy + 2000)
    iso = F.concat_ws("-", year.cast("string"), F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))
    return F.when(ok, F.try_to_date(iso, "yyyy-MM-dd"))


def parse_order_date(df: DataFrame, col: str = "Order_Date") -> DataFrame:
    return df.withColumn(col, parse_mdy(col))


def weekday0(d: str | Column) -> Column:
    """Day of week with Monday = 0 .. Sunday = 6."""
    return F.weekday(_c(d))


def is_weekend(d: str | Column) -> Column:
    return (weekday0(d) >= 5).cast("int")


def add_time_features(df: DataFrame, date_col: str = "Order_Date") -> DataFrame:
    """year, month, quarter, day_of_week (Mon=0), is_weekend."""
    d = F.col(date_col)
    return df.withColumns({
        "year": F.year(d), "month": F.month(d), "quarter": F.quarter(d),
        "day_of_week": weekday0(d), "is_weekend": is_weekend(d),
    })


def add_calendar_features(df: DataFrame, date_col: str = "date") -> DataFrame:
    """dayofweek (Mon=0), month, year, dayofmonth, is_weekend."""
    d = F.col(date_col)
    return df.withColumns({
        "dayofweek": weekday0(d), "month": F.month(d), "year": F.year(d),
        "dayofmonth": F.dayofmonth(d), "is_weekend": is_weekend(d),
    })


def day_name(d: str | Column) -> Column:
    return F.date_format(_c(d), "EEEE")


def month_period(d: str | Column) -> Column:
    return F.date_format(_c(d), "yyyy-MM")


def quarter_period(d: str | Column) -> Column:
    dd = _c(d)
    return F.concat(F.year(dd).cast("string"), F.lit("Q"), F.quarter(dd).cast("string"))


def month_end(d: str | Column) -> Column:
    """Month bin label as pandas ``resample('ME')``: the month's last day."""
    return F.last_day(_c(d))
