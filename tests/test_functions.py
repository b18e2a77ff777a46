import datetime as dt

from pyspark.sql import functions as F

from salescope.functions import columns as C
from salescope.functions import dates as D


def test_parse_mdy_traps(spark):
    texts = ["12-15-24", "1-5-24", "01-05-24", "02-30-24", "13-01-24", "12/15/24", "", None,
             "12-15-2024", " 3-7-99 ", "07-04-68", "07-04-69", "x1-1-24"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["d"] for r in df.select(D.parse_mdy("t").alias("d")).collect()]
    assert got == [dt.date(2024, 12, 15), dt.date(2024, 1, 5), dt.date(2024, 1, 5), None, None, None,
                   None, None, None, dt.date(1999, 3, 7), dt.date(2068, 7, 4), dt.date(1969, 7, 4), None]


def test_weekday_monday_zero_and_weekend(spark):
    # 2024-01-01 was a Monday
    df = spark.range(7).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    rows = df.select(D.weekday0("d").alias("w"), D.is_weekend("d").alias("we"),
                     D.day_name("d").alias("n")).collect()
    assert [r["w"] for r in rows] == list(range(7))
    assert [r["we"] for r in rows] == [0, 0, 0, 0, 0, 1, 1]
    assert rows[0]["n"] == "Monday"


def test_promo_bucket_right_closed(spark):
    df = spark.createDataFrame([(v,) for v in [0, 1, 5, 6, 20, 21, None]], "p int")
    got = [r["b"] for r in df.select(C.promo_bucket("p").alias("b")).collect()]
    assert got == ["0", "1-5", "1-5", "6-20", "6-20", "20+", None]


def test_rounded_quantity_half_even_and_clip(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (0.2,), (99.0,), (-4.0,)], "p double")
    got = [r["q"] for r in df.select(C.rounded_quantity("p", 1, 11).alias("q")).collect()]
    assert got == [2.0, 4.0, 1.0, 11.0, 1.0]


def test_month_end_and_quarter_labels(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 10),)], "d date")
    r = df.select(D.month_end("d").alias("m"), D.quarter_period("d").alias("q"),
                  D.month_period("d").alias("p")).first()
    assert r["m"] == dt.date(2024, 2, 29) and r["q"] == "2024Q1" and r["p"] == "2024-02"
