"""The six store-panel tables (train, test, stores, oil, holidays_events,
transactions) derived from the driver tables, and readers for the same six
tables when they arrive as files.

Derivation rules are the stand-ins of FIXTURES 2.3.  Everything is a
DataFrame plan; the only values brought to the driver are two scalar dates
(the calendar bounds of the panel).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from salescope.operators.joins import sized_broadcast
from salescope.session import materialize
from salescope.sources.tables import panel_sales, table

SERIES_KEYS = ("store_nbr", "family")
HORIZON_DAYS = 16

# Fixed values of the holiday stand-in: (month, day, type, locale).
HOLIDAY_RULES = (
    (1, 1, "Holiday", "National"),
    (12, 25, "Holiday", "National"),
    (5, 1, "Holiday", "Regional"),
    (7, 4, "Work Day", "National"),
)
STORE_TYPE_LETTERS = "ABCDE"


def date_bounds(df: DataFrame, date_col: str = "date"):
    """(min, max) of a date column: one scalar aggregate."""
    row = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi")).first()
    return row["lo"], row["hi"]


def fill_panel(sales: DataFrame, start=None, end=None, date_col: str = "date",
               keys: Sequence[str] = SERIES_KEYS, fill: dict | None = None) -> DataFrame:
    """Complete (date x series) panel; days without a row get the fill values.

    The calendar is generated per series with ``explode(sequence(...))`` (no
    cross join), then the observed rows are joined on (keys, date).  Each
    series has at most one row per calendar day, so the later per-series
    windows are bounded by the calendar length whatever the skew of the raw
    data.
    """
    fill = {"sales": 0.0, "onpromotion": 0} if fill is None else fill
    if start is None or end is None:
        lo, hi = date_bounds(sales, date_col)
        start, end = start or lo, end or hi
    keys = list(keys)
    spine = (sales.select(*keys).distinct()
                  .withColumn(date_col, F.explode(F.sequence(F.lit(start), F.lit(end)))))
    out = spine.join(sales, on=keys + [date_col], how="left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(sales.schema[c].dataType))
                            for c, v in fill.items()})


def with_panel_ids(panel: DataFrame, start, date_col: str = "date",
                   keys: Sequence[str] = SERIES_KEYS, offset_days: int = 0) -> DataFrame:
    """``id`` = row number over (date, keys) of a complete panel, computed
    arithmetically (day index x number of series + series rank) so that no
    global sort is needed.  The series table is small and is broadcast after
    a size check.
    """
    keys = list(keys)
    series = panel.select(*keys).distinct()
    n_series = series.count()
    # Global order over the series table only (one row per series).
    ranked = series.withColumn("__s", F.row_number().over(Window.orderBy(*keys)) - 1)
    out = panel.join(sized_broadcast(ranked), on=keys)
    day = F.datediff(F.col(date_col), F.lit(start)) + F.lit(offset_days)
    return out.withColumn("id", (day.cast("long") * F.lit(n_series) + F.col("__s")).cast("long")) \
              .drop("__s")


class TablesOnDemand(Mapping):
    """Tables by name, each made when it is first asked for."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]):
        self._makers, self._made = makers, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self):
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def panel_tables(spark: SparkSession, sf_dir: str, store_key: str = "n_regionkey") -> Mapping[str, DataFrame]:
    """train / test / stores / oil / holidays_events / transactions, and the
    observed sales they come from (a row a day and series), which are kept: the
    joins of the fact tables run once, and only when a table of theirs is
    asked for."""

    def observed() -> DataFrame:
        return materialize(panel_sales(spark, sf_dir, store_key), "panel_observed")

    def train() -> DataFrame:
        lo, hi = date_bounds(out["observed"])
        return with_panel_ids(fill_panel(out["observed"], lo, hi), lo).select(
            "id", "date", "store_nbr", "family",
            F.col("sales").cast("double").alias("sales"),
            F.col("onpromotion").cast("int").alias("onpromotion"))

    def test() -> DataFrame:
        lo, hi = date_bounds(out["observed"])
        future = (out["observed"].select(*SERIES_KEYS).distinct()
                  .withColumn("date", F.explode(F.sequence(
                      F.date_add(F.lit(hi), 1), F.date_add(F.lit(hi), HORIZON_DAYS)))))
        return with_panel_ids(future, F.date_add(F.lit(hi), 1), offset_days=(hi - lo).days + 1).select(
            "id", "date", "store_nbr", "family", F.lit(0).cast("int").alias("onpromotion"))

    out = TablesOnDemand({
        "observed": observed,
        "train": train,
        "test": test,
        "stores": lambda: stores_table(spark, sf_dir, store_key),
        "oil": lambda: oil_table(spark, sf_dir),
        "holidays_events": lambda: holidays_table(spark, sf_dir),
        "transactions": lambda: transactions_table(spark, sf_dir, store_key),
    })
    return out


def stores_table(spark: SparkSession, sf_dir: str, store_key: str = "n_regionkey") -> DataFrame:
    region = table(spark, sf_dir, "region")
    if store_key == "n_regionkey":
        base = region.select(F.col("r_regionkey").alias("store_nbr"), "r_name",
                             F.col("r_regionkey").alias("__k"))
    else:
        nation = table(spark, sf_dir, "nation")
        base = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").alias("store_nbr"), "r_name", F.col("r_regionkey").alias("__k"))
    letter = F.substring(F.lit(STORE_TYPE_LETTERS), (F.col("__k") % len(STORE_TYPE_LETTERS)) + 1, 1)
    return base.select(
        F.col("store_nbr").cast("int").alias("store_nbr"),
        F.col("r_name").alias("city"), F.col("r_name").alias("state"),
        letter.alias("type"), (F.col("__k") % 3).cast("int").alias("cluster"))


def oil_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price per weekday date (weekends absent, so fills matter)."""
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_totalprice")
    d = F.col("o_orderdate").cast("date")
    return (orders.where(F.weekday(d) < 5)
                  .groupBy(d.alias("date"))
                  # min: exact and independent of summation order (6 decimals)
                  .agg((F.min("o_totalprice") / 10000.0).alias("dcoilwtico")))


def holidays_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    dates = orders.distinct()
    rules = spark.createDataFrame(
        [(m, d, t, loc) for m, d, t, loc in HOLIDAY_RULES],
        "h_month int, h_day int, type string, locale string")
    hit = dates.join(F.broadcast(rules), (F.month("date") == F.col("h_month"))
                     & (F.dayofmonth("date") == F.col("h_day")))
    return hit.select("date", "type", "locale",
                      (F.weekday("date") >= 5).alias("transferred"))


def transactions_table(spark: SparkSession, sf_dir: str, store_key: str = "n_regionkey") -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    cust = customer.join(sized_broadcast(nation), customer.c_nationkey == nation.n_nationkey)
    return (orders.join(cust, orders.o_custkey == cust.c_custkey)
                  .groupBy(F.col("o_orderdate").cast("date").alias("date"),
                           F.col(store_key).cast("int").alias("store_nbr"))
                  .agg(F.count_distinct("o_orderkey").cast("int").alias("transactions")))


PANEL_SCHEMAS = {
    "train": T.StructType([
        T.StructField("id", T.LongType()), T.StructField("date", T.DateType()),
        T.StructField("store_nbr", T.IntegerType()), T.StructField("family", T.StringType()),
        T.StructField("sales", T.DoubleType()), T.StructField("onpromotion", T.IntegerType())]),
    "test": T.StructType([
        T.StructField("id", T.LongType()), T.StructField("date", T.DateType()),
        T.StructField("store_nbr", T.IntegerType()), T.StructField("family", T.StringType()),
        T.StructField("onpromotion", T.IntegerType())]),
    "stores": T.StructType([
        T.StructField("store_nbr", T.IntegerType()), T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()), T.StructField("type", T.StringType()),
        T.StructField("cluster", T.IntegerType())]),
    "oil": T.StructType([T.StructField("date", T.DateType()),
                         T.StructField("dcoilwtico", T.DoubleType())]),
    "holidays_events": T.StructType([
        T.StructField("date", T.DateType()), T.StructField("type", T.StringType()),
        T.StructField("locale", T.StringType()), T.StructField("locale_name", T.StringType()),
        T.StructField("description", T.StringType()), T.StructField("transferred", T.BooleanType())]),
    "transactions": T.StructType([
        T.StructField("date", T.DateType()), T.StructField("store_nbr", T.IntegerType()),
        T.StructField("transactions", T.IntegerType())]),
}


def read_panel(spark: SparkSession, folder: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """Read the six panel files (``train.csv`` ...) with declared schemas."""
    out = {}
    for name, schema in PANEL_SCHEMAS.items():
        path = f"{folder.rstrip('/')}/{name}.{fmt}"
        reader = spark.read.schema(schema)
        out[name] = (reader.option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)
                     if fmt == "csv" else reader.format(fmt).load(path))
    return out
