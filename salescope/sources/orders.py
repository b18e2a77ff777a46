"""Order files: CSV with a header whose names may carry blanks
(`` Unit_Price ``), dates as ``M-D-YY`` text.

The header is read as-is (all columns as text, no schema inference), names
are stripped, then every column is cast to its declared type; bad dates
become NULL and are counted by the checks instead of failing the read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.functions.dates import parse_mdy
from salescope.operators.quality import assert_checks, dataset_checks, validate_required_columns

# Declared types of the order file (text columns omitted).
ORDER_TYPES = {"Order_ID": "long", "Quantity": "int", "Unit_Price": "double",
               "Revenue": "double", "Profit": "double"}


def read_orders(spark: SparkSession, path: str) -> DataFrame:
    """Raw CSV read: header kept verbatim, every value as text."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def strip_column_names(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Names with leading/trailing blanks stripped; also returns which were."""
    stripped = [c for c in df.columns if c != c.strip()]
    return df.toDF(*[c.strip() for c in df.columns]), stripped


def type_orders(df: DataFrame) -> DataFrame:
    """Declared types (``try_cast``: malformed numbers become NULL) and the
    parsed order date."""
    cols = {c: F.col(c).try_cast(t) for c, t in ORDER_TYPES.items() if c in df.columns}
    if "Order_Date" in df.columns:
        cols["Order_Date"] = parse_mdy("Order_Date")
    return df.withColumns(cols)


def load_clean_validate(spark: SparkSession, path: str, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """read -> strip names -> types and dates -> (orders, one-row check table).
    ``strict`` stops on a table that is not clean (the error names the failed
    checks); otherwise the check table tells."""
    raw, stripped = strip_column_names(read_orders(spark, path))
    validate_required_columns(raw)
    orders = type_orders(raw)
    checks = dataset_checks(orders, stripped)
    if strict:
        checks = checks.persist()
        assert_checks(checks.first())
    return orders, checks


def write_order_csv(df: DataFrame, path: str, padded=("Unit_Price", "Revenue", "Profit")) -> None:
    """Write an order table the way the source files look: M-D-YY dates and
    blank-padded header names for the money columns."""
    out = df.withColumn("Order_Date", F.date_format("Order_Date", "MM-dd-yy"))
    out = out.toDF(*[f" {c} " if c in padded else c for c in out.columns])
    (out.write.mode("overwrite").option("header", True)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path))
