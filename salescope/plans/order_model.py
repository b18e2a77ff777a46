"""Order-revenue problem: time split, train-only lookup features, feature
sets, and the naive expected-revenue forecaster.

Lookups: one aggregate over the train rows with GROUPING SETS (one scan for
all five keys, combined map-side), kept as one small cached table; each
key's lookup is broadcast to the fact rows after a size check.  Defaults are
three scalars.
"""

from __future__ import annotations

from collections import namedtuple
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.functions.dates import add_time_features
from salescope.operators.joins import sized_broadcast
from salescope.operators.metrics import regression_metrics
from salescope.operators.quantiles import exact_percentiles

# Fixed values of the order problem.
TARGET = "Revenue"
DATE_COLUMN = "Order_Date"
TEST_START = "2000-04-01"  # cut of the driver data (the source data used 2024-10-01)
CATEGORICAL_FEATURES = ["City", "State", "Region", "Category", "Sub_Category", "Product_Name"]
TIME_FEATURES = ["year", "month", "quarter", "day_of_week", "is_weekend"]
AGG_FEATURES = [
    "product_order_count", "product_avg_revenue", "category_avg_revenue", "state_avg_revenue",
    "region_avg_revenue", "product_avg_quantity", "category_avg_quantity",
    "sub_category_avg_quantity", "state_avg_quantity", "region_avg_quantity",
    "expected_revenue_product", "expected_revenue_category", "expected_revenue_sub_category",
    "expected_revenue_state", "expected_revenue_region",
]
QUANTITY_AGG_FEATURES = [
    "product_order_count", "product_avg_quantity", "category_avg_quantity",
    "sub_category_avg_quantity", "state_avg_quantity", "region_avg_quantity",
]
# key column -> {feature: (aggregate, source column)}
LOOKUP_SPECS = {
    "Product_Name": {"product_order_count": ("count", None),
                     "product_avg_revenue": ("avg", "Revenue"),
                     "product_avg_quantity": ("avg", "Quantity")},
    "Category": {"category_avg_revenue": ("avg", "Revenue"),
                 "category_avg_quantity": ("avg", "Quantity")},
    "Sub_Category": {"sub_category_avg_quantity": ("avg", "Quantity")},
    "State": {"state_avg_revenue": ("avg", "Revenue"), "state_avg_quantity": ("avg", "Quantity")},
    "Region": {"region_avg_revenue": ("avg", "Revenue"), "region_avg_quantity": ("avg", "Quantity")},
}
EXPECTED_REVENUE = {
    "expected_revenue_product": "product_avg_quantity",
    "expected_revenue_category": "category_avg_quantity",
    "expected_revenue_sub_category": "sub_category_avg_quantity",
    "expected_revenue_state": "state_avg_quantity",
    "expected_revenue_region": "region_avg_quantity",
}

Prepared = namedtuple("Prepared", "train test lookups defaults")


def time_split(df: DataFrame, test_start: str = TEST_START, date_col: str = DATE_COLUMN):
    """(train, test): before / from the cut date (rows without a date drop)."""
    cut = F.lit(test_start).cast("date")
    return df.where(F.col(date_col) < cut), df.where(F.col(date_col) >= cut)


def feature_sets(include_quantity: bool):
    numeric = ["Unit_Price"] + TIME_FEATURES + AGG_FEATURES
    if include_quantity:
        numeric = ["Quantity"] + numeric
    categorical = list(CATEGORICAL_FEATURES)
    return numeric, categorical, numeric + categorical


def quantity_feature_set():
    """Features of the quantity models: price, calendar and the six averages
    and counts that say something about quantities."""
    numeric = ["Unit_Price"] + TIME_FEATURES + QUANTITY_AGG_FEATURES
    categorical = list(CATEGORICAL_FEATURES)
    return numeric, categorical, numeric + categorical


def _default_kind(agg: str, src: str | None) -> str:
    return "count" if agg == "count" else ("quantity" if src == "Quantity" else "revenue")


def fit_lookups(train: DataFrame) -> DataFrame:
    """Long lookup table (key_col, key, feature columns...) from one
    GROUPING SETS aggregate.  Cached: it is small and read once per key."""
    keys = list(LOOKUP_SPECS)
    aggs = [F.count(F.lit(1)).alias("__count"),
            F.avg("Revenue").alias("__avg_revenue"), F.avg("Quantity").alias("__avg_quantity")]
    g = train.groupingSets([[k] for k in keys], *keys).agg(*aggs)
    # in each grouping set exactly one key column is non-NULL (rows whose own
    # key is NULL drop out, as pandas groupby drops NULL keys)
    which = None
    for k in keys:
        cond = F.col(k).isNotNull()
        which = F.when(cond, F.lit(k)) if which is None else which.when(cond, F.lit(k))
    value = F.coalesce(*[F.col(k) for k in keys])
    out = g.select(which.alias("key_col"), value.alias("key"),
                   "__count", "__avg_revenue", "__avg_quantity").where(F.col("key").isNotNull())
    return out.persist()


def lookup_for(lookups: DataFrame, key: str) -> DataFrame:
    """Wide lookup of one key: key column + its features."""
    sel = [F.col("key").alias(key)]
    for name, (agg, src) in LOOKUP_SPECS[key].items():
        col = "__count" if agg == "count" else ("__avg_revenue" if src == "Revenue" else "__avg_quantity")
        sel.append(F.col(col).cast("double").alias(name))
    return lookups.where(F.col("key_col") == key).select(*sel)


def lookups_long(lookups: DataFrame) -> DataFrame:
    parts = []
    for key, feats in LOOKUP_SPECS.items():
        wide = lookup_for(lookups, key)
        for name in feats:
            parts.append(wide.select(F.lit(name).alias("feature"), F.col(key).alias("key"),
                                     F.round(F.col(name), 6).alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fit_defaults(train: DataFrame, lookups: DataFrame) -> DataFrame:
    """One row: median product group size, train mean quantity, train mean revenue."""
    counts = lookups.where(F.col("key_col") == "Product_Name").select("__count")
    med = exact_percentiles(counts, "__count", [0.5], names=["product_order_count_default"])
    means = train.agg(F.avg("Quantity").alias("quantity_default"),
                      F.avg("Revenue").alias("revenue_default"))
    return med.withColumn("__k", F.lit(1)).join(means.withColumn("__k", F.lit(1)), "__k").drop("__k")


def apply_lookups(df: DataFrame, lookups: DataFrame, defaults: dict[str, float]) -> DataFrame:
    """Attach the 10 lookup features (default for unseen / NULL keys) and the
    5 expected-revenue products."""
    out = df
    for key, feats in LOOKUP_SPECS.items():
        lk = lookup_for(lookups, key).withColumnRenamed(key, f"__lk_{key}")
        out = out.join(sized_broadcast(lk), out[key] == F.col(f"__lk_{key}"), "left").drop(f"__lk_{key}")
        out = out.withColumns({
            name: F.coalesce(F.col(name), F.lit(float(defaults[_default_kind(agg, src)])))
            for name, (agg, src) in feats.items()})
    return out.withColumns({e: F.col("Unit_Price") * F.col(q) for e, q in EXPECTED_REVENUE.items()})


def prepare_model_data(df: DataFrame, test_start: str = TEST_START) -> Prepared:
    """time features -> split -> train-only lookups applied to both sides."""
    with_time = add_time_features(df, DATE_COLUMN)
    train, test = time_split(with_time, test_start)
    lookups = fit_lookups(train)
    d = fit_defaults(train, lookups).first()
    defaults = {"count": d["product_order_count_default"], "quantity": d["quantity_default"],
                "revenue": d["revenue_default"]}
    # preprocessing fits and every model read these repeatedly; what does not
    # fit in memory is made again from the (short) lineage, never kept on disk
    return Prepared(apply_lookups(train, lookups, defaults).persist(StorageLevel.MEMORY_ONLY),
                    apply_lookups(test, lookups, defaults).persist(StorageLevel.MEMORY_ONLY), lookups, defaults)


def feature_output(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cols = [F.round(c, 6).alias(c) for c in AGG_FEATURES if not c.startswith("expected")]
    cols += [F.round(c, 4).alias(c) for c in AGG_FEATURES if c.startswith("expected")]
    return df.select(*keys, *cols)


def split_metadata(df: DataFrame, test_start: str = TEST_START) -> DataFrame:
    train, test = time_split(df, test_start)
    names = {"Product_Name": "products", "Category": "categories", "Sub_Category": "sub_categories",
             "State": "states", "Region": "regions"}
    a = train.agg(F.count(F.lit(1)).alias("train_rows"),
                  F.min(DATE_COLUMN).alias("train_start"), F.max(DATE_COLUMN).alias("train_end"))
    for c, name in names.items():
        # a narrow scan and a two-step group-by each: nothing is expanded
        one = train.select(c).where(F.col(c).isNotNull()).distinct().agg(F.count(F.lit(1)).alias(name))
        a = a.crossJoin(one)  # one row each
    b = test.agg(F.count(F.lit(1)).alias("test_rows"),
                 F.min(DATE_COLUMN).alias("test_start"), F.max(DATE_COLUMN).alias("test_end"))
    return a.withColumn("__k", F.lit(1)).join(b.withColumn("__k", F.lit(1)), "__k").drop("__k")


def naive_predictions(df: DataFrame, keys: Sequence[str], prep: Prepared | None = None) -> DataFrame:
    """Test rows with actual, predicted (= expected_revenue_product) and residual."""
    prep = prep or prepare_model_data(df)
    return prep.test.select(*keys, DATE_COLUMN, "Category",
                            F.col(TARGET).alias("actual"),
                            F.col("expected_revenue_product").alias("predicted"),
                            (F.col(TARGET) - F.col("expected_revenue_product")).alias("residual"))


def naive_metrics(df: DataFrame, keys: Sequence[str], prep: Prepared | None = None) -> DataFrame:
    return regression_metrics(naive_predictions(df, keys, prep), "actual", "predicted")
