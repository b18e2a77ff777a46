"""Driver contract and a sample of oracle comparisons on the smallest tables."""
import math

import duckdb
import pytest

import __spark_entry__ as E
from salescope.sources.tables import TABLE_NAMES

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["Category", "orders", "quantity", "revenue", "avg_revenue", "median_revenue"]


def test_every_oracle_has_a_query():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(sql) >= 80


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return str(v)[:10]
    return v


def _rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False)),
                  key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", [
    "group_sales_category", "dataset_checks", "describe_numeric", "monthly_revenue",
    "aggregate_features_test", "box_stats_region", "feature_frame", "lag_baselines",
    "promo_summary", "test_feature_rows", "parse_order_date", "histogram_revenue",
])
def test_oracle_sample(spark, name):
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = E.queries()[name](spark, SF).toPandas()
    exp = con.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    a, b = _rows(got), _rows(exp)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for u, v in zip(x, y):
            if isinstance(u, float) and isinstance(v, float):
                assert abs(u - v) <= 1e-6 * max(1.0, abs(u))
            else:
                assert u == v
