import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescope.operators import chartdata as CH
from salescope.operators.quality import duplicate_rows
from salescope.operators.windows import HASH_DIGITS, hash_sample

NAN, INF = float("nan"), float("inf")


def values(spark, *v):
    return spark.createDataFrame([(x, x) for x in v], "v double, w double")


def test_histogram_of_constant_empty_and_odd_values(spark):
    same = CH.histogram(values(spark, 3.0, 3.0, 3.0), F.col("v"), 4).orderBy("bin").collect()
    assert [r["count"] for r in same] == [0, 0, 3, 0]
    assert (same[0].bin_start, same[-1].bin_end) == (2.5, 3.5) and same[2].density == 4.0
    assert CH.histogram(values(spark).limit(0), F.col("v"), 4).count() == 0
    assert CH.histogram(values(spark, NAN, None, INF), F.col("v"), 4).count() == 0
    odd = CH.histogram(values(spark, NAN, 0.0, 1.0, 4.0, None, -INF), F.col("v"), 4).orderBy("bin").collect()
    assert [r["count"] for r in odd] == [1, 1, 0, 1] and not any(math.isnan(r.bin_start) for r in odd)


def test_scaled_values_of_a_constant_column(spark):
    df = values(spark, 2.0, 2.0)
    assert [r.v_z for r in CH.scaled_values(df, ["v"], ["w"]).collect()] == [0.0, 0.0]
    assert CH.scaled_values(df.limit(0), ["v"], ["w"]).count() == 0


def test_square_cells_of_constant_empty_and_odd_values(spark):
    assert [tuple(r) for r in CH.bin2d(values(spark, 1.0, 1.0), "v", "w").collect()] == [(0, 0, 2)]
    assert CH.bin2d(values(spark).limit(0), "v", "w").count() == 0
    assert sum(r["count"] for r in CH.bin2d(values(spark, NAN, None, 1.0, 2.0, INF), "v", "w").collect()) == 2


def test_hexagons_against_the_nearest_of_all_centres(spark):
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=400), 3 * rng.normal(size=400)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    got = {(round(r.x, 6), round(r.y, 6)): r["count"] for r in CH.hexbin(df, "x", "y", 8).collect()}
    across, up = 8, int(8 / math.sqrt(3))
    sx, sy = (x.max() - x.min()) / across, (y.max() - y.min()) / up
    cx, cy = np.meshgrid(np.arange(0, across + 1), np.arange(0, up + 1))
    centres = np.concatenate([np.stack([cx.ravel() + d, cy.ravel() + d], 1) for d in (0.5, 0.0)])
    want = {}
    for a, b in zip((x - x.min()) / sx, (y - y.min()) / sy):
        i = np.argmin((centres[:, 0] - a) ** 2 + 3 * (centres[:, 1] - b) ** 2)
        key = (round(x.min() + centres[i, 0] * sx, 6), round(y.min() + centres[i, 1] * sy, 6))
        want[key] = want.get(key, 0) + 1
    assert got == want
    assert [r["count"] for r in CH.hexbin(values(spark, 1.0, 1.0), "v", "w").collect()] == [2]
    assert CH.hexbin(values(spark).limit(0), "v", "w").count() == 0
    assert CH.hexbin(values(spark, NAN, None), "v", "w").count() == 0


def test_density_is_the_sum_of_all_kernels(spark):
    rng = np.random.default_rng(3)
    v = np.concatenate([rng.normal(size=900), rng.normal(50, 0.1, 100), [-400.0, 1000.0]])
    got = CH.kde(spark.createDataFrame([(float(x),) for x in v], "v double"), F.col("v"), 120).toPandas()
    h = v.std(ddof=1) * len(v) ** -0.2
    grid = np.linspace(*np.quantile(v, [0.005, 0.995]), 120)
    want = np.exp(-0.5 * ((grid[:, None] - v) / h) ** 2).sum(axis=1) / (len(v) * h * math.sqrt(2 * math.pi))
    assert np.allclose(got["x"], grid) and np.allclose(got["density"], want, rtol=0, atol=1e-13)


@pytest.mark.parametrize("odd", [(), (2.0, 2.0, 2.0), (1.0,), (NAN, None), (INF, 1.0)])
def test_density_without_a_bandwidth_is_empty(spark, odd):
    df = values(spark, *odd) if odd else values(spark, 1.0).limit(0)
    assert CH.kde(df, F.col("v")).count() == 0


def test_sample_is_the_smallest_hashes_and_no_task_gathers_it(spark):
    df = spark.range(5000).withColumn("k", F.col("id").cast("string"))
    h = F.md5(F.concat_ws("|", "k", F.lit("42")))
    for n in (0, 1, 777, 4999, 5000, 6000):
        want = [r.id for r in df.orderBy(h, "k").limit(n).collect()]
        assert sorted(r.id for r in hash_sample(df, n, ["k"]).collect()) == sorted(want)
    plan = hash_sample(df, 777, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Exchange" not in plan
    # rows that agree in all counted digits: an exact tie rule
    same = spark.range(50).selectExpr("'x' as k", "id")
    assert len(HASH_DIGITS) == 3 and hash_sample(same, 7, ["k"]).count() == 7
    assert hash_sample(df.limit(0), 5, ["k"]).count() == 0


def test_duplicates_are_compared_in_full(spark):
    rows = [("a", None, 1.0), (None, "a", 1.0), ("a", None, 1.0), ("b", "", None), ("b", None, None), ("b", "", None),
            ("b", "", None)]
    df = spark.createDataFrame(rows, "x string, y string, z double")
    assert duplicate_rows(df).first()[0] == 3
    assert duplicate_rows(df.limit(0)).first()[0] == 0
    assert duplicate_rows(spark.range(1000).toDF("n")).first()[0] == 0
