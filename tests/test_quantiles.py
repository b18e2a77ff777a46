import numpy as np
import pytest

from pyspark.sql import functions as F

from salescope.operators.quantiles import DIGITS, _selected, exact_median, exact_percentiles, ordered_bits

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0, 0.3333]


def _frame(spark, rng, n_groups=3, n=3000):
    rows = []
    for g in range(n_groups):
        vals = np.round(rng.gamma(2.0, 100.0, size=n + g * 500), 2)
        vals[:50] = vals[50]  # ties
        rows += [(f"g{g}", float(v)) for v in vals]
    rows += [("g0", None), (None, 1.0)]
    return spark.createDataFrame(rows, "k string, v double"), rows


@pytest.mark.parametrize("digits", [DIGITS, (16, 16, 16, 16), (12, 52)])
def test_grouped_exact_against_numpy(spark, digits):
    df, rows = _frame(spark, np.random.default_rng(1))
    got = {r["k"]: r for r in exact_percentiles(df, "v", PROBS, by="k", digits=digits).collect()}
    for g in ("g0", "g1", "g2"):
        vals = np.array([v for k, v in rows if k == g and v is not None])
        exp = np.quantile(vals, PROBS)
        res = np.array([got[g][f"q{i}"] for i in range(len(PROBS))])
        assert np.allclose(res, exp, rtol=0, atol=1e-9)
    assert None not in got  # NULL keys drop out, as in a pandas groupby


@pytest.mark.parametrize("digits", [DIGITS, (8,) * 8])
def test_global_exact_against_numpy(spark, digits):
    rng = np.random.default_rng(7)
    vals = rng.normal(size=5001)
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    r = exact_percentiles(df, "v", PROBS, digits=digits).first()
    assert np.allclose([r[f"q{i}"] for i in range(len(PROBS))], np.quantile(vals, PROBS), atol=1e-12)


def test_median_small_cases(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 5.0), ("c", 1.0), ("c", 1.0), ("c", 7.0)],
                               "k string, v double")
    got = {r["k"]: r["median"] for r in exact_median(df, "v", by="k").collect()}
    assert got == {"a": 1.5, "b": 5.0, "c": 1.0}


def test_hot_group_is_exact(spark):
    # one key holds most rows: still exact, by the same path
    rng = np.random.default_rng(3)
    hot = rng.exponential(10, 20000)
    cold = rng.exponential(10, 50)
    rows = [("hot", float(v)) for v in hot] + [("cold", float(v)) for v in cold]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r for r in exact_percentiles(df, "v", [0.1, 0.5, 0.9], by="k").collect()}
    assert np.allclose([got["hot"][f"q{i}"] for i in range(3)], np.quantile(hot, [0.1, 0.5, 0.9]))
    assert np.allclose([got["cold"][f"q{i}"] for i in range(3)], np.quantile(cold, [0.1, 0.5, 0.9]))


def test_many_probabilities_path(spark):
    rng = np.random.default_rng(11)
    vals = np.round(rng.gamma(2, 50, 3000), 1)
    df = spark.createDataFrame([("a" if i % 2 else "b", float(v)) for i, v in enumerate(vals)],
                               "k string, v double")
    probs = [i / 99 for i in range(100)]
    got = {r["k"]: r for r in exact_percentiles(df, "v", probs, by="k").collect()}
    for k, sel in (("a", np.arange(3000) % 2 == 1), ("b", np.arange(3000) % 2 == 0)):
        res = np.array([got[k][f"q{i}"] for i in range(100)])
        assert np.allclose(res, np.quantile(vals[sel], probs), atol=1e-9)


def test_values_of_every_size_and_sign(spark):
    """The order of the bits is the order of the doubles."""
    vals = [-1e308, -3.5, -3.4999999999999996, -5e-324, -0.0, 0.0, 5e-324, 2.2250738585072014e-308, 1.0,
            1.0000000000000002, 7.25, 1e308]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    n = len(vals)
    r = exact_percentiles(df, "v", [i / (n - 1) for i in range(n)]).first()
    assert [r[f"q{i}"] for i in range(n)] == vals
    bits = [x.b for x in df.select(ordered_bits(df.v).alias("b"), "v").orderBy("v").collect()]
    assert bits == sorted(bits) and len(set(bits)) == n - 1
    odd = spark.createDataFrame([(1.0,), (float("inf"),), (float("-inf"),), (float("nan"),)], "v double")
    r = exact_percentiles(odd, "v", [0.0, 1 / 3, 2 / 3, 1.0]).first()
    assert (r.q0, r.q1, r.q2) == (float("-inf"), 1.0, float("inf")) and r.q3 != r.q3


def test_empty_and_null_groups(spark):
    df = spark.createDataFrame([("a", None), (None, 1.0)], "k string, v double")
    assert exact_percentiles(df, "v", [0.5], by="k").count() == 0
    assert exact_percentiles(df.limit(0), "v", [0.5]).count() == 0


def test_rows_leave_a_task_as_counts(spark):
    """No exchange of the plan carries the rows: all are below an aggregate,
    a window over counts or the ranks."""
    df = spark.range(20000).selectExpr("id % 3 as k", "cast(id % 7 as double) as v")
    out = _selected(df.select("k", F.col("v").alias("__v"), ordered_bits(F.col("v")).alias("__bits")), ["k"], [0.5],
                    DIGITS)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "lambda" not in plan.split("array_sort")[0]


def test_many_levels_take_the_same_path(spark):
    rng = np.random.default_rng(12)
    vals = np.round(rng.normal(size=3000), 1)
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    probs = [i / 255 for i in range(256)]
    r = exact_percentiles(df, "v", probs).first()
    assert np.allclose([r[f"q{i}"] for i in range(256)], np.quantile(vals, probs), atol=1e-12)


def test_few_values_are_counted_in_one_round(spark, monkeypatch):
    from salescope.operators import quantiles as QU
    seen, selected = [], QU._selected
    monkeypatch.setattr(QU, "_selected", lambda x, keys, probs, digits, *rest: seen.append(tuple(digits)) or selected(
        x, keys, probs, digits, *rest))
    df = spark.createDataFrame([("a", -1.5), ("a", 2.0), ("a", 7.0), ("b", 0.25), ("b", None)], "g string, v double")
    found = []
    for most in (QU.VALUES_AT_ONCE, 0):
        monkeypatch.setattr(QU, "VALUES_AT_ONCE", most)
        rows = QU.exact_percentiles(df, "v", [0.0, 0.5, 0.75], by="g").collect()
        found.append({r.g: (r.q0, r.q1, r.q2) for r in rows})
    assert seen == [(64,), QU.DIGITS]
    assert found[0] == found[1] == {"a": (-1.5, 2.0, 4.5), "b": (0.25, 0.25, 0.25)}
