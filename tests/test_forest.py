import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import DecisionTreeRegressor

from salescope.operators import forest as FO
from salescope.operators import models as MD


def _rows(n=1500, seed=3):
    """A column of many values, one of few, one with zeros and minus, five one-hot."""
    rng = np.random.default_rng(seed)
    kind = rng.integers(0, 5, n)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 4, n), np.where(rng.random(n) < 0.8, 0, rng.normal(size=n)),
                         np.eye(5)[kind]])
    y = 3 * x[:, 0] + x[:, 1] ** 2 + 2 * x[:, 2] + np.array([0, 5, 1, 9, 2])[kind] + rng.normal(size=n)
    return x, np.append(y[:-2], y[:2])


def _frame(spark, x, y, parts=3):
    return spark.createDataFrame([(Vectors.dense(r) if i % 2 else Vectors.sparse(len(r), enumerate(r)), float(t))
                                  for i, (r, t) in enumerate(zip(x, y))], ["features", "y"]).repartition(parts)


def test_a_tree_is_the_tree_of_spark_ml(spark):
    x, y = _rows()
    df = _frame(spark, x, y)
    theirs = DecisionTreeRegressor(labelCol="y", maxDepth=7, minInstancesPerNode=12, maxBins=64).fit(df)
    both = MD.tree_fit(df, label="y", max_depth=7, min_leaf=12, max_bins=64).predict(
        theirs.setPredictionCol("theirs").transform(df)).toPandas()
    assert both["theirs"].nunique() > 30 and np.allclose(both["theirs"], both["prediction"], atol=1e-9)


@pytest.mark.parametrize("bagging", [False, True])
def test_levels_as_jobs_and_waves_give_the_same_trees(spark, monkeypatch, bagging):
    x, y = _rows()
    df = _frame(spark, x, y).persist()
    fits = []
    for rows, size in ((10_000, 1e9), (200, 1.0)):  # one task a tree; levels as jobs, a tree a wave
        monkeypatch.setattr(FO, "LOCAL_ROWS", rows)
        monkeypatch.setattr(FO, "WAVE_BYTES", size)
        fits.append(FO.forest_fit(df, label="y", trees=3, max_depth=6, min_leaf=10, bagging=bagging))
    a, b = [f.score(x) for f in fits]
    assert np.allclose(a, b, atol=1e-9)
    trees = [t.predict(x) for t in fits[0].trees]
    assert (not np.allclose(trees[0], trees[1])) is bagging
    again = FO.ForestFit.of_state(fits[1].state())
    assert again.score(x).tolist() == b.tolist()


def test_rows_of_a_leaf_and_labels_that_are_missing(spark):
    x, y = _rows(400)
    df = _frame(spark, x, y)
    tree = MD.tree_fit(df, label="y", max_depth=20, min_leaf=30).trees[0]
    found = tree.predict(x)
    for v in np.unique(found):
        at = found == v
        assert at.sum() >= 30 and abs(y[at].mean() - v) < 1e-9
    same = MD.forest_fit(_frame(spark, x, np.full(400, 7.0)), label="y", trees=2)
    assert np.allclose(same.score(x), 7.0) and [len(t.value) for t in same.trees] == [1, 1]
    with pytest.raises(ValueError, match="1 rows without a label"):
        MD.forest_fit(df.union(df.limit(1).selectExpr("features", "CAST(NULL AS double)")), label="y")
