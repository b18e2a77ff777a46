import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from salescope.operators import boosting as BO


def frame(spark, x, y, parts=3):
    rows = [tuple(map(float, r)) + (None if t is None else float(t),) for r, t in zip(x, y)]
    df = spark.createDataFrame(rows, ", ".join(f"x{i} double" for i in range(x.shape[1])) + ", y double")
    return VectorAssembler(inputCols=[f"x{i}" for i in range(x.shape[1])], outputCol="features",
                           handleInvalid="keep").transform(df).repartition(parts)


class PlainTree:
    """Best-first by trying every split of every leaf on the rows themselves."""

    def __init__(self, bins, r, leaves, l2, min_leaf):
        self.rows = [np.arange(len(r))]
        self.splits = 0
        best = lambda at: self.best(bins[at], r[at], l2, min_leaf)
        found = [best(self.rows[0])]
        while len(self.rows) < leaves:
            i = max(range(len(found)), key=lambda k: found[k][0])
            gain, j, b = found[i]
            if gain <= 1e-9:
                break
            at = self.rows[i]
            go = bins[at, j] <= b
            self.rows[i:i + 1] = [at[go], at[~go]]
            found[i:i + 1] = [best(at[go]), best(at[~go])]
        self.value = np.zeros(len(r))
        for at in self.rows:
            self.value[at] = r[at].sum() / (len(at) + l2)

    @staticmethod
    def best(bins, r, l2, min_leaf):
        out = (0.0, -1, -1)
        whole = r.sum() ** 2 / (len(r) + l2)
        for j in range(bins.shape[1]):
            for b in np.unique(bins[:, j])[:-1]:
                go = bins[:, j] <= b
                n = go.sum()
                if n >= min_leaf and len(r) - n >= min_leaf:
                    gain = r[go].sum() ** 2 / (n + l2) + r[~go].sum() ** 2 / (len(r) - n + l2) - whole
                    if gain > out[0] + 1e-12:
                        out = (gain, j, b)
        return out


def data(seed, n=2000, p=4):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, p)), 1)
    x[:, 1] = rng.integers(0, 3, n)
    y = 3 * x[:, 0] + 5 * (x[:, 1] == 2) * x[:, 2] + np.abs(x[:, 3]) + rng.normal(scale=0.1, size=n)
    return x, y


@pytest.mark.parametrize("l2, min_leaf", [(0.0, 1), (5.0, 20)])
def test_same_trees_as_a_plain_best_first_search(spark, l2, min_leaf):
    x, y = data(1)
    fit = BO.boost_fit(frame(spark, x, y), label="y", iters=3, step=0.5, leaves=31, l2=l2, min_leaf=min_leaf)
    bins, r = BO.binned(x, fit.edges), y - y.mean()
    for tree in fit.trees:
        plain = PlainTree(bins, r, 31, l2, min_leaf)
        assert tree.leaves() == 31
        nodes = tree.node_of(bins)
        # the same rows together and the same value
        groups = {frozenset(np.flatnonzero(nodes == n)) for n in np.unique(nodes)}
        assert groups == {frozenset(at) for at in plain.rows}
        assert np.allclose(tree.predict(bins), plain.value, atol=1e-9)
        r = r - 0.5 * plain.value


def test_l2_shrinks_and_pruning_cuts(spark):
    x, y = data(2)
    df = frame(spark, x, y)
    free, tied = [BO.boost_fit(df, label="y", iters=1, leaves=31, l2=v).trees[0] for v in (0.0, 200.0)]
    assert np.abs(tied.value).max() < np.abs(free.value).max()
    cut = BO.boost_fit(df, label="y", iters=1, leaves=31, prune=0.15).trees[0]
    assert 1 < cut.leaves() < 31
    # what is cut saves less than the price a leaf, what stays more
    r = y - y.mean()
    full = BO.boost_fit(df, label="y", iters=1, leaves=31)
    bins = BO.binned(x, full.edges)
    err = lambda t: np.mean((r - t.predict(bins)) ** 2)
    assert err(cut) + 0.15 * cut.leaves() <= err(full.trees[0]) + 0.15 * 31 + 1e-9
    assert BO.boost_fit(df, label="y", iters=1, leaves=31, prune=1e9).trees[0].leaves() == 1


def test_the_same_for_any_partitions_and_it_learns(spark, monkeypatch):
    monkeypatch.setattr(BO, "ROWS_PER_PARTITION", 100)
    monkeypatch.setattr(BO, "CHECKPOINT_EVERY", 3)
    x, y = data(3)
    runs = [BO.boost_fit(frame(spark, x, y, n), label="y", iters=8, step=0.3) for n in (1, 5)]
    assert np.allclose(runs[0].score(x), runs[1].score(x), atol=1e-9)
    assert np.mean((runs[0].score(x) - y) ** 2) < 0.1 * np.var(y)
    got = runs[0].predict(frame(spark, x, y)).select("x0", "x1", "x2", "x3", "prediction").toPandas()
    assert np.allclose(runs[0].score(got[["x0", "x1", "x2", "x3"]].to_numpy()), got["prediction"])
    weights = runs[0].importances()
    assert abs(weights.sum() - 1) < 1e-9 and weights.argmax() == 0
    again = BO.BoostFit.of_state(__import__("json").loads(__import__("json").dumps(runs[0].state())))
    assert (again.score(x) == runs[0].score(x)).all()


def test_odd_tables(spark):
    x = np.array([[1.0, np.nan], [1.0, 2.0], [1.0, 3.0], [1.0, 9.0]])
    fit = BO.boost_fit(frame(spark, x, [5.0, 2.0, 5.0, None], 2), label="y", iters=2, step=1.0)
    assert np.allclose(fit.score(x[:3]), [5.0, 2.0, 5.0])
    same = BO.boost_fit(frame(spark, x, [3.0] * 4, 1), label="y", iters=2)
    assert all(t.leaves() == 1 for t in same.trees) and np.allclose(same.score(x), 3.0)
    none = frame(spark, x, [3.0] * 4, 1).limit(0)
    assert BO.boost_fit(none, label="y").score(np.zeros((2, 0))).tolist() == [0.0, 0.0]
    # a column with two values: an edge unless both ends are dropped
    two = frame(spark, np.array([[0.0]] * 300 + [[1.0]] * 300), [1] * 600)
    assert [list(e) for e in BO.slot_edges(two)] == [[1.0]]
    assert [list(e) for e in BO.slot_edges(two, drop_ends=True)] == [[]]


def test_early_stopping_on_rows_held_back(spark, monkeypatch):
    monkeypatch.setattr(BO, "STOP_ROWS", 500)
    x, y = data(5)
    noise = np.random.default_rng(6).normal(size=len(x))
    short = BO.boost_fit(frame(spark, x, noise), label="y", iters=40, step=0.3, stop_after=3)
    assert 3 <= len(short.trees) < 20  # nothing to learn: ends soon
    learns = BO.boost_fit(frame(spark, x, y), label="y", iters=12, step=0.3, stop_after=3)
    assert len(learns.trees) == 12
    # the rows held back: about a tenth, the same for any partitions, no part of a tree
    again = BO.boost_fit(frame(spark, x, y, 5), label="y", iters=12, step=0.3, stop_after=3)
    assert np.allclose(again.score(x), learns.score(x), atol=1e-9)
    monkeypatch.setattr(BO, "STOP_ROWS", 10_000)
    assert len(BO.boost_fit(frame(spark, x, noise), label="y", iters=15, step=0.3, stop_after=3).trees) == 15


def test_progress_is_any_loss_below_the_one_before_the_window():
    assert not BO.no_progress([3.0, 2.0, 1.0], 3)
    assert not BO.no_progress([3.0, 3.0, 3.0, 2.9], 3)
    assert BO.no_progress([3.0, 3.0, 3.1, 3.0], 3)
    assert BO.no_progress([9.0, 3.0, 3.0, 3.1, 3.0 - 1e-9], 3)


def test_rounds_of_a_small_table_are_no_jobs(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 9, (900, 2)).astype(float)
    df = frame(spark, x, x[:, 0] * 3 + x[:, 1] ** 2, 2)
    tracker = spark.sparkContext.statusTracker()

    def fit(iters):
        spark.sparkContext.setJobGroup(f"boost-{iters}-{BO.ROWS_PER_PARTITION}", "")
        made = BO.boost_fit(df, label="y", iters=iters, step=0.3, leaves=8)
        return made.state(), len(tracker.getJobIdsForGroup(f"boost-{iters}-{BO.ROWS_PER_PARTITION}"))

    fit(1)  # bin edges are kept from here on
    (few, jobs_few), (many, jobs_many) = fit(2), fit(12)
    assert jobs_many == jobs_few and many["trees"][:2] == few["trees"]
    monkeypatch.setattr(BO, "ROWS_PER_PARTITION", 450)  # two partitions: the rounds are jobs
    spread, jobs_spread = fit(12)
    assert jobs_spread > jobs_many + 12
    for a, b in zip(many["trees"], spread["trees"], strict=True):
        assert a["feature"] == b["feature"] and a["at"] == b["at"] and np.allclose(a["value"], b["value"], atol=1e-9)
    spark.sparkContext._jsc.clearJobGroup()


def test_given_edges_are_not_looked_for_again(spark, monkeypatch):
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame([(Vectors.dense([float(i)]), float(i > 3)) for i in range(8)], ["features", "y"])
    edges = BO.slot_edges(df)
    plain = BO.boost_fit(df, label="y", iters=3, step=0.5, leaves=2)
    monkeypatch.setattr(BO, "slot_edges", None)
    given = BO.boost_fit(df, label="y", iters=3, step=0.5, leaves=2, edges=edges)
    assert given.state() == plain.state()
