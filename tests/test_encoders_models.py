import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from salescope.operators import boosting as BO
from salescope.operators import models as MD
from salescope.operators.encoders import FeaturePrep, fit_medians, fit_modes


def test_ordinal_codes_numeric_sort_and_unknown(spark):
    train = spark.createDataFrame([(2, "b", 1.0), (9, "a", None), (10, "b", 3.0), (10, None, 5.0)],
                                  "store int, fam string, x double")
    prep = FeaturePrep(["x"], ["store", "fam"], "ordinal").fit(train)
    test = spark.createDataFrame([(10, "a", None), (7, "zz", 1.0)], "store int, fam string, x double")
    rows = prep.transform(test).select(vector_to_array("features").alias("f")).collect()
    assert rows[0]["f"] == [3.0, 2.0, 0.0]   # median of x (1,3,5) imputed; 10 sorts after 9
    assert rows[1]["f"] == [1.0, -1.0, -1.0]  # unknown categories -> -1


def test_onehot_unknown_is_all_zero_and_population_scaling(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("b", 5.0)], "c string, x double")
    prep = FeaturePrep(["x"], ["c"], "onehot").fit(train)
    test = spark.createDataFrame([("zz", 3.0), ("a", 1.0)], "c string, x double")
    rows = prep.transform(test).select(vector_to_array("features").alias("f")).collect()
    sd = np.std([1.0, 3.0, 5.0])  # population std
    assert np.allclose(rows[0]["f"], [0.0, 0.0, 0.0])
    assert np.allclose(rows[1]["f"], [(1.0 - 3.0) / sd, 1.0, 0.0])


def test_median_and_mode(spark):
    df = spark.createDataFrame([(1.0, "x"), (2.0, "y"), (10.0, "y"), (None, "x")], "a double, b string")
    assert fit_medians(df, ["a"]) == {"a": 2.0}
    assert fit_modes(df, ["b"]) == {"b": "x"}  # tie -> smallest


def _xy(spark, n=400, p=5, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, p))
    y = x @ np.arange(1, p + 1) + 3.0 + rng.normal(scale=0.1, size=n)
    df = spark.createDataFrame([tuple(map(float, r)) + (float(t),) for r, t in zip(x, y)],
                               ", ".join(f"x{i} double" for i in range(p)) + ", y double")
    vec = VectorAssembler(inputCols=[f"x{i}" for i in range(p)], outputCol="features").transform(df)
    return x, y, vec.repartition(3)


def test_gram_ridge_matches_closed_form(spark):
    x, y, df = _xy(spark)
    for alpha in (0.0, 10.0):
        fit = MD.gram_fit(df, "features", "y", alpha=alpha)
        z = np.column_stack([np.ones(len(x)), x])
        pen = alpha * np.eye(z.shape[1])
        pen[0, 0] = 0
        w = np.linalg.solve(z.T @ z + pen, z.T @ y)
        assert np.allclose(fit.coef, w[1:], atol=1e-8) and abs(fit.intercept - w[0]) < 1e-8


def test_spark_ridge_mapping_matches_closed_form(spark):
    x, y, df = _xy(spark, seed=1)
    fit = MD.ridge_fit(df, 10.0, label="y")
    z = np.column_stack([np.ones(len(x)), x])
    pen = 10.0 * np.eye(z.shape[1])
    pen[0, 0] = 0
    w = np.linalg.solve(z.T @ z + pen, z.T @ y)
    assert np.allclose(fit.model.coefficients.toArray(), w[1:], atol=1e-4)


def test_linear_svr_matches_numpy_full_batch(spark):
    x, y, df = _xy(spark, n=300, p=3, seed=2)
    fit = MD.linear_svr_fit(df, "features", "y", epsilon=0.1, learning_rate=0.01, epochs=15, l2=0.001)
    # independent full-batch reference with the same start vector
    w = np.random.default_rng(42).normal(0, 0.01, size=3)
    b = 0.0
    for _ in range(15):
        err = x @ w + b - y
        out = np.abs(err) > 0.1
        sg = np.sign(err[out])
        gw = 0.001 * w + (x[out].T @ sg) / len(x) if out.any() else 0.001 * w
        gb = sg.mean() if out.any() else 0.0
        w, b = w - 0.01 * gw, b - 0.01 * gb
    assert np.allclose(fit.coef, w, atol=1e-10) and abs(fit.intercept - b) < 1e-10


def test_mlp_beats_mean_baseline(spark):
    x, y, df = _xy(spark, n=2000, p=4, seed=3)
    fit = MD.mlp_fit(df, "features", "y", hidden=16, lr=0.03, epochs=20, batch_size=400)
    pred = fit.predict(df).select("y", "prediction").toPandas()
    mse = np.mean((pred.y - pred.prediction) ** 2)
    assert mse < np.var(y) * 0.5
    assert fit.loss_history[-1] < fit.loss_history[0]


def test_mlp_does_not_depend_on_partitions(spark):
    _, _, df = _xy(spark, n=600, p=3, seed=4)
    runs = [MD.mlp_fit(df.repartition(n), "features", "y", hidden=8, epochs=3, batch_size=200) for n in (1, 4, 16)]
    for r in runs[1:]:
        assert np.allclose(r.loss_history, runs[0].loss_history, rtol=1e-9)
        assert np.allclose(r.theta, runs[0].theta, rtol=1e-7, atol=1e-9)


def test_a_step_runs_on_its_mini_batch_alone(spark):
    """Tasks of a step: the partitions of one mini-batch; an epoch reads each once."""
    steps, spread = 7, 3
    parts = [p for b in range(steps) for p in MD.batch_partitions(b, steps, spread)]
    assert sorted(parts) == list(range(steps * spread))
    assert MD.batch_partitions(5000, 10_000, 1) == [5000 - MD.MAX_PARTITIONS]
    _, _, df = _xy(spark, n=400, p=3, seed=4)
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    sc.setJobGroup("mlp", "mlp")
    MD.mlp_fit(df, "features", "y", hidden=4, epochs=2, batch_size=50)
    last = [tracker.getStageInfo(max(tracker.getJobInfo(j).stageIds)) for j in sorted(tracker.getJobIdsForGroup("mlp"))]
    sc.setJobGroup("rest", "rest")
    assert [s.numTasks for s in last[-16:]] == [1] * 16  # 2 epochs of 8 steps


def test_constant_models_of_an_empty_table(spark):
    _, _, df = _xy(spark, n=5)
    for fit in (MD.mean_fit(df.limit(0), "y"), MD.median_fit(df.limit(0), "y")):
        assert [r.prediction for r in fit.predict(df.limit(2)).collect()] == [None, None]


def _plain_lasso_objective(x, y, w, b, alpha):
    return ((y - x @ w - b) ** 2).mean() / 2 + alpha * np.abs(w).sum()


def test_sparse_system_is_the_dense_one_and_serves_the_lasso(spark):
    from salescope.operators import gram as GR
    rng = np.random.default_rng(0)
    rows = [(float(v), float(rng.integers(5)), f"c{rng.integers(6)}" if i % 9 else None, f"d{rng.integers(3)}")
            for i, v in enumerate(rng.normal(size=500))]
    rows = [(*r, 2 * r[0] + (r[2] == "c1") * 3 - (r[3] == "d0") + float(rng.normal())) for r in rows]
    train = spark.createDataFrame(rows, "a double, b double, c string, d string, y double").repartition(3)
    prep = FeaturePrep(["a", "b"], ["c", "d"], "onehot").fit(train)
    vectors = prep.transform(train).persist()
    system = GR.prepared_system(prep, train, "y")
    assert np.allclose(system.gram, MD.gram_system(vectors, "features", "y").gram, atol=1e-9)
    got = vectors.select(vector_to_array("features").alias("x"), "y", "features",
                         GR.prepared_prediction(prep, system.solve(1.0)).alias("p")).toPandas()
    x, y = np.stack(got.x), got.y.to_numpy()
    assert np.allclose(got.p, x @ system.solve(1.0).coef + system.solve(1.0).intercept)
    for alpha in (0.0, 0.01, 0.3, 100.0):  # collinear columns: many solutions, one least value
        fit = system.lasso(alpha)
        best = _plain_lasso_objective(x, y, fit.coef, fit.intercept, alpha)
        assert fit.gap <= 1e-8
        for _ in range(200):
            w = fit.coef + rng.normal(scale=10.0 ** rng.integers(-6, 0), size=len(fit.coef))
            assert _plain_lasso_objective(x, y, w, (y - x @ w).mean(), alpha) >= best - 1e-7 * y.var()
    assert (system.lasso(100.0).coef == 0).all()
    # a NULL category is in no column, an unknown one weighs nothing, no rows no entries
    assert GR.sparse_gram(train.limit(0), ["a"], ["c"], "y").count() == 0
    test = spark.createDataFrame([(0.5, 1.0, "zz", "d1")], "a double, b double, c string, d string")
    r = prep.transform(test).select(vector_to_array("features").alias("x"),
                                    GR.prepared_prediction(prep, system.solve(1.0)).alias("p")).first()
    assert abs(r.p - (np.array(r.x) @ system.solve(1.0).coef + system.solve(1.0).intercept)) < 1e-9


def test_mlp_gradient_against_differences():
    rng = np.random.default_rng(0)
    p, hidden = 3, 4
    theta = rng.normal(size=(p + 1) * hidden + hidden + 1)
    x, y = rng.normal(size=(20, p)), rng.normal(size=20)
    got = MD._loss_gradient(theta, p, hidden, x, y)[:-2]
    half = lambda t: 0.5 * MD._loss_gradient(t, p, hidden, x, y)[-2]
    for i in range(len(theta)):
        step = np.zeros_like(theta)
        step[i] = 1e-6
        assert abs((half(theta + step) - half(theta - step)) / 2e-6 - got[i]) < 1e-4


def test_gram_width_is_checked(spark, monkeypatch):
    _, _, df = _xy(spark, n=20, p=5)
    monkeypatch.setattr(MD, "MAX_GRAM_WIDTH", 6)
    try:
        MD.gram_fit(df, "features", "y")
        raise AssertionError("no error")
    except ValueError as e:
        assert "7 columns" in str(e)


def test_gram_fit_from_another_folder(tmp_path):
    """Workers need no installed package: started outside the repository."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from salescope.session import local_session
spark = local_session(1)
from pyspark.ml.feature import VectorAssembler
from salescope.operators import boosting as BO
from salescope.operators import models as MD
df = VectorAssembler(inputCols=["x"], outputCol="features").transform(
    spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(20)], "x double, y double"))
fit = MD.gram_fit(df, "features", "y")
print("FIT", round(fit.coef[0], 6), round(fit.intercept, 6))
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"SALESCOPE_DRIVER_MEMORY": "1g"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert "FIT 2.0 1.0" in out.stdout, out.stderr[-2000:]


def test_lasso_matches_coordinate_descent(spark):
    x, y, df = _xy(spark, n=300, p=4, seed=5)
    alpha = 0.3
    w = np.zeros(4)
    xc, yc = x - x.mean(axis=0), y - y.mean()
    for _ in range(500):
        for j in range(4):
            r = yc - xc @ w + xc[:, j] * w[j]
            rho = xc[:, j] @ r / len(y)
            w[j] = np.sign(rho) * max(abs(rho) - alpha, 0) / (xc[:, j] @ xc[:, j] / len(y))
    fit = MD.lasso_fit(df, alpha, label="y")
    assert np.allclose(fit.coef, w, atol=1e-8) and 0 <= fit.gap <= 1e-8


def test_poisson_matches_newton(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 2))
    y = rng.poisson(np.exp(0.4 * x[:, 0] - 0.2 * x[:, 1] + 1.0)).astype(float)
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(spark.createDataFrame(
        [(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, y double"))
    alpha = 0.01
    z, w = np.column_stack([np.ones(400), x]), np.zeros(3)
    pen = alpha * np.diag([0.0, 1.0, 1.0])
    for _ in range(50):  # mean half deviance + alpha / 2 |w|^2
        mu = np.exp(z @ w)
        w = w - np.linalg.solve(z.T @ (z * mu[:, None]) / 400 + pen, z.T @ (mu - y) / 400 + pen @ w)
    fit = MD.poisson_fit(df, alpha, label="y")
    assert np.allclose([fit.model.intercept, *fit.model.coefficients.toArray()], w, atol=5e-3)


def test_iteration_limits_are_errors(spark):
    _, _, df = _xy(spark, n=100, p=4, seed=7)
    for fit in (lambda: MD.gram_system(df, "features", "y").lasso(0.01, tol=-1.0, max_steps=1),
                lambda: MD.poisson_fit(df.withColumn("y", F.abs("y")), 0.01, label="y", max_iter=1)):
        try:
            fit()
            raise AssertionError("no error")
        except RuntimeError as e:
            assert "converge" in str(e)


def test_boosted_trees_and_forests_beat_the_mean(spark):
    x, y, df = _xy(spark, n=800, p=3, seed=8)
    for fit in (BO.boost_fit(df, label="y", iters=20), MD.tree_fit(df, label="y", max_depth=6, min_leaf=5),
                MD.forest_fit(df, label="y", trees=5, max_depth=6, min_leaf=5)):
        pred = fit.predict(df).select("y", "prediction").toPandas()
        assert np.mean((pred.y - pred.prediction) ** 2) < 0.5 * np.var(y)


def test_code_table_over_many_ranges(spark):
    from salescope.operators.encoders import code_table
    values = [f"v{i:04d}" for i in range(500)]
    df = spark.createDataFrame([(v,) for v in values[::-1]], "c string").repartition(7)
    got = {r["c"]: r["c__code"] for r in code_table(df, "c").collect()}
    assert got == {v: i for i, v in enumerate(values)}


def test_medians_only_where_a_table_has_nulls(spark):
    train = spark.createDataFrame([(1.0, 5.0, "a"), (3.0, 7.0, "b")], "x double, z double, c string")
    test = spark.createDataFrame([(None, 6.0, "a")], "x double, z double, c string")
    prep = FeaturePrep(["x", "z"], ["c"], "ordinal").fit(train, others=[test])
    assert prep.medians == {"x": 2.0}
    assert prep.transform(test).select(vector_to_array("features").alias("f")).first()["f"] == [2.0, 6.0, 0.0]


def test_svr_blocks_hold_the_ones_of_one_hot_columns(spark):
    import pickle
    from pyspark.ml.linalg import Vectors
    rng = np.random.default_rng(12)
    n, p = 600, 80
    x = np.zeros((n, p))
    x[:, :2] = rng.normal(size=(n, 2))
    x[np.arange(n), rng.integers(2, p, n)] = 1.0
    x[0] = 0.0
    y = x[:, 0] - x[:, 5] + 0.1 * rng.normal(size=n)
    df = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, y)], ["features", "y"])
    kept = MD.split_blocks(df, "features", "y")
    assert sum(kept.map(lambda b: len(pickle.dumps(b))).collect()) < 0.2 * x.nbytes
    kept.unpersist()
    fit = MD.linear_svr_fit(df, "features", "y", epochs=30)
    w, b = np.random.default_rng(42).normal(0, 0.01, size=p), 0.0
    for _ in range(30):
        err = x @ w + b - y
        sign = np.sign(err) * (np.abs(err) > 0.1)
        w, b = w - 0.03 * (0.001 * w + x.T @ sign / n), b - 0.03 * sign.sum() / max(np.count_nonzero(sign), 1)
    assert np.allclose(fit.coef, w, atol=1e-12) and np.isclose(fit.intercept, b)


def test_svr_over_columns_reads_few_rows_between_passes(spark, monkeypatch):
    rng = np.random.default_rng(4)
    n = 3000
    x, kind, other = rng.normal(size=(n, 2)), rng.integers(0, 4, n), rng.integers(0, 3, n)
    y = x @ [0.5, -0.2] + kind * 0.3 + rng.normal(scale=0.5, size=n)
    df = spark.createDataFrame([(*map(float, r), float(k), float(o), float(t)) for r, k, o, t in zip(x, kind, other, y)],
                               "a double, b double, k double, o double, y double").repartition(3)
    wide = np.column_stack([x, np.eye(4)[kind][:, :3], np.eye(3)[other]])  # a code of 3 is none of k's three
    read, times = [0], MD._times
    monkeypatch.setattr(MD, "_summed", lambda rdd, f: sum(map(f, rdd.collect()), 0.0))
    monkeypatch.setattr(MD, "_times", lambda cells, w, m: (read.__setitem__(0, read[0] + m), times(cells, w, m))[1])
    fit = MD.linear_svr_fit(df, label="y", epochs=200, columns=(["a", "b"], [("k", 3), ("o", 3)]))
    w, b = np.random.default_rng(42).normal(0, 0.01, size=8), 0.0
    for _ in range(200):
        err = wide @ w + b - y
        sign = np.sign(err) * (np.abs(err) > 0.1)
        loss = np.maximum(np.abs(err) - 0.1, 0).mean()
        w, b = w - 0.03 * (0.001 * w + wide.T @ sign / n), b - 0.03 * sign.sum() / np.count_nonzero(sign)
    assert np.allclose(fit.coef, w, atol=1e-9) and abs(fit.intercept - b) < 1e-9
    assert abs(fit.loss_history[-1] - loss - 0.0005 * (w @ w)) < 1e-9
    assert 0 < read[0] < 0.8 * n * 200  # by the epochs (passes that set rows apart run elsewhere)
