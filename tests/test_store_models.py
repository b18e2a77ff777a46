import datetime
import itertools

import numpy as np
import pytest

from salescope.operators import boosting as BO
from salescope.operators import models as MD
from salescope.operators.encoders import FeaturePrep
from salescope.plans import modeling as ML
from salescope.plans import q_models as Q
from salescope.plans import store_sales as S


def jobs(spark, name, make):
    spark.sparkContext.setJobGroup(name, "")
    made = make()
    spark.sparkContext._jsc.clearJobGroup()
    return made, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_steps_of_a_small_network_are_no_jobs(spark):
    rng = np.random.default_rng(3)
    from pyspark.ml.linalg import Vectors
    rows = [(Vectors.dense(x), float(x[0] - x[1])) for x in rng.normal(size=(300, 3))]
    df = spark.createDataFrame(rows, ["features", "y"]).repartition(3)

    def fit(epochs, cells=2000):
        return MD.mlp_fit(df, "features", "y", hidden=4, epochs=epochs, batch_size=50, task_cells=cells)

    inside, few = jobs(spark, "mlp-2", lambda: fit(2))
    _, more = jobs(spark, "mlp-8", lambda: fit(8))
    assert more == few
    spread, many = jobs(spark, "mlp-jobs", lambda: fit(2, 1000))  # a larger table than that
    assert many > few and np.allclose(spread.theta, inside.theta, atol=1e-12)
    assert np.allclose(spread.loss_history, inside.loss_history)


def test_leaves_below_every_node_that_is_reached():
    tree = BO.Tree()
    for _ in range(7):
        tree.add(0.0)
    for i, (a, b) in {0: (1, 2), 1: (3, 4), 4: (5, 6)}.items():
        tree.feature[i], tree.left[i], tree.right[i] = 0, a, b
    assert BO._leaves_below(tree) == {0: [3, 5, 6, 2], 1: [3, 5, 6], 2: [2], 3: [3], 4: [5, 6], 5: [5], 6: [6]}
    tree.feature[1] = -1
    assert BO._leaves_below(tree) == {0: [1, 2], 1: [1], 2: [2]}


def test_shared_columns_are_fitted_once(spark, monkeypatch):
    from salescope.operators import encoders as E
    rows = spark.createDataFrame([(1.0, 2.0, "b"), (None, 5.0, "a"), (4.0, None, "b")], "x double, z double, c string")
    base = FeaturePrep(["x"], ["c"], "ordinal").fit(rows)
    alone = FeaturePrep(["x", "z"], ["c"], "ordinal").fit(rows)
    asked = []
    medians, modes, tables = E.fit_medians, E.fit_modes, E.fit_code_tables
    monkeypatch.setattr(E, "fit_medians", lambda t, c: (asked.append(list(c)), medians(t, c))[1])
    monkeypatch.setattr(E, "fit_modes", lambda t, c: (asked.append(list(c)), modes(t, c))[1])
    monkeypatch.setattr(E, "fit_code_tables", lambda t, c: (asked.append(list(c)), tables(t, c))[1])
    wide = FeaturePrep(["x", "z"], ["c"], "ordinal").fit(rows, like=base)
    assert asked == [["z"], [], []]
    assert wide.medians == alone.medians and wide.modes == alone.modes
    got, want = [{str(r) for r in p.transform(rows).select("features").collect()} for p in (wide, alone)]
    assert got == want


@pytest.fixture
def window(spark):
    rng = np.random.default_rng(8)
    day = datetime.date(2000, 1, 1)
    columns = S.NUMERIC_FEATURES + S.CATEGORICAL_FEATURES
    rows = []
    for i, (store, family) in itertools.product(range(40), [(1, "a"), (2, "b")]):
        x = {c: float(rng.integers(0, 9)) for c in S.NUMERIC_FEATURES}
        x |= {"store_nbr": store, "family": family, "city": f"c{store}", "state": "s", "type": "t", "cluster": store % 2}
        rows.append((day + datetime.timedelta(days=i), float(rng.integers(0, 50)), *[x[c] for c in columns]))
    kinds = [f"{c} double" for c in S.NUMERIC_FEATURES] + ["store_nbr int", "family string", "city string",
                                                           "state string", "type string", "cluster int"]
    return spark.createDataFrame(rows, "date date, sales double, " + ", ".join(kinds)).persist()


def test_models_share_bins_and_imputation(spark, monkeypatch, window):
    models, asked = ML.StoreModels(window, [window]), []
    edges = BO.slot_edges
    monkeypatch.setattr(ML.BO, "slot_edges", lambda *a, **k: (asked.append(1), edges(*a, **k))[1])
    fits = {wide: models._boosted("__y", wide)[1] for wide in (False, True)}
    assert len(asked) == 1
    for wide, fit in fits.items():
        prep, _, train = models._ordinal(wide)
        own = edges(train.where("sales is not null"), drop_ends=True)
        assert len(fit.edges) == len(prep.feature_names())
        assert all(np.array_equal(a, b) for a, b in zip(fit.edges, own, strict=True))


def test_the_winner_scores_the_rows_once(spark, monkeypatch, window):
    models = ML.StoreModels(window, [window])
    monkeypatch.setattr(Q, "_MEMO", {})
    monkeypatch.setattr(Q, "_store", lambda *_: (models, window))
    monkeypatch.setattr(Q, "_store_winner", lambda *_: "Ridge_Scratch")
    scored = Q._store_selected(spark, "x")
    assert scored is Q._store_selected(spark, "x") and scored.storageLevel.useMemory
    assert scored.count() == window.count() and scored.where("residual is null").isEmpty()
