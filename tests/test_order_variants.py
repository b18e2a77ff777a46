import threading
from types import SimpleNamespace

from salescope.operators import models as MD
from salescope.plans import modeling as ML


def test_order_models_are_fitted_side_by_side_in_their_order(spark, monkeypatch):
    met = threading.Barrier(4, timeout=60)  # two models of two variants
    rows = spark.createDataFrame([(1.0, 2.0), (3.0, 5.0)], "Revenue double, x double")
    monkeypatch.setattr(ML, "prepared_vectors", lambda *a: (None, None, rows, rows, rows, rows))
    monkeypatch.setattr(ML, "_fit_order_model", lambda name, *a: (met.wait(), MD.ConstantFit(len(name)), "onehot")[1:])
    made, scored = ML.order_variants(rows, ("Ab", "Abc"), SimpleNamespace(train=rows, test=rows))
    got = [(r.variant, r.model, r.listing_order, r.MAE) for r in made.collect()]
    assert got == [(v, m, i, mae) for v in ML.VARIANTS for i, (m, mae) in enumerate([("Ab", 1.0), ("Abc", 1.0)])]
    assert set(scored) == {(v, m) for v in ML.VARIANTS for m in ("Ab", "Abc")}
