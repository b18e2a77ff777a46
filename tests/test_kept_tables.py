import numpy as np

from salescope.operators import gram as GR
from salescope.session import materialize


def test_a_kept_table_is_dealt_to_files(spark):
    kept = materialize(spark.range(10).coalesce(1), "dealt", rows_a_file=4)
    assert len(kept.inputFiles()) == 3 and sorted(r.id for r in kept.collect()) == list(range(10))


def test_numeric_entries_are_sums_of_products(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (4.0, 5.0, None), (0.5, -1.0, 2.0)], "p double, q double, y double").repartition(2)
    made = GR.sparse_gram(df, ["p", "q"], [], "y")
    assert "MapInPandas" in made._jdf.queryExecution().executedPlan().toString()
    z = np.array([[1, 1, 2, 3], [1, 4, 5, 0], [1, 0.5, -1, 2]])
    want, names = z.T @ z, ["1", "p", "q", "y"]
    assert {(r.a, r.b): r.value for r in made.collect()} == {
        (names[i], names[j]): want[i, j] for i in range(4) for j in range(i, 4)}
