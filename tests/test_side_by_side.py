import threading

from salescope.plans.modeling import side_by_side


def test_fits_run_side_by_side_in_their_order(spark):
    met = threading.Barrier(2, timeout=60)  # neither ends before the other has begun

    def make(n):
        return lambda: (met.wait(), spark.range(n).count())[1]

    assert side_by_side(spark, [make(3), make(5)]) == [3, 5]
