from hashlib import sha256

import numpy as np
from helpers import MID, same_as_sql

from salescope.llm import centroids

ROWS = "vec_id long, embedding array<double>, cluster string, distance string, whole int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "c", "d", 1) for i, v in rows], ROWS)


def plain(rows, clusters, rounds, dim):
    """The same in whole numbers of Python."""
    ok = lambda v: v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)
    top = centroids.LARGEST
    vec = [(i, [int(np.floor(max(-top, min(top, 256 * x)))) for x in v]) for i, v in rows if ok(v)]
    key = lambda r: (sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    at = [list(v) for _, v in sorted(vec, key=key)[:clusters]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(at))

    for _ in range(rounds):
        members = {}
        for _, v in vec:
            members.setdefault(near(v)[1], []).append(v)
        for n, of in members.items():
            at[n] = [sum(col) // len(of) for col in zip(*of)]
    got = [(i, *near(v)) for i, v in vec]
    total = {}
    for _, d, n in got:
        total[n] = total.get(n, 0) + d
    return sorted(((i, n, d, total[n], sum(total.values()), sha256(",".join(map(str, at[n])).encode()).hexdigest())
                   for i, d, n in got), key=str)


def rows_of(df):
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256)
                   for r in df.collect()), key=str)


def test_query_is_the_sql(spark):
    same_as_sql(spark, "op12_centroid_clusters", MID)


def test_against_plain_python_with_a_hot_cluster_and_empty_ones(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.concatenate(
        [rng.normal(0.5, 0.01, (100, 3)), rng.normal(-0.5, 1.0, (120, 3))]))]
    got = centroids.cluster_vectors(frame(spark, rows), clusters=9, rounds=3, components=3)
    assert rows_of(got) == plain(rows, 9, 3, 3)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.1, 0.2]), (1, [0.1, 0.2]), (2, None), (3, []), (4, [0.1]), (5, [0.1, None]), (6, [nan, 0.1]),
            (7, [0.1, -inf]), (None, [0.3, -0.3]), (8, [1e300, -1e300]), (9, [-0.0, 0.0]), (10, [0.5, 0.5])]
    got = centroids.cluster_vectors(frame(spark, rows), clusters=4, rounds=2, components=2)
    assert rows_of(got) == plain(rows, 4, 2, 2)
    assert rows_of(centroids.cluster_vectors(frame(spark, rows), clusters=50, rounds=1, components=2)) == plain(
        rows, 50, 1, 2)
    for none in (rows[2:8], []):
        empty = centroids.cluster_vectors(frame(spark, none), clusters=3, components=2)
        assert empty.count() == 0 and empty.columns == got.columns


def test_ties_go_to_the_smaller_number(spark):
    df = spark.createDataFrame([([0, 0],)], "whole array<int>")
    r = df.select(centroids.nearest(df["whole"], [[3, 4], [5, 0], [-5, 0]]).alias("n")).first().n
    assert (r.distance, r.cluster) == (25, 0)


def test_the_plan_stays_in_the_jvm(spark):
    out = centroids.cluster_vectors(frame(spark, [(i, [0.1 * i, 0.2]) for i in range(9)]), clusters=2, components=2)
    assert "Python" not in out._jdf.queryExecution().toString()
