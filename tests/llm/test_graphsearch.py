import numpy as np
import pytest
from helpers import MID

from salescope.llm import graphsearch
from salescope.llm.queries import op13_nearest_neighbours
from salescope.sources.tables import table

ROWS = "vec_id long, embedding array<float>, label int, dim int, shard int, rank string"


def brute(rows, queries, top=20):
    """By all pairs: {query place: [(vec_id, score)]}, ties to smaller ids, null ids last."""
    ok = lambda v: v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    out = []
    for qi, (q, v) in enumerate(queries):
        if q is None or not ok(v):
            continue
        found, own = [], False
        for i, w in rows:
            if not ok(w) or len(w) != len(v):
                continue
            if not own and i == q and list(w) == list(v):
                own = True
                continue
            found.append((-float(np.dot(np.float64(np.float32(v)), np.float64(np.float32(w)))), i is None, i or 0))
        out.append((q, [(None if null else i, -s) for s, null, i in sorted(found)[:top]]))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 9, 9, "r") for i, v in rows], ROWS)


def answers(df):
    got = {}
    for r in df.collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(x, key=lambda t: t[0]) for q, x in got.items()}


def recall(got, want):
    hits = [len({i for _, i, _ in got[q]} & {i for i, _ in w}) / len(w) for q, w in want]
    return sum(hits) / len(hits)


def test_whole_table_against_all_pairs(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, MID, "embeddings").collect()]
    want = brute(rows, [(i, v) for i, v in rows if i % 20 == 0])
    got = answers(op13_nearest_neighbours(spark, MID))
    assert sorted(got) == sorted(q for q, _ in want)
    assert recall(got, want) >= 0.99
    vec = {i: np.float64(np.float32(v)) for i, v in rows}
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 21)) and q not in {i for _, i, _ in found}
        assert all(abs(s - vec[q] @ vec[i]) < 1e-12 for _, i, s in found)
        assert found == sorted(found, key=lambda t: (-t[2], t[1]))


def test_several_shards_lengths_and_a_hot_group(spark):
    rng = np.random.default_rng(3)
    centre = rng.standard_normal(24)
    near = centre + 0.05 * rng.standard_normal((700, 24))  # a third of all rows
    rest = rng.standard_normal((1400, 24)) * rng.uniform(0.2, 3, (1400, 1))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.float32(np.concatenate([near, rest])))]
    asked = [r for r in rows if r[0] % 30 == 0]
    frame_ = frame(spark, rows)
    got = answers(graphsearch.nearest_neighbours(frame_, frame(spark, asked), shard=300))
    assert recall(got, brute(rows, asked)) >= 0.95
    index = graphsearch.build_index(frame_, shard=300)
    assert index.count() > 4
    # the graphs hold every row once
    ids = sorted(i for r in index.select("ids").collect() for i in r.ids)
    assert ids == list(range(2100))


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (20, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]),
            (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [2.0, 1.0]), (8, [1.0, 2.0, 3.0]),
            (40, [1.0, 1.0, 1.0]), (None, [1.0, 0.0]), (60, None), (80, [0.0, 0.0]), (9, [-1.0, 3.0]), (100, [-3e38, 3e38])]
    asked = [r for r in rows if r[0] is not None and r[0] % 20 == 0]
    df = graphsearch.nearest_neighbours(frame(spark, rows), frame(spark, asked))
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect() if r.vec_id is not None)
    nulls = [(r.query_id, r["rank"]) for r in df.collect() if r.vec_id is None]
    want = [(q, n + 1, i, s) for q, found in brute(rows, asked) for n, (i, s) in enumerate(found)]
    assert len(got) + len(nulls) == len(want)
    for a, b in zip(got, sorted(x for x in want if x[2] is not None)):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3])
    assert sorted(nulls) == sorted(x[:2] for x in want if x[2] is None)
    empty = frame(spark, []).limit(0)
    assert graphsearch.nearest_neighbours(empty, empty).count() == 0
    assert graphsearch.nearest_neighbours(frame(spark, rows), empty).count() == 0
    assert graphsearch.nearest_neighbours(empty, frame(spark, asked)).count() == 0


def test_many_copies_of_one_vector(spark):
    rows = [(i, [1.0, 2.0]) for i in range(400)] + [(1000 + i, [1.0, 0.001 * i]) for i in range(50)]
    got = answers(graphsearch.nearest_neighbours(frame(spark, rows), frame(spark, rows[:1] + rows[399:400])))
    assert [i for _, i, _ in got[0]] == list(range(1, 21))
    assert [i for _, i, _ in got[399]] == list(range(20))


def test_graph_is_the_same_for_the_same_rows_and_links_thin_out():
    rng = np.random.default_rng(5)
    x = graphsearch.on_sphere(rng.standard_normal((900, 16)), 10.0)
    a, b = graphsearch.build_graph(x), graphsearch.build_graph(x)
    assert a.entry == b.entry and all((p == q).all() for p, q in zip(a.links, b.links))
    assert len(a.links) > 1 and (a.links[0] >= 0).sum(axis=1).min() >= 1
    for links in a.links:
        for i, of in enumerate(links):
            of = of[of >= 0]
            assert i not in of and len(set(of)) == len(of)
