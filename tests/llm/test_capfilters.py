import numpy as np
import pytest
from helpers import MID, SF, components, same_as_sql

from salescope.llm import capfilters

ROWS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("sf", [SF, MID])
def test_same_as_sql(spark, sf):
    same_as_sql(spark, "op9_cap_filter_links", sf)


def clusters(rng, groups, members, dim, noise):
    out = []
    for g in range(groups):
        centre = rng.standard_normal(dim)
        for _ in range(members):
            out.append((centre + noise * rng.standard_normal(dim)).astype(np.float32))
    return out


def brute(rows, threshold=0.93):
    x = np.array([r[1] for r in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    same = np.array([r[2] for r in rows])
    hit = (x @ x.T >= threshold) & (same[:, None] == same[None, :])
    np.fill_diagonal(hit, False)
    return hit


@pytest.mark.parametrize("part", [512, 40])
def test_recall_and_precision_against_all_pairs(spark, monkeypatch, part):
    """Also with a direction worked off in many parts."""
    monkeypatch.setattr(capfilters, "PART", part)
    rng = np.random.default_rng(4)
    vectors = clusters(rng, 30, 12, 48, 0.27) + clusters(rng, 1, 200, 48, 0.2)
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(vectors)]
    hit = brute(rows)
    out = {r.vec_id: r for r in capfilters.near_vectors(spark.createDataFrame(rows, ROWS)).collect()}
    found, real = sum(r.n_links for r in out.values()), int(hit.sum())
    assert real > 1000 and all(out[i].n_links <= hit[i].sum() for i in out)
    assert found >= 0.99 * real
    low = components(len(rows), list(zip(*np.nonzero(np.triu(hit)))))
    assert np.mean([out[i].component_id == low[i] for i in out]) > 0.99
    assert all(r.kept == (r.vec_id == r.component_id) for r in out.values())


def test_decoding_lists_all_directions_of_a_cap():
    rng = np.random.default_rng(0)
    for dim, vectors in ((6, 50), (24, 400), (64, 100_000)):
        code = capfilters.product_code(dim, vectors)
        if np.prod([len(b) for b in code.books]) > 3_000_000:
            continue
        x = rng.standard_normal((3, dim))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        turned = x @ code.turn
        for row, got in zip(turned, code.decode(x)):
            sums = np.zeros(1)
            for (a, b), book in zip(code.cuts, code.books):
                sums = (sums[:, None] + (row[a:b] @ book.T)[None, :]).ravel()
            want = np.flatnonzero(sums >= code.alpha)
            assert set(got.tolist()) ^ set(want.tolist()) <= set(np.flatnonzero(abs(sums - code.alpha) < 1e-9).tolist())


def test_chance_of_meeting_is_as_planned():
    rng = np.random.default_rng(1)
    code = capfilters.code_family(64, 5000)
    x = rng.standard_normal((300, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.standard_normal((300, 64))
    side -= (side * x).sum(axis=1, keepdims=True) * x
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    y = 0.93 * x + np.sqrt(1 - 0.93 ** 2) * side
    met = [len(np.intersect1d(a, b)) > 0 for a, b in zip(code.decode(x), code.decode(y))]
    assert np.mean(met) > 0.99


def test_odd_rows(spark):
    v = [1.0, 2.0, 3.0, 4.0]
    nan, inf = float("nan"), float("inf")
    rows = [(1, v, 1), (2, [2 * x for x in v], 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [0.0] * 4, 1),
            (7, [1.0, None, 3.0, 4.0], 1), (8, [1.0, nan, 3.0, 4.0], 1), (9, [inf, 2.0, 3.0, 4.0], 1),
            (10, [], 1), (11, [1.0, 2.0, 3.0], 1), (None, v, 1), (12, v, 1), (12, v, 1), (13, [-x for x in v], 1)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], f"{ROWS}, node int, dim string")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in capfilters.near_vectors(frame).collect()),
                 key=str)
    want = [(1, 4, 1, True), (2, 4, 1, False), (None, 4, 1, False), (12, 4, 1, False), (12, 4, 1, False)] + [
        (i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11, 13)]
    assert got == sorted(want, key=str)
    assert capfilters.near_vectors(frame.limit(0)).count() == 0
