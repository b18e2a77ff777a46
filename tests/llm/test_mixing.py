from collections import defaultdict

import pytest
from helpers import LONG, MID, SF, docs_of, odd_documents, same_as_sql

from salescope.llm import mixing


@pytest.mark.parametrize("sf", [SF, MID])
def test_same_as_sql(spark, sf):
    same_as_sql(spark, "op2_pareto_mix", sf)


def test_targets_are_shared_again_until_none_is_above(spark):
    sizes = {"a": 1000, "b": 10, "c": 400, "d": 3000, None: 50}
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "__source string, __size long")
    got = {r["__source"]: r["__target"] for r in mixing.source_targets(rows).collect()}
    weights = dict(zip(["a", "b", "c", "d", None], (5, 2, 1, 5, 2)))
    target, total = {}, 1.5 * sum(sizes.values())
    while True:  # excess by weight, again and again
        free = [s for s in sizes if s not in target]
        left = total - sum(target.values())
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        above = [s for s in free if share[s] > 2 * sizes[s]]
        if not above:
            target |= share
            break
        target |= {s: 2 * sizes[s] for s in above}
    assert got == pytest.approx(target)


def test_words_taken_come_near_the_targets(spark):
    rows = [(i, " ".join(["w"] * (1 + i * i % 97)), "en", f"s{i % 3 if i % 4 else 0}") for i in range(4000)]
    out = mixing.mix_sources(docs_of(spark, rows)).collect()
    taken, target = defaultdict(int), {}
    for r in out:
        assert r.copies in (0, 1, 2) and r.taken == r.copies * r.size <= 2 * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    for s, t in target.items():
        assert abs(taken[s] - t) <= 0.01 * t
    again = mixing.mix_sources(docs_of(spark, rows)).collect()
    assert sorted((r.doc_id, r.taken) for r in out) == sorted((r.doc_id, r.taken) for r in again)


def test_inclusion_follows_each_documents_own_probability(spark):
    """Many sources of the same make: how often a document of each size is
    taken is its probability, which differs by size and is 1 for the largest."""
    sizes = [3, 5, 8, 8, 13, 21, 21, 34, 55, 200]
    rows = [(s * 1000 + i, " ".join(["w"] * n), "en", f"s{s:03d}") for s in range(40) for i, n in enumerate(sizes * 80)]
    out = mixing.mix_sources(docs_of(spark, rows), weights=(1,), share=0.7, ceiling=1).collect()
    c = (0.7 * sum(sizes) - 200) / sum(n * n for n in sizes if n < 200)
    taken, number = defaultdict(int), defaultdict(int)
    for r in out:
        assert r.inclusion == pytest.approx(1.0 if r.size == 200 else c * r.size)
        taken[r.size] += r.copies
        number[r.size] += 1
    assert len({round(r.inclusion, 9) for r in out}) == len(set(sizes))
    for r in {r.size: r for r in out}.values():
        assert abs(taken[r.size] / number[r.size] - r.inclusion) < 0.03


def test_with_equal_odds_another_sample_is_drawn(spark, monkeypatch):
    rows = [(i, " ".join(["w"] * (1 + i % 40)), "en", "s") for i in range(800)]
    draw = lambda: {r.doc_id for r in mixing.mix_sources(
        docs_of(spark, rows), weights=(1,), share=0.4).collect() if r.copies}
    unequal = draw()
    monkeypatch.setattr(mixing, "inclusion", lambda: mixing.F.lit(0.4))
    equal = draw()
    mean = lambda ids: sum(1 + i % 40 for i in ids) / len(ids)
    assert unequal != equal and mean(unequal) > 1.15 * mean(equal)


def test_rows_that_repeat_are_taken_one_by_one(spark):
    """A third of a source is one row, repeated: a part of it fills the gap."""
    rows = [(1, "a b c", "en", "s")] * 300 + [(i, "d e f", "en", "s") for i in range(2, 602)]
    out = mixing.mix_sources(docs_of(spark, rows), weights=(1,), share=0.5).collect()
    assert abs(sum(r.taken for r in out) - 1350) <= 3


def test_no_rank_is_favoured(spark):
    """Inclusion does not hang on a document's place or id."""
    rows = [(i, "a b c", "en", "s" if i % 2 else "t") for i in range(6000)]
    out = mixing.mix_sources(docs_of(spark, rows), weights=(3, 1), share=0.5, ceiling=2).collect()
    by_half = defaultdict(int)
    for r in out:
        by_half[r.source, r.doc_id < 3000] += r.copies
    for s in "st":
        assert abs(by_half[s, True] - by_half[s, False]) < 150


def test_odd_rows(spark):
    rows = odd_documents(LONG)
    out = mixing.mix_sources(docs_of(spark, rows, clashes=True)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.size == len((r.text or "").split()) and r.taken <= 2 * r.size
    assert mixing.mix_sources(docs_of(spark, [])).count() == 0
    only = mixing.mix_sources(docs_of(spark, [(1, None, None, None), (2, "", "en", "a")])).collect()
    assert [r.taken for r in only] == [0, 0] and [r.target for r in only] == [0.0, 0.0]
