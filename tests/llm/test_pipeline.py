import corpus_pipeline as P
import pytest
from helpers import LONG, SF, docs_of, odd_documents
from test_decontam import plain
from test_linededup import brute
from test_simhash import brute_groups, plain_simhash

from salescope.llm.common import keep
from salescope.sources.tables import table


@pytest.fixture(scope="module")
def steps(spark):
    docs = table(spark, SF, "documents")
    out = [docs]
    for name, stage in P.STAGES:
        docs = keep(stage(spark, docs, SF), f"test-{name}")
        out.append(docs)
    return out


def by_id(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_stages_and_their_columns(steps):
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "simhash_near_dedup",
                                        "benchmark_decontamination", "source_mixing"]
    for s in steps[1:-1]:
        assert s.columns == steps[0].columns and s.dtypes == steps[0].dtypes


def test_language_id_keeps_nearly_all_texts(steps):
    before, after = by_id(steps[0]), by_id(steps[1])
    assert set(after) <= set(before) and len(after) > 0.95 * len(before)
    assert all(after[i] == before[i] for i in after)


def test_line_dedup_against_brute_force(steps):
    before, after = by_id(steps[1]), by_id(steps[2])
    ids = sorted(before)
    want = dict(zip(ids, brute([before[i].text for i in ids], 50)))
    want = {i: t for i, t in want.items() if t == before[i].text or t.strip()}
    assert {i: r.text for i, r in after.items()} == want
    assert all(r.n_chars == len(r.text) for i, r in after.items() if r.text != before[i].text)


def test_one_document_of_each_group_stays(steps):
    before, after = by_id(steps[2]), by_id(steps[3])
    ids = sorted(before)
    groups = brute_groups(ids, [plain_simhash(before[i].text) for i in ids], 2)
    assert set(after) == set(groups)


def test_leaks_go_and_nothing_else(spark, steps):
    before, after = by_id(steps[3]), by_id(steps[4])
    items = [plain(r.text) for r in table(spark, SF, "benchmark").collect()]
    leaks = {i for i, r in before.items() if any(p in plain(r.text) for p in items)}
    assert not leaks & set(after) and len(after) >= len(before) - len(leaks) - 2
    assert all(after[i] == before[i] for i in after)


def test_mix(steps):
    before, after = by_id(steps[4]), by_id(steps[5])
    assert set(after) <= set(before) and all(r.copies in (1, 2) for r in after.values())
    total = sum(len((r.text or "").split()) for r in before.values())
    assert sum(r.taken for r in after.values()) == pytest.approx(1.5 * total, rel=0.05)


def test_odd_rows_through_all_stages(spark):
    english = [(100 + i, f"these are the words of the plain english text number {i} of all of them", "en", "a")
               for i in range(60)]
    for rows in (odd_documents(LONG) + english, []):
        docs = keep(docs_of(spark, rows, clashes=True), "odd")
        for name, stage in P.STAGES:
            columns = docs.columns
            docs = keep(stage(spark, docs, SF), f"odd-{name}")
            if name != "source_mixing":
                assert docs.columns == columns
        assert docs.count() <= len(rows)


def test_pipeline_is_registered():
    import __spark_entry__ as E
    names = [n for n in E.queries() if n.startswith("op") and n[2].isdigit()]
    assert len(names) == 13 and "pipeline" in E.queries()
