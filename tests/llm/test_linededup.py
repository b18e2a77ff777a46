import random

import pytest
from helpers import LONG, MID, SF, docs_of, odd_documents, same_as_sql

from salescope.llm import linededup


@pytest.mark.parametrize("sf", [SF, MID])
def test_same_as_sql(spark, sf):
    same_as_sql(spark, "op8_line_dedup", sf)


def brute(texts, min_words):
    """Lines of every run of ``min_words`` words that stands at an earlier place."""
    lines = [[(i, x.strip(" \t\n\x0b\x0c\r")) for i, x in enumerate((t or "").split("\n"))] for t in texts]
    lines = [[x for x in d if x[1]] for d in lines]
    seen, out = set(), []
    gone = [set() for _ in texts]
    for d, seq in enumerate(lines):
        for s in range(len(seq)):
            words = 0
            for e in range(s, len(seq)):
                words += len(seq[e][1].split())
                if words >= min_words:
                    run = tuple(x[1] for x in seq[s:e + 1])
                    if run in seen:
                        gone[d].update(range(s, e + 1))
                    seen.add(run)
    for d, (t, seq) in enumerate(zip(texts, lines)):
        if t is None or not gone[d]:
            out.append(t)
            continue
        drop = set()
        for s in gone[d]:
            drop.add(seq[s][0])
            if s + 1 in gone[d]:  # blank lines inside a run
                drop.update(range(seq[s][0], seq[s + 1][0]))
        out.append("\n".join(x for i, x in enumerate(t.split("\n")) if i not in drop))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_random_texts_against_brute_force(spark, seed):
    rng = random.Random(seed)
    pool = [" ".join(f"{c}{i}" for i in range(n)) for c, n in zip("abcdefgh", (1, 1, 2, 3, 4, 7, 9, 12))]
    texts = []
    for _ in range(60):
        lines = [rng.choice(pool) if rng.random() < 0.8 else f"own {rng.random()}" for _ in range(rng.randint(0, 25))]
        if texts and rng.random() < 0.4:
            other = (rng.choice(texts) or "").split("\n")
            a = rng.randrange(len(other))
            lines[len(lines) // 2:len(lines) // 2] = other[a:a + rng.randint(1, 20)]
        lines = [f" {x}\t" if rng.random() < 0.1 else x for x in lines for _ in range(1)]
        for _ in range(rng.randint(0, 2)):
            lines.insert(rng.randint(0, len(lines)), "")
        texts.append("\n".join(lines))
    out = linededup.dedup_lines(docs_of(spark, [(i, t, "en", "a") for i, t in enumerate(texts)]), min_words=11)
    got = {r.doc_id: r.text for r in out.collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, 11)


def test_passage_kept_once_and_clean_text_untouched(spark):
    passage = "\n".join(" ".join(f"p{i}x{j}" for j in range(20)) for i in range(4))
    own = [" ".join(f"d{k}y{j}" for j in range(60)) for k in range(5)]
    rows = [(k, f"{own[k]}\n{passage}\nAll rights reserved." if k else own[k] + "\nAll rights reserved.", "en", "a")
            for k in range(5)]
    got = {r.doc_id: r for r in linededup.dedup_lines(docs_of(spark, rows)).collect()}
    assert got[0].text == rows[0][1] and got[1].text == rows[1][1]
    for k in (2, 3, 4):
        # the short line goes with the passage that it follows everywhere
        assert got[k].text == own[k] and got[k].removed_lines == 5
        assert [(r.from_line, r.to_line, r.first_doc_id) for r in got[k].removed_runs] == [(1, 5, 1)]


def test_odd_rows(spark):
    rows = odd_documents(LONG)
    docs = docs_of(spark, rows, clashes=True)
    out = linededup.dedup_lines(docs, runs="removed_runs", lines="n_removed")
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append(r.text)
    assert got[2] == [None] and got[3] == [""] and got[4] == [" \t\n\n "]
    assert got[5] == [LONG] and got[6] == [""] and len(got[1]) == 2
    assert set(docs.columns) <= set(out.columns)
    assert linededup.dedup_lines(docs.limit(0)).count() == 0
    # of repeated rows one keeps its lines
    twice = docs_of(spark, [(1, LONG, "en", "a"), (1, LONG, "en", "a"), (None, LONG, "en", "a")])
    assert sorted(len(r.text) for r in linededup.dedup_lines(twice).collect()) == [0, 0, len(LONG)]
