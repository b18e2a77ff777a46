import random

import numpy as np
from helpers import LONG, SF, docs_of, odd_documents

from salescope.llm import codes, decontam
from salescope.llm.queries import op3_benchmark_matches
from salescope.sources.tables import table

TABLE = codes.char_table(True)


def plain(text):
    c, _, _ = codes.normalise([text or ""], TABLE)
    return c.tobytes().decode("utf-32-le").strip()


def sellers(item, text):
    """Fewest edits of item against any substring of text, in full."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_all_exact_occurrences_and_only_matches_within_budget(spark):
    docs = {r.doc_id: plain(r.text) for r in table(spark, SF, "documents").collect()}
    items = {r.item_id: plain(r.text) for r in table(spark, SF, "benchmark").collect()}
    found = {(r.doc_id, r.item_id): r.edits for r in op3_benchmark_matches(spark, SF).collect()}
    exact = {(d, i) for d, t in docs.items() for i, p in items.items() if p in t}
    assert exact and {k for k, e in found.items() if e == 0} == exact
    for (d, i), edits in found.items():
        assert edits <= 0.05 * len(items[i])
        if edits:
            assert sellers(items[i], docs[d]) == edits


def mutate(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[at] = rng.choice("abcdefghij")
        elif kind == 1:
            del chars[at]
        else:
            chars.insert(at, rng.choice("abcdefghij"))
    return "".join(chars)


def test_no_occurrence_within_the_budget_is_lost():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    items = [" ".join(word() for _ in range(n)) for n in (4, 12, 20, 40, 60)]
    block = decontam.make_block(list(enumerate(items)))
    texts, truth = [], []
    for trial in range(60):
        k = trial % len(items)
        budget = int(block.edits[k])
        text = " ".join(word() for _ in range(30)) + " " + mutate(
            rng, items[k], rng.randint(0, budget)) + " " + " ".join(word() for _ in range(30))
        texts.append(text)
        truth.append([(i, sellers(plain(p), plain(text))) for i, p in enumerate(items)])
    for got, want in zip(decontam.search(block, texts), truth):
        assert {(m["item"], m["edits"]) for m in got} == {
            (i, e) for i, e in want if e <= block.edits[i]}


def test_long_texts_in_pieces(monkeypatch):
    block = decontam.make_block([(7, "One benchmark passage, quite long enough to be looked for here.")])
    text = "filler words " * 40 + "one BENCHMARK passage -- quite long enough to be looked for here" + " more" * 50
    whole = decontam.search(block, [text, "nothing"])
    for size in (50, 64, 101, 333):
        monkeypatch.setattr(decontam, "BATCH", size)
        assert decontam.search(block, [text, "nothing"]) == whole
    (m,) = whole[0]
    assert text[m["start"]:m["end"]].startswith("one BENCH") and text[m["start"]:m["end"]].endswith("for here")


def test_blocks_and_odd_rows(spark, monkeypatch):
    bench = spark.createDataFrame([(1, "the quick brown fox jumps over"), (2, None), (3, ""), (None, "renard brun saute par"),
                                   (4, "dog"), (4, "dog")], "item_id long, text string")
    docs = docs_of(spark, odd_documents(LONG), clashes=True)
    rows = lambda: sorted(((r.doc_id, r.item_id, r.edits) for r in
                           decontam.benchmark_matches(docs, bench).collect()), key=str)
    one = rows()
    assert one == sorted([(1, 1, 0), (1, 4, 0), (1, 4, 0), (1, 1, 0), (1, 4, 0), (1, 4, 0), (None, None, 0)], key=str)
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 20)
    assert rows() == one
    kept = decontam.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 3
    assert decontam.benchmark_matches(docs, bench.limit(0)).count() == 0
    assert decontam.benchmark_matches(docs.limit(0), bench).count() == 0


def test_alignment_against_the_full_table():
    rng = np.random.default_rng(3)
    for _ in range(200):
        item = rng.integers(1, 4, rng.integers(8, 20))
        text = np.concatenate([rng.integers(1, 4, rng.integers(0, 3)), item, rng.integers(1, 4, rng.integers(0, 3))])
        for _ in range(rng.integers(0, 3)):
            text[rng.integers(0, len(text))] = rng.integers(1, 4)
        want = sellers(item.tolist(), text.tolist())
        got, start, end = decontam.banded_alignment(item, text, 3)
        if want <= 3:
            assert got == want
            assert sellers(item.tolist(), text[start:end].tolist()) == want
        else:
            assert got > 3


def test_an_instruction_that_all_items_share(monkeypatch):
    """Memory follows the block of hits, not instructions x items; nothing is lost."""
    import random
    import tracemalloc
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    head = "choose the right answer to the question below and give reasons for it "
    items = [(i, head + " ".join(word() for _ in range(30))) for i in range(600)]
    text = (head + "or not ") * 150 + items[17][1] + " end " + items[5][1].replace("right", "rigth") + (" " + head) * 100
    whole = decontam.make_block(items)
    tracemalloc.start()
    found = decontam.search(whole, [text])[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(m["item"], m["edits"]) for m in found] == [(5, 2), (17, 0)]
    assert peak < 150e6
    # fewer places at once, or none left out: the same regions' matches
    monkeypatch.setattr(decontam, "HITS", 5000)
    assert decontam.search(whole, [text])[0] == found
    monkeypatch.setattr(decontam, "COMMON", 10 ** 9)
    full = decontam.make_block(items)
    assert full.need.sum() > whole.need.sum() and len(full.item_of) > len(whole.item_of)
    assert decontam.search(full, [text])[0] == found
