import math
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import LONG, MID, SF, docs_of, odd_documents
from pyspark.sql import functions as F

from salescope.llm import suffixtree
from salescope.llm.queries import op4_suffix_tree_scores
from salescope.sources.tables import table


def test_counts_and_base_score_against_brute_force(spark, monkeypatch):
    docs = {r.doc_id: (r.text or "").encode().lower().split() for r in table(spark, SF, "documents").collect()}
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d in docs}
    count = Counter(w for d, t in docs.items() if not held[d] for w in [*t, None])
    total, different = sum(count.values()), len(count)
    log = lambda c: math.log10((c + 0.1) / (total + 0.1 * (different + 1)))
    for hot in (suffixtree.HOT_WORDS, 50):  # with a few hot words most are joined
        monkeypatch.setattr(suffixtree, "HOT_WORDS", hot)
        out = op4_suffix_tree_scores(spark, SF).collect()
        assert len(out) == len(docs)
        for r in out:
            t = [*docs[r.doc_id], None]
            assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(t), total)
            assert r.n_known == sum(count[w] > 0 for w in t)
            assert r.base_score == pytest.approx(sum(log(count[w]) for w in t), rel=1e-9)


def test_contexts_help_on_held_out_texts(spark):
    out = [r for r in op4_suffix_tree_scores(spark, MID).collect() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert all(r.score <= 0 for r in out)


def _pattern(spark):
    rows = []
    for i in range(300):
        rows.append((i, "red green blue " * (1 + i % 3) + ("one two three four" if i % 2 else "five six"), "en", "a"))
    return docs_of(spark, rows).withColumn("learns", F.lit(True))


def test_distributions_sum_to_one_and_only_useful_contexts_stay(spark, monkeypatch):
    kept = {}
    grow = suffixtree.grow_tree

    def spy(levels, total, root, sizes):
        kept["tree"], kept["root"] = grow(levels, total, root, sizes), root
        return kept["tree"]

    monkeypatch.setattr(suffixtree, "grow_tree", spy)
    docs = _pattern(spark)
    out = suffixtree.score_texts(docs, "learns").collect()
    assert sum(r.score for r in out) > 0.2 * sum(r.base_score for r in out)
    tree, root = kept["tree"], kept["root"]
    symbols = [*range(1, 13), suffixtree.EDGE, suffixtree.RARE]
    known = [s for s in symbols if s == suffixtree.EDGE or s == suffixtree.RARE or root[s] > root[suffixtree.RARE]]
    contexts = [(1,), (2, 1), (3, 2, 1), (suffixtree.EDGE,) * 3, (9, 4)]
    assert sum(map(len, tree.contexts)) > 3
    for c in contexts:
        total = 0.0
        for s in known:
            line = np.array([suffixtree.EDGE] * (3 - len(c)) + [*c, s], np.uint16)
            total += math.exp(tree.log_ratios(line, np.array([3]))[0] + root[s])
        assert total == pytest.approx(1, abs=1e-6)
    # words drawn without regard to what is before them need no context
    rng = np.random.default_rng(1)
    flat = [(i, " ".join(rng.choice(["a", "b", "c", "d"], 50)), "en", "a") for i in range(200)]
    suffixtree.score_texts(docs_of(spark, flat).withColumn("learns", F.lit(True)), "learns").collect()
    assert len(kept["tree"].contexts[2]) == 0


def test_grams_against_brute_force(spark):
    docs = [[1, 2, 3, 1, 2], [2, 3], [], [1, 2, 3]]
    ids = spark.createDataFrame([(np.array(d, "<u2").tobytes(),) for d in docs], "ids binary")
    E = suffixtree.EDGE
    every = np.array(sorted({E, 1, 2, 3}), np.uint64)
    got = {r.gram: r.n for r in suffixtree.gram_counts(ids, 1, every).collect()}
    want = Counter()
    for d in docs:
        s = [E, *d, E]
        for a, b in zip(s, s[1:]):
            want[a << 16 | b] += 1
    assert got == want


def test_odd_rows(spark):
    rows = odd_documents(LONG)
    docs = docs_of(spark, rows, clashes=True).withColumn("learns", F.col("doc_id").isNotNull())
    out = suffixtree.score_texts(docs, "learns").collect()
    assert len(out) == len(rows)
    empty = [r for r in out if r.doc_id in (2, 3, 4)]
    assert len({(r.n_tokens, r.base_score, r.score) for r in empty}) == 1 and empty[0].n_tokens == 1
    none = suffixtree.score_texts(docs.withColumn("learns", F.lit(False)), "learns").collect()
    assert {(r.n_known, r.train_tokens) for r in none} == {(0, 0)} and all(r.score == 0 for r in none)
    assert suffixtree.score_texts(docs.limit(0), "learns").count() == 0


def test_tree_table_same_as_on_the_driver(spark, monkeypatch):
    docs = table(spark, SF, "documents").select("doc_id", "text").withColumn("learns", F.col("doc_id") % 4 != 0)
    want = {r.doc_id: r.score for r in suffixtree.score_texts(docs, "learns").collect()}
    monkeypatch.setattr(suffixtree, "LOCAL_TOKENS", 0)
    for words, entries in ((suffixtree.HOT_WORDS, suffixtree.HOT_ENTRIES), (300, 0), (300, 500)):
        monkeypatch.setattr(suffixtree, "HOT_ENTRIES", entries)
        got = {r.doc_id: r.score for r in suffixtree.score_texts(docs, "learns", words).collect()}
        assert got == pytest.approx(want, rel=1e-9)


def test_listing_does_not_depend_on_the_size(spark):
    # 150,000 tokens: a share of 2e-5 would ask for 3 occurrences
    filler = " ".join(f"f{i % 7}" for i in range(1000))
    rows = [(i, filler, "en", "a") for i in range(150)] + [(i, "rare pair " * 2, "en", "a") for i in (200,)]
    out = suffixtree.score_texts(docs_of(spark, rows).withColumn("learns", F.lit(True)), "learns").collect()
    (r,) = [r for r in out if r.doc_id == 200]
    assert r.score > r.base_score + 5


def test_parts_and_hot_contexts_change_no_score(spark, monkeypatch):
    docs = table(spark, SF, "documents").select("doc_id", "text").withColumn("learns", F.col("doc_id") % 4 != 0)
    want = {r.doc_id: r.score for r in suffixtree.score_texts(docs, "learns").collect()}
    rows, keep = {}, suffixtree.keep

    def spy(df, name):
        kept = keep(df, name)
        rows[name] = kept.count()
        return kept

    for name, value in (("LOCAL_TOKENS", 0), ("BLOCK", 3000), ("PART", 5000), ("HOT_ENTRIES", 200), ("keep", spy)):
        monkeypatch.setattr(suffixtree, name, value)
    out = suffixtree.score_texts(docs, "learns", 300).collect()
    assert {r.doc_id: r.score for r in out} == pytest.approx(want, rel=1e-9)
    # symbols are packed: no table has a row for each of them, or for each that is looked up
    del rows["word-counts"]
    assert max(rows.values()) < sum(r.n_tokens for r in out) / 4, rows


def test_texts_of_one_repeated_word(spark, monkeypatch):
    rows = [(i, "same " * (200 + i) + f"w{i % 7}", "en", "a") for i in range(40)]
    docs = docs_of(spark, rows).withColumn("learns", F.col("doc_id") % 5 != 0)
    want = {r.doc_id: r.score for r in suffixtree.score_texts(docs, "learns").collect()}
    for name, value in (("LOCAL_TOKENS", 0), ("PART", 700), ("HOT_ENTRIES", 1000)):
        monkeypatch.setattr(suffixtree, name, value)
    got = {r.doc_id: r.score for r in suffixtree.score_texts(docs, "learns").collect()}
    assert got == pytest.approx(want, rel=1e-9)
