import random
import re
from collections import Counter

import pytest
from helpers import LONG, MID, docs_of, odd_documents, same_as_sql

from salescope.llm import collocations


def pieces_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall("[^\x20\x09]+", p) for p in re.split("[.,;:!?\x0a-\x0d]", low)]


def plain(rows, min_count, first):
    """All phrases of all texts counted one by one."""
    counts, total = {}, Counter()
    for text, lang in rows:
        lang = lang or "und"
        for w in pieces_of(text):
            total[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(w[i:i + k])] += 1
    out = []
    for lang, of in counts.items():
        many = {p: f for p, f in of.items() if f >= min_count}
        best = []
        for p, a in many.items():
            if len(p) < 2 or any(100 * f >= 80 * a and len(q) > len(p) and any(
                    q[i:i + len(p)] == p for i in range(len(q))) for q, f in many.items()):
                continue
            score, k = min((2_000_000 * a // (of[p[:k]] + of[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), of[p[:k]], of[p[k:]]))
        for n, (score, a, p, left, right) in enumerate(sorted(best)[:first], 1):
            out.append((lang, n, p.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def rows_of(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def test_query_is_the_sql(spark):
    same_as_sql(spark, "op11_collocations", MID)


def random_texts(seed, n=120):
    rng = random.Random(seed)
    words = ["new", "york", "city", "hall", "New", "the", "é", "a|b", "x y", "\x1c", "of"]
    out = []
    for i in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "\r\n", ","])
                       for _ in range(rng.randint(0, 80)))
        out.append((text, rng.choice(["en", "en", "fr", None, "und", "a\nb "])))
    return out + out[:40] * 3


@pytest.mark.parametrize("seed", range(2))
def test_against_plain_counts(spark, seed):
    texts = random_texts(seed)
    docs = docs_of(spark, [(i, t, lang, "s") for i, (t, lang) in enumerate(texts)], clashes=True)
    got = collocations.mine_collocations(docs, min_count=5, first=50, trigger=4)
    assert rows_of(got) == plain(texts, 5, 50)
    # the same through several sorted parts
    split = collocations._first_of_each(
        got.select("lang", "phrase", "a", "l", "r", "score"), 7, 8)
    assert sorted((r.lang, r["rank"], r.phrase) for r in split.collect()) == [
        x[:3] for x in plain(texts, 5, 50) if x[1] <= 7]


def test_chunks_hold_every_start_once(monkeypatch):
    rng = random.Random(4)
    monkeypatch.setattr(collocations, "LONGEST", 50)
    for trigger, segment in ((4, 64), (16, 300), (1 << 20, 200), (16, 1 << 20)):
        text = "".join(rng.choice(["aa", "b", "cc", "d" * rng.choice([1, 1, 1, 150])]) + rng.choice("       .\n")
                       for _ in range(3000))
        found = Counter()
        for chunk, own in collocations.parse_text(collocations.normal_bytes(text), trigger, segment):
            w = chunk.split(b" ")
            for k in range(1, 5):
                for i in range(min(own, len(w) - k + 1)):
                    found[tuple(x.decode() for x in w[i:i + k])] += 1
        want = Counter(tuple(w[i:i + k]) for w in pieces_of(text) for k in range(1, 5) for i in range(len(w) - k + 1))
        assert found == want


def test_repeated_passages_give_repeated_chunks():
    rng = random.Random(7)
    passage = " ".join(f"w{rng.randrange(50)}" for _ in range(400))
    a, b = (Counter(collocations.parse_text(collocations.normal_bytes(f"{lead} {passage}"))) for lead in ("x", "other words"))
    shared = a & b
    assert sum(own for _, own in shared) > 330


def test_odd_rows(spark):
    rows = odd_documents(LONG)
    docs = docs_of(spark, rows, clashes=True)
    got = collocations.mine_collocations(docs, min_count=2)
    assert rows_of(got) == plain([(r[1], r[2]) for r in rows], 2, 2000)
    empty = collocations.mine_collocations(docs.limit(0))
    assert empty.count() == 0 and empty.columns == got.columns
    assert collocations.mine_collocations(docs.where("doc_id = 4")).count() == 0
    assert collocations.mine_collocations(docs.where("doc_id = 1"), min_count=3).count() == 0


def test_counts_of_one_repeated_word(spark):
    docs = docs_of(spark, [(i, "a " * 5000, "en", "s") for i in range(3)])
    got = collocations.mine_collocations(docs, min_count=30).collect()
    assert [(r.phrase, r.a, r.l, r.r, r.n) for r in got] == [("a a a a", 3 * 4997, 15000, 3 * 4998, 15000)]
