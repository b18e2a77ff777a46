import re

import pytest
from helpers import LONG, MID, SF, docs_of, odd_documents, same_as_sql

from salescope.llm import licenses
from salescope.llm.common import with_row_id


@pytest.mark.parametrize("sf", [SF, MID])
def test_same_as_sql(spark, sf):
    same_as_sql(spark, "op10_license_scan", sf)


def held(words, sets):
    """Templates of which a span of the words has enough: {template: most}."""
    out = {}
    for t in sets:
        most = max((len(set(words[i:i + t["span"]]) & set(t["words"])) for i in range(len(words))), default=0)
        if most >= t["need"]:
            out[t["k"]] = most / len(t["words"])
    return out


def words_in(text):
    return re.findall(licenses.WORDS, text.lower())


def test_join_against_all_lines_and_templates(spark):
    import random
    rng = random.Random(3)
    words = sorted({w for t in licenses.template_sets() for w in t["words"]}) + ["other", "words", "here"]
    texts = []
    for _ in range(150):
        lines = []
        for _ in range(4):
            _, t = rng.choice(licenses.TEMPLATES)
            line = t.split()
            for _ in range(rng.randint(0, 4)):
                line[rng.randrange(len(line))] = rng.choice(words)
            lines.append(" ".join(line + rng.choices(words, k=rng.randint(0, 6))))
        texts.append("\n".join(lines))
    docs = docs_of(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    for threshold in (0.6, 0.9, 1.0):
        sets = licenses.template_sets(threshold=threshold)
        want = {(i, n, k, most) for i, text in enumerate(texts) for n, line in enumerate(text.split("\n"))
                for k, most in held(words_in(line), sets).items()}
        got = {(r.doc_id, m.line, m.template, m.containment)
               for r in licenses.scan_licenses(docs, threshold=threshold).collect() for m in r.matches}
        assert got == want and want


def test_paragraphs_against_all_spans(spark):
    """Windows of long paragraphs find what any span of a paragraph holds."""
    import random
    rng = random.Random(8)
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 5)):
            _, t = rng.choice(licenses.TEMPLATES)
            line = t.split()
            if rng.random() < 0.5:  # scattered: enough words, no span
                line = [w for x in line for w in [x] + ["of", "p"] * rng.randint(0, 2)]
            parts += line + [f"q{rng.randrange(9)}" for _ in range(rng.randint(0, 80))]
        for i in range(len(parts)):
            if rng.random() < 0.15:
                parts[i] += rng.choice(["\n", "\n", "\n \n"])
        texts.append(" ".join(parts))
    sets = licenses.template_sets()
    out = licenses.scan_licenses(docs_of(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])).collect()
    for r in out:
        want = set()
        for p in re.split(r"\n[ ]*\n", texts[r.doc_id]):
            if re.search(r"[^ \n] *\n+ *[^ \n]", p):
                want |= set(held(words_in(p), sets))
        assert {m.template for m in r.block_matches} == want
    assert any(r.block_matches for r in out)


def test_scattered_words_are_no_statement(spark):
    text = ("all of the people who reserved seats have rights and released a version of it under some of the terms that "
            "the people of MIT gave in a license")
    out = licenses.scan_licenses(docs_of(spark, [(1, text, "en", "a"), (2, text.replace(" and ", "\n"), "en", "a")]))
    assert all(r.matches == [] and r.block_matches == [] for r in out.collect())


def test_frequent_words_come_last(spark):
    docs = docs_of(spark, [(i, "the the of license", "en", "a") for i in range(50)] + [
        (99, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
             "and associated documentation files", "en", "a")])
    sets = licenses.template_sets()
    facts = licenses.text_facts(with_row_id(docs).select("__row", "doc_id", "text"),
                                sorted({w for t in sets for w in t["words"]}))
    assert {r.label for r in licenses.template_matches(facts, sets).collect()} == {"mit-license"}


def test_phrases_across_lines_and_odd_rows(spark):
    rows = odd_documents(LONG) + [
        (20, "the MIT\n License; and (CC)-BY and cc by, mit licenses GNU General\tPublic license mit license", "en", "a"),
        (21, "émit license mit licenseé", "en", "a")]
    out = licenses.scan_licenses(docs_of(spark, rows, clashes=True)).collect()
    assert len(out) == len(rows)
    by_id = {r.doc_id: r for r in out}
    assert sorted((p.start, p.label) for p in by_id[20].places) == [(1, "mit"), (4, "cc-by"), (7, "cc-by"),
                                                                    (11, "gpl"), (15, "mit")]
    assert by_id[20].n_words == 17 and by_id[21].places == [] and by_id[21].n_words == 4
    assert all(by_id[i].n_words == 0 for i in (2, 3, 4))
    assert by_id[7].n_words == 1
    assert licenses.scan_licenses(docs_of(spark, [])).count() == 0
    with pytest.raises(ValueError):
        licenses.template_sets([("x", " ".join(f"w{i}" for i in range(30_000)))])


WRAPPED = """Copyright (c) 2020 Someone

# Permission is hereby granted, free of charge, to any person obtaining a copy
# of this software and associated documentation files (the "Software"), to deal
# in the Software without restriction"""


def test_statements_that_wrap_over_lines(spark):
    prose = "\n".join(" ".join(f"p{i}x{j}" for j in range(9)) for i in range(40))
    texts = [WRAPPED] + [prose[:n] + "\n" + WRAPPED.split("\n\n")[1] + "\n" + prose for n in range(100, 700, 37)] + [
        "Permission is hereby granted, free of charge, to any person\n\nobtaining a copy of this software "
        "and associated documentation files"]
    out = {r.doc_id: r for r in licenses.scan_licenses(
        docs_of(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])).collect()}
    assert all(not r.matches for r in out.values())
    last = len(texts) - 1
    assert all({m.label for m in out[i].block_matches} == {"mit-license"} for i in range(last))
    assert out[last].block_matches == []
