import random

import pytest
import xxhash
from helpers import LONG, SF, components, docs_of, odd_documents

from salescope.llm import common, simhash
from salescope.llm.queries import op7_simhash_groups
from salescope.sources.tables import table


def plain_simhash(text, k=3):
    words = re_words(text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def re_words(text):
    import re
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x20\x09-\x0D]+", low)


def brute_groups(ids, codes, bits):
    links = [(a, b) for a in range(len(ids)) for b in range(a) if (codes[a] ^ codes[b]).bit_count() <= bits]
    low = components(len(ids), links)
    best = {}
    for i, root in enumerate(low):
        if ids[i] is not None:
            best[root] = min(best.get(root, ids[i]), ids[i])
    return [best.get(root) for root in low]


def test_whole_table_against_brute_force(spark):
    docs = table(spark, SF, "documents").collect()
    codes = [plain_simhash(r.text) for r in docs]
    want = brute_groups([r.doc_id for r in docs], codes, 2)
    out = {r.doc_id: r for r in op7_simhash_groups(spark, SF).collect()}
    assert len(out) == len(docs)
    for r, code, low in zip(docs, codes, want):
        assert (out[r.doc_id].fingerprint, out[r.doc_id].component_id) == (f"{code:016x}", low)
    assert len(set(want)) < len(want)


def clustered_codes(seed):
    rng = random.Random(seed)
    codes = set()
    for _ in range(25):
        centre = rng.getrandbits(64)
        for _ in range(12):
            code = centre
            for _ in range(rng.randint(0, 3)):
                code ^= 1 << rng.randrange(64)
            codes.add(code)
    return sorted(c - (1 << 64) if c >> 63 else c for c in codes)


def all_pairs(codes, bits):
    u = [c % (1 << 64) for c in codes]
    return {(codes[a], codes[b]) for a in range(len(u)) for b in range(len(u))
            if codes[a] > codes[b] and (u[a] ^ u[b]).bit_count() <= bits}


@pytest.mark.parametrize("bits", [0, 1, 2])
@pytest.mark.parametrize("segments", [2, 3, 5])
def test_links_are_all_pairs_for_any_number_of_segments(spark, bits, segments):
    codes = clustered_codes(bits)
    frame = spark.createDataFrame([(c,) for c in codes], "fp long")
    links = simhash.fingerprint_links(frame, bits, segments, bucket=1000)
    assert {(r.a, r.b) for r in links.collect()} == all_pairs(codes, bits)
    # other segments, other tables
    rows = {(r.segment, r.value) for r in simhash.segment_rows(frame, segments).collect()}
    assert len({s for s, _ in rows}) == segments and rows != {
        (r.segment, r.value) for r in simhash.segment_rows(frame, segments + 1).collect()}


def test_without_the_tables_no_pair_is_found(spark, monkeypatch):
    codes = clustered_codes(9)
    frame = spark.createDataFrame([(c,) for c in codes], "fp long")
    monkeypatch.setattr(simhash, "segment_rows", lambda c, n: c.select("fp").selectExpr(
        "fp", "0 as segment", "fp as value").where("false"))
    assert simhash.fingerprint_links(frame, 2).count() == 0


@pytest.mark.parametrize("bits", [1, 2])
@pytest.mark.parametrize("bucket", [1, 3, 8])
def test_split_buckets_reach_what_all_pairs_reach(spark, bits, bucket):
    codes = clustered_codes(bits)
    frame = spark.createDataFrame([(c,) for c in codes], "fp long")
    links = simhash.fingerprint_links(frame, bits, bucket=bucket)
    pairs = {(r.a, r.b) for r in links.collect()}
    want = all_pairs(codes, bits)
    assert pairs <= want
    place = {c: i for i, c in enumerate(codes)}
    by = lambda links: components(len(codes), [(place[a], place[b]) for a, b in links])
    assert by(pairs) == by(want)
    got = {r.node: r.component for r in common.connected_components(links).collect()}
    groups = {}
    for i, root in enumerate(by(want)):
        groups.setdefault(root, []).append(codes[i])
    assert got == {c: min(g) for g in groups.values() if len(g) > 1 for c in g}


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(7, 7)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.component for r in common.connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(200)}}


def test_odd_rows_and_what_stays(spark):
    rows = odd_documents(LONG)
    docs = docs_of(spark, rows, clashes=True)
    out = simhash.simhash_groups(docs).collect()
    want = brute_groups([r[0] for r in rows], [plain_simhash(r[1]) for r in rows], 2)
    assert sorted(((r.doc_id, r.component_id) for r in out), key=str) == sorted(
        ((r[0], low) for r, low in zip(rows, want)), key=str)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id if r.doc_id is not None else 99, r.text is None) for r in kept.collect())
    assert got == [(1, False), (2, True), (5, False), (7, False), (99, False)]
    assert simhash.simhash_groups(docs.limit(0)).count() == 0
    assert simhash.drop_near_duplicates(docs.limit(0)).count() == 0


def test_blocks_of_long_texts():
    text = " ".join(f"w{i * i % 1009}" for i in range(70000))
    assert simhash.simhash(text) == plain_simhash(text)
