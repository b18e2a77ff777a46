"""DuckDB SQL of the operators' queries that SQL can express."""

from __future__ import annotations

from salescope.llm.capfilters import THRESHOLD
from salescope.llm.centroids import CLUSTERS, COMPONENTS, LARGEST, SCALE
from salescope.llm.centroids import ROUNDS as MEAN_ROUNDS
from salescope.llm.collocations import ABSORB, FIRST, MAX_WORDS, MIN_COUNT, SCORE_SCALE
from salescope.llm.licenses import PHRASES, WORDS, template_sets
from salescope.llm.linededup import MIN_WORDS
from salescope.llm.mixing import CEILING, ROUNDS, SHARE, WEIGHTS

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _mix_round(r: int) -> str:
    return f"""
r{r}a AS (SELECT *, CASE WHEN pick = 0 AND rank IS NOT NULL AND size <= gap THEN
            sum(CASE WHEN pick = 0 AND rank IS NOT NULL AND size <= gap THEN size END)
              OVER (PARTITION BY source ORDER BY rank) END AS run FROM r{r - 1}),
r{r} AS (SELECT * EXCLUDE (run, pick, gap), CASE WHEN run <= gap THEN 1 ELSE pick END AS pick,
            gap - coalesce(max(CASE WHEN run <= gap THEN run END) OVER (PARTITION BY source), 0) AS gap FROM r{r}a),"""


MIX = rf"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))), 1, 13) AS BIGINT)
     + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS pos FROM s),
c AS (SELECT *, {list(WEIGHTS)}[CAST(pos % {len(WEIGHTS)} AS INTEGER) + 1] AS weight, source_size * {CEILING} AS ceiling FROM w),
l AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * {SHARE}::DOUBLE - coalesce(sum(ceiling) OVER b, 0)::DOUBLE)
      / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))::DOUBLE AS level FROM c
      WINDOW b AS (ORDER BY ceiling / weight, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(ceiling::DOUBLE, max(level) OVER () * weight) AS target FROM l),
e AS (SELECT *, floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END) AS whole FROM t),
v AS (SELECT *, target - whole * source_size AS gap FROM e),
n AS (SELECT source, size, count(*) AS n FROM d WHERE size > 0 GROUP BY source, size),
m AS (SELECT n.source, size, (gap - coalesce(sum(n * size) OVER (PARTITION BY n.source ORDER BY size DESC
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
             / (sum(n * size::HUGEINT * size) OVER (PARTITION BY n.source ORDER BY size))::DOUBLE AS c
      FROM n JOIN v ON n.source IS NOT DISTINCT FROM v.source),
k AS (SELECT source, max_by(c, size) AS c FROM m WHERE c * size <= 1 GROUP BY source),
p AS (SELECT d.*, v.source_size, v.target, v.whole, v.gap, least(coalesce(k.c, 0) * size, 1.0::DOUBLE) AS part
      FROM d JOIN v ON d.source IS NOT DISTINCT FROM v.source LEFT JOIN k ON d.source IS NOT DISTINCT FROM k.source),
o AS (SELECT *, CASE WHEN part > 0 AND part < 1 THEN (u / (1 - u)) / (part / (1 - part)) END AS odds FROM p),
r0 AS (SELECT * EXCLUDE (part, odds), CASE WHEN part >= 1 THEN 0.0 ELSE odds / (1 + odds) END AS rank, 0 AS pick FROM o),
{"".join(_mix_round(r) for r in range(1, ROUNDS + 1))}
z AS (SELECT * FROM r{ROUNDS})
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST((whole + pick) * size AS BIGINT) AS taken FROM z
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
f AS (SELECT payload, min(page_id) AS first_id FROM p WHERE strlen(payload) >= 100 GROUP BY payload)
SELECT page_id, CAST(strlen(p.payload) AS BIGINT) AS payload_bytes, sha256(p.payload) AS payload_digest,
       CASE WHEN f.first_id IS NULL OR f.first_id IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f.first_id IS DISTINCT FROM page_id THEN f.first_id END AS refers_to
FROM p LEFT JOIN f ON p.payload = f.payload
"""

LINES = rf"""
WITH a AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS raw,
                  unnest(range(len(string_split(text, chr(10))))) AS line FROM documents WHERE text IS NOT NULL),
n AS (SELECT *, trim(raw, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS content FROM a),
w AS (SELECT doc_id, line, content, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS seq,
             len(regexp_extract_all(content, '[^\x20\x09-\x0D]+')) AS words FROM n WHERE content <> ''),
e AS (SELECT *, CAST(sum(words) OVER (PARTITION BY doc_id ORDER BY line) AS BIGINT) AS e,
             CAST(sum(words) OVER (PARTITION BY doc_id) AS BIGINT) AS total FROM w),
s AS (SELECT *, e - words AS s FROM e),
g AS (SELECT 'start' AS kind, doc_id, seq AS lo, max(seq) OVER x AS hi, list(content) OVER x AS run,
             s + {MIN_WORDS} <= total AS ok
      FROM s WINDOW x AS (PARTITION BY doc_id ORDER BY s RANGE BETWEEN CURRENT ROW AND {MIN_WORDS - 1} FOLLOWING)
      UNION ALL
      SELECT 'end', doc_id, min(seq) OVER x, seq, list(content) OVER x, e >= {MIN_WORDS}
      FROM s WINDOW x AS (PARTITION BY doc_id ORDER BY e RANGE BETWEEN {MIN_WORDS - 1} PRECEDING AND CURRENT ROW)),
k AS (SELECT doc_id, lo, hi, row_number() OVER (PARTITION BY kind, run ORDER BY doc_id, lo) AS place FROM g WHERE ok),
x AS (SELECT DISTINCT doc_id, unnest(range(lo, hi + 1)) AS seq FROM k WHERE place > 1),
i AS (SELECT x.doc_id, w.line, x.seq - row_number() OVER (PARTITION BY x.doc_id ORDER BY x.seq) AS island
      FROM x JOIN w ON x.doc_id = w.doc_id AND x.seq = w.seq),
r AS (SELECT doc_id, min(line) AS lo, max(line) AS hi FROM i GROUP BY doc_id, island),
y AS (SELECT a.doc_id, string_agg(a.raw, chr(10) ORDER BY a.line) FILTER (WHERE r.doc_id IS NULL) AS text
      FROM a LEFT JOIN r ON a.doc_id = r.doc_id AND a.line BETWEEN r.lo AND r.hi GROUP BY a.doc_id),
z AS (SELECT doc_id, CAST(sum(hi - lo + 1) AS BIGINT) AS removed_lines,
             string_agg(lo || '-' || hi, ',' ORDER BY lo) AS removed_runs FROM r GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN z.doc_id IS NULL THEN d.text ELSE coalesce(y.text, '') END AS text,
       coalesce(z.removed_lines, 0) AS removed_lines, coalesce(z.removed_runs, '') AS removed_runs
FROM documents d LEFT JOIN y ON d.doc_id = y.doc_id LEFT JOIN z ON d.doc_id = z.doc_id
"""

VECTORS = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      AND list_cosine_similarity(a.x, b.x) >= {THRESHOLD}),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS low FROM r GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(least(low, vec_id), vec_id) AS component_id,
       coalesce(least(low, vec_id), vec_id) = vec_id AS kept
FROM v LEFT JOIN n ON v.vec_id = n.a LEFT JOIN c ON v.vec_id = c.a
"""


def _licenses() -> str:
    text = lambda s: "'" + s.replace("'", "''") + "'"
    places = []
    for phrase, label in PHRASES.items():
        words = phrase.split(" ")
        test = " AND ".join(f"words[i + {n + 1}] = {text(w)}" for n, w in enumerate(words))
        places.append(f"list_transform(list_filter(range(len(words)), lambda i: coalesce({test}, false)), "
                      f"lambda i: {{'s': i, 'l': {text(label)}}})")
    rows = ", ".join(f"({t['k']}, {text(t['label'])}, [{', '.join(map(text, t['words']))}], {t['need']}, {t['span']})"
                     for t in template_sets())
    both = places[0]
    for p in places[1:]:
        both = f"list_concat({both}, {p})"
    return rf"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
w AS (SELECT doc_id, regexp_extract_all(t, '{WORDS}') AS words FROM d),
p AS (SELECT doc_id, len(words) AS n_words, {both} AS places FROM w),
lines AS (SELECT doc_id, regexp_extract_all(unnest(string_split(t, chr(10))), '{WORDS}') AS words FROM d),
tpl(k, label, words, need, span) AS (VALUES {rows}),
j AS (SELECT doc_id, label, need, len(tpl.words) AS size, list_max(list_transform(
             range(greatest(len(lines.words) - span, 0) + 1),
             lambda i: len(list_intersect(list_distinct(lines.words[i + 1:i + span]), tpl.words)))) AS best
      FROM lines JOIN tpl ON len(list_intersect(list_distinct(lines.words), tpl.words)) >= need),
m AS (SELECT doc_id, list(DISTINCT label) AS labels, max(best::DOUBLE / size) AS best FROM j WHERE best >= need
      GROUP BY doc_id),
b AS (SELECT p.*, list_sort(list_distinct(list_transform(places, lambda x: x.l))) AS base,
             list_transform(places, lambda x: x.s) AS starts FROM p)
SELECT b.doc_id, n_words, len(places) AS n_base, list_min(starts) AS first_word, list_max(starts) AS last_word,
       array_to_string(base, ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(base, coalesce(m.labels, [])))), ',') AS labels,
       CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score
FROM b LEFT JOIN m ON b.doc_id = m.doc_id
"""


COLLOCATIONS = rf"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM d),
q AS (SELECT lang, w, count(*) AS times FROM p WHERE len(w) > 0 GROUP BY lang, w),
n AS (SELECT lang, CAST(sum(len(w) * times) AS BIGINT) AS n FROM q GROUP BY lang),
i AS (SELECT lang, w, times, unnest(range(len(w))) AS i FROM q),
g AS (SELECT lang, w, times, i, unnest(range(1, least({MAX_WORDS}, len(w) - i) + 1)) AS k FROM i),
c AS (SELECT lang, list_slice(w, i + 1, i + k) AS x, CAST(sum(times) AS BIGINT) AS f FROM g GROUP BY ALL HAVING f >= {MIN_COUNT}),
cut AS (SELECT lang, x, f AS a, unnest(range(1, len(x))) AS k FROM c WHERE len(x) > 1),
s AS (SELECT cut.lang, cut.x, a, k, l.f AS l, r.f AS r,
             CAST(floor_score AS BIGINT) AS score
      FROM cut JOIN c l ON l.lang = cut.lang AND l.x = list_slice(cut.x, 1, k)
               JOIN c r ON r.lang = cut.lang AND r.x = list_slice(cut.x, k + 1, len(cut.x)),
           LATERAL (SELECT ({SCORE_SCALE}::HUGEINT * a) // (l.f::HUGEINT + r.f) AS floor_score)),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, x ORDER BY score, k) = 1),
u AS (SELECT lang, x, f, unnest(range(2, len(x))) AS k FROM c WHERE len(x) > 2),
v AS (SELECT lang, x, f, k, unnest(range(0, len(x) - k + 1)) AS off FROM u),
o AS (SELECT lang, list_slice(x, off + 1, off + k) AS x, max(f) AS most FROM v GROUP BY ALL),
z AS (SELECT b.lang, array_to_string(b.x, ' ') AS phrase, a, l, r, score FROM b
      LEFT JOIN o ON o.lang = b.lang AND o.x = b.x WHERE o.most IS NULL OR 100 * o.most::HUGEINT < {ABSORB} * a::HUGEINT),
y AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM z)
SELECT y.lang, rank, phrase, a, l, r, n.n, score FROM y JOIN n ON n.lang = y.lang WHERE rank <= {FIRST}
"""


def _means_round(i: int) -> str:
    """Assignment to the centroids ``k<i>`` and, from it, the centroids ``k<i+1>``."""
    return f"""
a{i} AS MATERIALIZED (SELECT row, q, arg_min(struct_pack(d, c), struct_pack(d, c)) AS near FROM (
    SELECT row, q, c, list_sum(list_transform(range(1, {COMPONENTS} + 1), lambda j: (q[j] - x[j]) * (q[j] - x[j])))::BIGINT AS d
    FROM v, k{i}) GROUP BY row, q),
k{i + 1} AS MATERIALIZED (SELECT k{i}.c, coalesce(m.x, k{i}.x) AS x FROM k{i} LEFT JOIN (
    SELECT c, list(mean ORDER BY j) AS x FROM (
        SELECT c, j, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS mean FROM (
            SELECT near.c AS c, j, sum(q[j])::HUGEINT AS s, count(*)::HUGEINT AS n
            FROM a{i}, range(1, {COMPONENTS} + 1) AS e(j) GROUP BY near.c, j)) GROUP BY c) m ON m.c = k{i}.c),"""


MEANS = f"""
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, row_number() OVER () AS row FROM embeddings),
v AS MATERIALIZED (SELECT row, vec_id, list_transform(x, lambda y: CAST(floor(greatest(least(y * {SCALE}, {LARGEST}::DOUBLE), -{LARGEST}::DOUBLE)) AS BIGINT)) AS q
      FROM e WHERE len(x) = {COMPONENTS} AND len(list_filter(x, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
k0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, q) - 1 AS c, q AS x FROM (
      SELECT sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, q FROM v ORDER BY h, q LIMIT {CLUSTERS})),
{"".join(_means_round(i) for i in range(MEAN_ROUNDS + 1))}
s AS (SELECT near.c AS c, sum(near.d)::BIGINT AS cluster_inertia FROM a{MEAN_ROUNDS} GROUP BY near.c)
SELECT vec_id, CAST(near.c AS INTEGER) AS cluster, near.d AS distance, cluster_inertia,
       (SELECT sum(cluster_inertia)::BIGINT FROM s) AS inertia, sha256(array_to_string(k.x, ',')) AS centroid_sha256
FROM a{MEAN_ROUNDS} a JOIN v ON v.row = a.row JOIN s ON s.c = near.c JOIN k{MEAN_ROUNDS} k ON k.c = near.c
"""


ORACLE = {
    "op2_pareto_mix": MIX,
    "op5_warc_records": WARC,
    "op8_line_dedup": LINES,
    "op9_cap_filter_links": VECTORS,
    "op10_license_scan": _licenses(),
    "op11_collocations": COLLOCATIONS,
    "op12_centroid_clusters": MEANS,
}
