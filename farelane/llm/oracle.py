"""DuckDB SQL for the operators whose whole result SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NGRAM_JOIN = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS shingle
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
         GROUP BY a.doc_id, b.doc_id),
links AS (SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * o >= 90 * (p.n + q.n - o)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, edges.y FROM reach JOIN edges ON edges.x = reach.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = d.doc_id"""

TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(1024 * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
e AS (SELECT vec_id, x[i] AS c, i FROM (SELECT vec_id, x, unnest(range(1, len(x) + 1)) AS i FROM v)),
s AS (SELECT q.vec_id AS query_id, o.vec_id, CAST(sum(q.c * o.c) AS BIGINT) AS score
      FROM e q JOIN e o ON q.i = o.i AND q.vec_id <> o.vec_id WHERE q.vec_id % 100 = 0 GROUP BY q.vec_id, o.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10"""


def license_scan(templates: list[tuple[str, str]], block: int, threshold: str) -> str:
    """Every template against every block that shares a word with it."""
    half = block // 2
    rows = ", ".join(f"({t}, '{label}', '{text}')" for t, (label, text) in enumerate(templates))
    words = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {words}) AS w FROM documents),
t AS (SELECT doc_id, len(w) AS n, i - 1 AS pos, w[i] AS x, w[i - 1] AS x1, w[i - 2] AS x2
      FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
places AS (SELECT doc_id, pos - 1 AS fst, x1 AS label FROM t WHERE x = 'license' AND pos >= 1 AND x1 IN ('mit', 'apache')
           UNION ALL SELECT doc_id, pos - 2, 'gpl' FROM t WHERE x = 'license' AND pos >= 2 AND x1 = 'public' AND x2 = 'general'),
template AS (SELECT t, label, list_distinct(regexp_extract_all(lower(text), {words})) AS own FROM (VALUES {rows}) AS v(t, label, text)),
tw AS (SELECT t, unnest(own) AS word FROM template),
hits AS (SELECT DISTINCT doc_id, t, word, s FROM (
           SELECT doc_id, tw.t, tw.word, pos, n, unnest([pos // {half} * {half}, pos // {half} * {half} - {half}]) AS s
           FROM t JOIN tw ON tw.word = t.x)
         WHERE s >= 0 AND (s = 0 OR s < n - {half}) AND pos < s + {block}),
every AS (SELECT doc_id, t, s, label, count(*) / CAST(len(own) AS DOUBLE) AS containment FROM hits JOIN template USING (t)
          GROUP BY doc_id, t, s, label, own HAVING count(*) >= ceil({threshold} * len(own) - 1e-9)),
twin AS (SELECT a.t, b.t AS u FROM template a JOIN template b ON a.label <> b.label
         WHERE len(list_intersect(a.own, b.own)) >= ceil({threshold} * greatest(len(a.own), len(b.own)) - 1e-9)),
found AS (SELECT * FROM every e WHERE NOT EXISTS (
            SELECT 1 FROM twin JOIN every o ON o.t = twin.u WHERE twin.t = e.t AND o.doc_id = e.doc_id AND o.s = e.s AND o.containment > e.containment)),
b AS (SELECT doc_id, count(*) AS n_base, min(fst) AS first_word, max(fst) AS last_word,
             array_to_string(list_sort(list_distinct(list(label))), ',') AS base_labels FROM places GROUP BY doc_id),
l AS (SELECT doc_id, array_to_string(list_sort(list_distinct(list(label))), ',') AS labels
      FROM (SELECT doc_id, label FROM places UNION ALL SELECT doc_id, label FROM found) GROUP BY doc_id),
c AS (SELECT doc_id, max(containment) AS best FROM found GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(b.n_base, 0) AS n_base, b.first_word, b.last_word,
       coalesce(b.base_labels, '') AS base_labels, coalesce(l.labels, '') AS labels,
       greatest(coalesce(c.best, 0), CASE WHEN b.n_base > 0 THEN 1.0 ELSE 0.0 END) AS score
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN c USING (doc_id)"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
     f AS (SELECT page_id, payload, sha1(payload) AS h, min(page_id) OVER (PARTITION BY payload) AS first FROM p)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((('0x' || substr(h, (5 * (i // 4) + 1)::BIGINT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""


def vector_codes(parts: int, entries: int, rounds: int, scale: int) -> str:
    """Plain k-means per part: every part against every entry."""
    def assigned(turn: int) -> str:
        return f"""a{turn} AS (SELECT k, vec_id, label, p, any_value(y) AS y, arg_min(e, d * {entries} + e) AS e, min(d) AS d FROM (
    SELECT k, vec_id, label, p, y, e, list_sum(list_transform(list_zip(y, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM v JOIN c{turn} USING (p)) GROUP BY k, vec_id, label, p)"""

    def moved(turn: int) -> str:
        return f"""m{turn} AS (SELECT p, e, list(mean ORDER BY i) AS c FROM (
    SELECT p, e, i, floor(sum(y[i])::DOUBLE / count(*))::BIGINT AS mean FROM (SELECT p, e, y, unnest(range(1, len(y) + 1)) AS i FROM a{turn})
    GROUP BY p, e, i) GROUP BY p, e),
c{turn + 1} AS (SELECT c{turn}.p, c{turn}.e, coalesce(m{turn}.c, c{turn}.c) AS c FROM c{turn} LEFT JOIN m{turn} USING (p, e))"""
    steps = ",\n".join(s for turn in range(rounds) for s in (assigned(turn), moved(turn)))
    return f"""
WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id) AS k, vec_id, label,
                     list_transform(embedding, lambda c: floor({scale} * c::DOUBLE)::BIGINT) AS x FROM embeddings
              WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
v AS MATERIALIZED (SELECT k, vec_id, label, p, x[(p * (len(x) // {parts}) + 1):((p + 1) * (len(x) // {parts}))] AS y
      FROM (SELECT *, unnest(range({parts})) AS p FROM kept)),
c0 AS (SELECT p, k - 1 AS e, y AS c FROM v WHERE k <= {entries}),
{steps},
{assigned(rounds)},
codes AS (SELECT k, vec_id, label, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY k, vec_id, label),
digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM codes, digest
"""


VECTOR_CODES = vector_codes(16, 64, 2, 256)
