"""SQL for the queries that SQL can express, on the same tables."""

from __future__ import annotations

#: Sets of five-word runs, pairs through the runs they share, classes by least label.
OP7 = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
runs AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS run
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i
          FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM runs GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM runs a JOIN runs b ON a.run = b.run AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 5 * shared.n >= 4 * (x.n + y.n - shared.n)),
reach(doc_id, other) AS (
    SELECT a, b FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a),
classes AS (SELECT doc_id, min(other) AS least FROM reach GROUP BY doc_id),
counts AS (SELECT a AS doc_id, count(*) AS n FROM links GROUP BY a)
SELECT d.doc_id, least(d.doc_id, coalesce(c.least, d.doc_id)) AS class_id,
       coalesce(k.n, 0)::BIGINT AS n_links
FROM documents d LEFT JOIN classes c USING (doc_id) LEFT JOIN counts k USING (doc_id)
"""

OP9 = """
WITH clean AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
    FROM clean q JOIN clean c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    WHERE q.vec_id % 50 = 0)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
      FROM scored)
WHERE rank <= 5
"""

#: Base32 from the bits of the hexadecimal digest, five at a time.
OP10 = """
WITH bytes AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
bits AS (
    SELECT page_id, octet_length(encode(html)) AS payload_bytes, hex,
           array_to_string(list_transform(range(1, 41), lambda i: right(
               bin(instr('0123456789abcdef', substr(hex, i, 1)) + 15), 4)), '') AS bits
    FROM bytes),
digests AS (
    SELECT page_id, payload_bytes, hex, array_to_string(list_transform(range(0, 32), lambda i: substr(
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(1, 6), lambda k:
            substr(bits, 5 * i + k, 1)::INTEGER * (1 << (5 - k))))::INTEGER, 1)), '') AS payload_digest
    FROM bits),
firsts AS (SELECT hex, min(page_id) AS first FROM digests GROUP BY hex)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM digests JOIN firsts USING (hex)
"""

OP11 = """
WITH clean AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
           list_sum(list_transform(list_zip(a.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
    FROM clean a JOIN clean c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v)
    WHERE a.vec_id % 50 = 0),
positives AS (
    SELECT * FROM (SELECT *, row_number() OVER (
        PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM scored WHERE same)
    WHERE place <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM (SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id,
             p.score AS positive_score, n.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.vec_id
                                ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank
      FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
      WHERE 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
WHERE rank <= 3
"""

#: Every phrase of one to five words, counted; cuts through a self join.
OP12 = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
    FROM documents),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
grams AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
    FROM starts, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w)
    GROUP BY ALL HAVING count(*) >= 100),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
cuts AS (
    SELECT lang, phrase, k, f, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut
    FROM grams WHERE k > 1),
scored AS (
    SELECT c.lang, c.phrase, c.k, c.f AS a, l.f AS l, r.f AS r, n, cut,
           (1000::HUGEINT * c.f * n // (l.f::HUGEINT * r.f))::BIGINT AS score
    FROM cuts c JOIN grams l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:cut], ' ')
                JOIN grams r ON r.lang = c.lang AND r.phrase = array_to_string(w[cut + 1:], ' ')
                JOIN totals t ON t.lang = c.lang),
candidates AS (
    SELECT * FROM scored
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
parts AS (
    SELECT DISTINCT lang, f, array_to_string(w[i:i + m - 1], ' ') AS phrase
    FROM (SELECT *, unnest(range(1, k - m + 2)) AS i
          FROM (SELECT lang, f, k, string_split(phrase, ' ') AS w, unnest(range(2, k)) AS m
                FROM grams WHERE k > 2)))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM candidates c
WHERE NOT EXISTS (FROM parts p WHERE p.lang = c.lang AND p.phrase = c.phrase AND 100 * p.f >= 100 * c.a)
QUALIFY rank <= 2000
"""

OP13 = r"""
WITH texts AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY body)
"""

ORACLE = {"op7_jaccard_join": OP7, "op9_exact_top_k": OP9, "op10_warc": OP10,
          "op11_hard_negatives": OP11, "op12_collocations": OP12, "op13_exact_dedup": OP13}
