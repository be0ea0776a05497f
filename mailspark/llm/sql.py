"""The registered queries of this package as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

EXACT_DEDUP = r"""
WITH clean AS (
    SELECT doc_id,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
    FROM documents
)
SELECT doc_id,
       min(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept,
       sha256(t) AS text_sha256
FROM clean
WINDOW same AS (PARTITION BY t)
"""

WARC = r"""
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS payload FROM pages
),
firsts AS (
    SELECT page_id, octet_length(encode(payload)) AS payload_bytes,
           sha1(payload) AS digest,
           min(page_id) OVER (PARTITION BY payload) AS first_id
    FROM payloads
),
bits AS (
    SELECT *, list_aggregate(
        list_transform(range(1, 41), lambda i:
            lpad(bin(instr('0123456789abcdef', substr(digest, i, 1)) - 1), 4, '0')),
        'string_agg', '') AS b
    FROM firsts
)
SELECT page_id, payload_bytes,
       list_aggregate(
           list_transform(range(0, 32), lambda g:
               substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                      1 + list_sum(list_transform(range(1, 6), lambda k:
                          CAST(substr(b, 5 * g + k, 1) AS INTEGER) * (1 << (5 - k))))::INTEGER,
                      1)),
           'string_agg', '') AS payload_digest,
       CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM bits
"""

_ASSIGN = (
    r"((?i:password|passwd|secret|token|api_?key))[\"'']?\x20*[:=]\x20*[\"'']?"
    r"([A-Za-z0-9+/_.=-]+)"
)


def _matches(kind: int, pattern: str, group: int) -> str:
    return f"""
    SELECT doc_id, source, {kind} AS kind, regexp_extract_all(t, '{pattern}') AS m,
           string_split_regex(t, '{pattern}') AS g,
           regexp_extract_all(t, '{pattern}', {group}) AS v
    FROM docs"""


SECRETS = rf"""
WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
arrays AS ({" UNION ALL ".join((
    _matches(0, _ASSIGN, 2),
    _matches(1, "AKIA[A-Z0-9]{14,}", 0),
    _matches(2, "[0-9a-f]{16,}", 0),
    _matches(3, "[A-Za-z0-9+/_-]{20,}", 0),
))}),
found AS (
    SELECT doc_id, source, kind, i, length(m[i]) AS n, length(g[i]) AS gap, v[i] AS value
    FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM arrays)
),
placed AS (
    SELECT *, stop - n AS start
    FROM (SELECT *, sum(gap + n) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop FROM found)
),
passing AS (
    SELECT *, sha256(value) AS hash FROM placed
    WHERE CASE kind
        WHEN 0 THEN length(value) >= 12
        WHEN 3 THEN regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
             AND len(list_distinct(string_split(value, ''))) >= 8
        ELSE true END
),
apart AS (
    SELECT * FROM passing p
    WHERE kind < 3 OR NOT EXISTS (
        SELECT 1 FROM passing b
        WHERE b.doc_id = p.doc_id AND b.kind < 3 AND b.start < p.stop AND b.stop > p.start)
),
owners AS (
    SELECT hash, owners < 5 AND (owners < 3 OR repositories < 10 * owners) AS live
    FROM (SELECT hash, count(DISTINCT coalesce(source, '')) AS owners,
                 count(DISTINCT doc_id) AS repositories
          FROM apart GROUP BY hash)
),
spans AS (
    SELECT doc_id, kind, live,
           CAST(start AS BIGINT) AS start,
           concat_ws(':', ['assign', 'access', 'hex', 'owned'][kind + 1],
                     CAST(start AS BIGINT), CAST(stop AS BIGINT)) AS span
    FROM apart JOIN owners USING (hash)
    WHERE kind < 3 OR live
)
SELECT doc_id,
       count(*) FILTER (kind = 0) AS n_assign,
       count(*) FILTER (kind = 1) AS n_access,
       count(*) FILTER (kind = 2) AS n_hex,
       count(*) FILTER (kind = 3) AS n_owned,
       sha256(coalesce(string_agg(span, ',' ORDER BY start, kind) FILTER (kind < 3), ''))
           AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY start, kind), '') AS spans,
       count(*) FILTER (live) AS n_live
FROM docs LEFT JOIN spans USING (doc_id)
GROUP BY doc_id
"""

REPETITION = r"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
words AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM docs
),
windows AS (
    SELECT doc_id, i,
           CASE WHEN count(*) OVER eight = 8 THEN string_agg(word, ' ') OVER eight END AS short,
           CASE WHEN count(*) OVER many = 51
                THEN md5(string_agg(word, ' ') OVER many) END AS long
    FROM words
    WINDOW eight AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING),
           many AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 50 FOLLOWING)
),
covered AS (
    SELECT doc_id, count(DISTINCT j) AS n_repeat_words
    FROM (
        SELECT doc_id, unnest(range(i, i + 8)) AS j FROM (
            SELECT doc_id, i FROM windows WHERE short IS NOT NULL
            QUALIFY count(*) OVER (PARTITION BY doc_id, short) > 1
        )
    )
    GROUP BY doc_id
),
too_long AS (
    SELECT DISTINCT doc_id, true AS beyond FROM (
        SELECT doc_id FROM windows WHERE long IS NOT NULL
        GROUP BY doc_id, long HAVING count(*) > 1
    )
),
lines AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM docs)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
    GROUP BY doc_id
),
counts AS (
    SELECT doc_id, len(w) AS n_words,
           length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
           coalesce(n_dup_lines, 0) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words,
           coalesce(beyond, false) AS beyond
    FROM docs LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
    LEFT JOIN too_long USING (doc_id)
)
SELECT * EXCLUDE (beyond),
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT beyond AS kept
FROM counts
"""

SUBSTRING_DEDUP = r"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
words AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM docs
),
windows AS (
    SELECT doc_id, i, md5(text) AS h FROM (
        SELECT doc_id, i, count(*) OVER fifty AS n, string_agg(word, ' ') OVER fifty AS text
        FROM words
        WINDOW fifty AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)
    )
    WHERE n = 50
),
repeated AS (
    SELECT doc_id, i FROM windows QUALIFY doc_id > min(doc_id) OVER (PARTITION BY h)
),
marked AS (
    SELECT doc_id, i, word,
           coalesce(max(r.at) OVER (PARTITION BY doc_id ORDER BY i
                                   ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 0) > 0 AS gone
    FROM words LEFT JOIN (SELECT doc_id, i, i AS at FROM repeated) r USING (doc_id, i)
),
kept AS (
    SELECT doc_id, count(*) FILTER (gone) AS n_removed,
           string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS text
    FROM marked GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

LEXICAL_SEARCH = r"""
WITH tokens AS (
    SELECT kind, id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT 'document' AS kind, doc_id AS id, text FROM documents
          UNION ALL SELECT 'item', item_id, text FROM benchmark)
),
counts AS (SELECT kind, id, term, count(*) AS tf FROM tokens GROUP BY ALL),
lengths AS (SELECT id AS doc_id, sum(tf)::BIGINT AS n FROM counts WHERE kind = 'document' GROUP BY 1),
corpus AS (SELECT count(*) AS documents, sum(n)::BIGINT AS terms FROM lengths),
divisors AS (
    SELECT doc_id, 12 * (100 - 25 + (25 * n * documents) // terms) AS by_length FROM lengths, corpus
),
weights AS (
    SELECT term, floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM counts, corpus WHERE kind = 'document' GROUP BY term, documents
),
scores AS (
    SELECT q.id AS item_id, d.id AS doc_id,
           sum(q.tf * w * ((1000000000 * d.tf) // (1000 * d.tf + by_length)))::BIGINT AS score
    FROM counts q JOIN counts d ON q.kind = 'item' AND d.kind = 'document' AND q.term = d.term
    JOIN weights ON weights.term = q.term JOIN divisors ON divisors.doc_id = d.id
    GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank,
       doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 20
"""

SQL = {
    "op11_lexical_search": LEXICAL_SEARCH,
    "op3_repetition": REPETITION,
    "op4_secrets": SECRETS,
    "op5_exact_dedup": EXACT_DEDUP,
    "op7_substring_dedup": SUBSTRING_DEDUP,
    "op8_warc": WARC,
}
