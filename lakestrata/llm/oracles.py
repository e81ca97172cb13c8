"""DuckDB SQL for the queries over the training-data tables."""

from __future__ import annotations

OP1 = r"""
WITH p AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), g AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM g
"""

OP3 = r"""
WITH d AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
    doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""

# The notices that the tables hold, by their canonical text.
OP2 = r"""
WITH known(licence, canon) AS (VALUES
    ('Apache-2.0', 'licensed under the apache license version 2 0'),
    ('Apache-2.0', 'released under the apache license version 2 0'),
    ('CC-BY-4.0', 'licensed under cc by 4 0'),
    ('CC-BY-NC-4.0', 'licensed under cc by nc 4 0'),
    ('CC-BY-SA-4.0', 'licensed under cc by sa 4 0'),
    ('GPL-2.0', 'this work is licensed under the gnu general public license version 2'),
    ('GPL-3.0', 'this work is licensed under the gnu general public license version 3'),
    ('MIT', 'licensed under the mit license'),
    ('MIT', 'released under the mit license')
), d AS (
    SELECT doc_id, replace(coalesce(text, ''), chr(13) || chr(10), chr(10)) AS t FROM documents
), units AS (
    SELECT doc_id, 'whole' AS unit, t FROM d
    UNION ALL
    SELECT doc_id, 'line', unnest(string_split(t, chr(10))) FROM d
    UNION ALL
    SELECT * FROM (SELECT doc_id, 'paragraph', unnest(string_split_regex(t, '\n[\x20\x09]*\n\s*')) AS t FROM d)
    WHERE contains(trim(t), chr(10))
), hits AS (
    SELECT doc_id, unit, licence FROM units JOIN known ON known.canon = trim(replace(regexp_replace(
        lower(regexp_replace(t, '(?im)^[\x20\x09\r]*(copyright|\(c\)|©|all rights reserved)[^\n]*$', ' ', 'g')),
        '[^\p{L}\p{N}]+', ' ', 'g'), 'licence', 'license'))
), g AS (
    SELECT doc_id, max(licence) FILTER (unit = 'whole') AS licence,
        string_agg(DISTINCT licence, ',' ORDER BY licence) FILTER (unit <> 'whole') AS notices,
        count(*) FILTER (unit <> 'whole') AS n_notices
    FROM hits GROUP BY doc_id
)
SELECT doc_id, licence, coalesce(notices, '') AS notices, coalesce(n_notices, 0) AS n_notices
FROM d LEFT JOIN g USING (doc_id)
"""

# The checksum is the usual one over the reflected polynomial 0xEDB88320.
OP10 = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size FROM documents
), turns AS (
    SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, CAST(i AS BIGINT))) AS t
), texts AS (
    SELECT DISTINCT t FROM d
), sums AS (
    SELECT texts.t, xor(4294967295, list_reduce(
        list_transform(regexp_extract_all(hex(encode(texts.t)), '..'), lambda h: CAST('0x' || h AS BIGINT)),
        lambda c, b: xor(c >> 8, turns.t[CAST(xor(c, b) & 255 AS INTEGER) + 1]), 4294967295)) AS text_crc32
    FROM texts, turns
), placed AS (
    SELECT doc_id, size, text_crc32,
        sum(size) OVER (ORDER BY doc_id, size, text_crc32 ROWS UNBOUNDED PRECEDING) AS upto,
        sum(size) OVER () AS total
    FROM d JOIN sums USING (t)
), cut AS (
    SELECT doc_id, size, text_crc32,
        CAST(least(floor((2 * upto - size) * 8 / (2 * total)), 7) AS INTEGER) AS shard
    FROM placed
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
    row_number() OVER (PARTITION BY shard ORDER BY doc_id, size, text_crc32) - 1 AS slot,
    CAST(NULL AS INTEGER) AS grown_shard
FROM cut
"""

# Patterns, known texts and spellings are written out here, not taken from the operators.
_PATTERNS = (
    (0, "assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    (1, "access", r"AKIA[A-Z0-9]+", 0, 20),
    (2, "hex", r"[0-9a-f]+", 0, 24),
    (3, "part_id", r"""(?i)(user|username|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]+)""", 2, 3),
    (4, "part_secret", r"""(?i)(pwd|pass|pin|auth|credential|private_?key)["']?\x20*[:=]\x20*["']?([^\x20\x09-\x0D"'<>,;]+)""", 2, 4),
    (5, "part_endpoint", r"""(?i)(https?|ftp|ssh|jdbc:[a-z]+|postgres|mysql|redis|amqp|mongodb)://([A-Za-z0-9._~:/?#@!$&()*+=%-]+)""", 2, 4),
)


def _matches(at: int, kind: str, pattern: str, group: int, least: int) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
    SELECT doc_id, {at} AS kind_at, '{kind}' AS kind, nth, gap, size, value >= {least} AS long FROM (
        SELECT doc_id, unnest(range(1, len(m) + 1)) AS nth, unnest(list_transform(g[1:len(m)], lambda x: length(x))) AS gap,
            unnest(list_transform(m, lambda x: length(x))) AS size, unnest(list_transform(v, lambda x: length(x))) AS value
        FROM (SELECT doc_id, string_split_regex(t, '{quoted}') AS g, regexp_extract_all(t, '{quoted}', 0) AS m,
            regexp_extract_all(t, '{quoted}', {group}) AS v FROM d))"""


OP7 = (
    "WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), parts AS ("
    + " UNION ALL ".join(_matches(*p) for p in _PATTERNS)
    + """
), placed AS (
    SELECT doc_id, kind_at, kind, "end" - size AS start, "end" FROM (
        SELECT *, sum(gap + size) OVER (PARTITION BY doc_id, kind_at ORDER BY nth) AS "end" FROM parts)
    WHERE long
), apart AS (
    SELECT * FROM placed p WHERE kind_at < 3 OR NOT EXISTS (
        SELECT 1 FROM placed b WHERE b.doc_id = p.doc_id AND b.kind_at < 3 AND b.start < p."end" AND b."end" > p.start)
), linked AS (
    SELECT *, bool_or(kind IN ('access', 'part_id')) OVER near AS named,
        bool_or(kind IN ('assign', 'hex', 'part_secret')) OVER near AS secret
    FROM apart WINDOW near AS (PARTITION BY doc_id ORDER BY start RANGE BETWEEN 200 PRECEDING AND 200 FOLLOWING)
), kept AS (
    SELECT *, kind || ':' || CAST(CAST(start AS BIGINT) AS VARCHAR) || ':' || CAST(CAST("end" AS BIGINT) AS VARCHAR) AS span
    FROM linked
    WHERE kind_at < 3 OR (kind = 'part_id' AND secret) OR (kind = 'part_secret' AND named)
        OR (kind = 'part_endpoint' AND named AND secret)
), g AS (
    SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
        count(*) FILTER (kind = 'hex') AS n_hex,
        string_agg(span, ',' ORDER BY start, kind_at) FILTER (kind_at < 3) AS base,
        string_agg(span, ',' ORDER BY start, kind_at) AS spans
    FROM kept GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""
)

# Windows over words instead of passes over arrays; the same checksum as above, of each word.
OP11 = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t FROM documents
), n AS (
    SELECT doc_id, t, length(t) // 2 AS half,
        coalesce(lead(t) OVER (ORDER BY doc_id DESC), first_value(t) OVER (ORDER BY doc_id DESC)) AS next
    FROM d
), e AS (
    SELECT doc_id, t, next, substr(t, 1, length(t) - half) || substr(next, 1, half) AS edited FROM n
), texts AS (
    SELECT t, row_number() OVER () AS k FROM (SELECT t FROM e UNION SELECT edited FROM e)
), words AS (
    SELECT k, unnest(m) AS word, generate_subscripts(m, 1) - 1 AS i, len(m) AS n FROM (
        SELECT k, regexp_extract_all(t, '[\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{2E80}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}]|[^\x20\x09-\x0D\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{2E80}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}]+') AS m
        FROM texts)
), turns AS (
    SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, CAST(i AS BIGINT))) AS t
), sums AS (
    SELECT word, xor(4294967295, list_reduce(
        list_transform(regexp_extract_all(hex(encode(word)), '..'), lambda h: CAST('0x' || h AS BIGINT)),
        lambda c, b: xor(c >> 8, turns.t[CAST(xor(c, b) & 255 AS INTEGER) + 1]), 4294967295)) AS c
    FROM (SELECT DISTINCT word FROM words), turns
), runs AS (
    SELECT k, i, n, ((((c * 1000003
        + coalesce(lead(c, 1) OVER w, 0)) % 137438953447 * 1000003
        + coalesce(lead(c, 2) OVER w, 0)) % 137438953447 * 1000003
        + coalesce(lead(c, 3) OVER w, 0)) % 137438953447 * 1000003
        + coalesce(lead(c, 4) OVER w, 0)) % 137438953447 AS h
    FROM words JOIN sums USING (word) WINDOW w AS (PARTITION BY k ORDER BY i)
), places AS (
    SELECT k, i, greatest(n - 4, 1) AS n,
        arg_min(i, (h, -i)) OVER near AS place, min(h) OVER near AS h
    FROM runs WHERE i < greatest(n - 4, 1)
    WINDOW near AS (PARTITION BY k ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)
), prints AS (
    SELECT k, sha256(string_agg(h || ':' || place, ',' ORDER BY place)) AS print, list(DISTINCT h) AS hs
    FROM (SELECT DISTINCT k, h, place FROM places WHERE i < greatest(n - 7, 1)) GROUP BY k
), every AS (
    SELECT t, coalesce(print, sha256('')) AS print, coalesce(hs, []) AS hs FROM texts LEFT JOIN prints USING (k)
)
SELECT doc_id, length(e.t) AS n_chars, sha256(e.edited) AS edited_sha256,
    own.print AS fingerprint, edit.print AS edited_fingerprint,
    CASE WHEN len(own.hs) + len(edit.hs) = 0 THEN 1
        ELSE len(list_intersect(own.hs, edit.hs)) / len(list_distinct(list_concat(own.hs, edit.hs))) END AS near_edited,
    CASE WHEN len(own.hs) + len(after.hs) = 0 THEN 1
        ELSE len(list_intersect(own.hs, after.hs)) / len(list_distinct(list_concat(own.hs, after.hs))) END AS near_next
FROM e JOIN every own ON own.t = e.t JOIN every edit ON edit.t = e.edited JOIN every after ON after.t = e.next
"""

# All distances in every round; the numbers are small enough for doubles to be exact.
def _coding_round(n: int) -> str:
    return f"""
near{n} AS MATERIALIZED (
    SELECT vec_id, part, arg_min(entry, (far, entry)) AS entry, min(far) AS far FROM (
        SELECT vec_id, part, entry,
            list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c) AS far
        FROM parts JOIN books{n} USING (part))
    GROUP BY vec_id, part
), means{n} AS MATERIALIZED (
    SELECT part, entry, list(mean ORDER BY place) AS c FROM (
        SELECT part, entry, place, floor(sum(x[place]) / count(*)) AS mean
        FROM near{n} JOIN parts USING (vec_id, part), (SELECT unnest(range(1, (SELECT max(len(x)) FROM parts) + 1)) AS place)
        GROUP BY part, entry, place)
    GROUP BY part, entry
), books{n + 1} AS MATERIALIZED (
    SELECT part, entry, coalesce(means{n}.c, books{n}.c) AS c FROM books{n} LEFT JOIN means{n} USING (part, entry)
),"""


OP13 = (
    """
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda v: floor(CAST(v AS DOUBLE) * 1024)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
), parts AS MATERIALIZED (
    SELECT vec_id, part, v[part * len(v) // 4 + 1:(part + 1) * len(v) // 4] AS x
    FROM kept, (SELECT unnest(range(4)) AS part)
), books0 AS MATERIALIZED (
    SELECT part, entry, x AS c FROM parts JOIN (
        SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT 256) USING (vec_id)
),"""
    + "".join(_coding_round(n) for n in range(4))
    + _coding_round(4).split("), means4")[0]
    + """), coded AS (
    SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error
    FROM near4 GROUP BY vec_id
), book AS (
    SELECT sha256(string_agg(array_to_string(list_transform(c, lambda v: CAST(CAST(v AS BIGINT) AS VARCHAR)), ','), ','
        ORDER BY part, entry)) AS codebooks_sha256
    FROM books4
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), book
"""
)

ORACLE_SQL: dict[str, str] = {
    "op1_warc": OP1,
    "op2_licence_scan": OP2,
    "op3_exact_dedup": OP3,
    "op7_secret_scan": OP7,
    "op10_sharding": OP10,
    "op11_winnowing": OP11,
    "op13_vector_codes": OP13,
}
