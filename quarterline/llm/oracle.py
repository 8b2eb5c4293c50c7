"""DuckDB SQL of the queries that SQL can express."""
from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op2_warc_chunks"] = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS body, octet_length(encode(coalesce(html, ''))) AS payload_bytes
    FROM pages
), d AS (SELECT *, sha256(body) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM f
"""

_ASSIGN = ("([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
           "[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)")


def _kind(kind: str, at: int, pattern: str, part: int, least: int) -> str:
    """The spans of one kind: what stands between matches has the lengths that place them."""
    return f"""
    SELECT doc_id, {at} AS k, '{kind}' AS kind,
           sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id ORDER BY i) - length(hit) AS a,
           sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id ORDER BY i) AS b, length(part) >= {least} AS kept
    FROM (SELECT doc_id, unnest(hits) AS hit, unnest(parts) AS part, unnest(gaps[:len(hits)]) AS gap, unnest(range(len(hits))) AS i
          FROM (SELECT doc_id, regexp_extract_all(body, '{pattern}') AS hits, regexp_extract_all(body, '{pattern}', {part}) AS parts,
                       regexp_split_to_array(body, '{pattern}') AS gaps
                FROM docs WHERE regexp_matches(body, '{pattern}')))"""


ORACLE["op9_secret_scan"] = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
s AS ({_kind('assign', 0, _ASSIGN, 2, 8)} UNION ALL {_kind('access', 1, 'AKIA[A-Z0-9]+', 0, 16)}
      UNION ALL {_kind('hex', 2, '[0-9a-f]{32,}', 0, 32)}),
g AS (SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
             string_agg(kind || ':' || CAST(a AS BIGINT) || ':' || CAST(b AS BIGINT), ',' ORDER BY a, k) AS spans
      FROM s WHERE kept GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN g USING (doc_id)
"""

ORACLE["op3_maxscore_topk"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS w
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.w, c.w) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""

ORACLE["op1_minhash_dedup"] = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
    FROM documents
), s AS (
    SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
        ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) END AS sh
    FROM w
), e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
l AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), r AS (SELECT doc_id, doc_id AS m FROM s UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.m)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, c.component_id, c.component_id = s.doc_id AS kept
FROM s JOIN (SELECT doc_id, min(m) AS component_id FROM r GROUP BY doc_id) c USING (doc_id)
"""

# crc32 is linear: a byte's part depends on how many bytes follow it, the register's on the length
ORACLE["op12_importance_draw"] = r"""
WITH RECURSIVE words AS (
    SELECT 's' AS side, row_number() OVER () AS row, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w, doc_id FROM documents
    UNION ALL
    SELECT 't', -row_number() OVER (), regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), NULL FROM benchmark
), occurs AS (
    SELECT side, row, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM words
), per_row AS (SELECT side, row, f, count(*) AS n FROM occurs GROUP BY ALL),
feature AS (SELECT f, octet_length(encode(f)) AS size, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM per_row)),
t AS (
    SELECT b, list_reduce(list_prepend(b, CAST(range(8) AS BIGINT[])), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS b)
), part AS (
    SELECT 0 AS k, b, c FROM t
    UNION ALL SELECT k + 1, part.b, xor(part.c >> 8, t.c) FROM part JOIN t ON t.b = part.c & 255 WHERE k + 1 < (SELECT max(size) FROM feature)
), register AS (
    SELECT 0 AS size, 4294967295 AS c
    UNION ALL SELECT size + 1, xor(register.c >> 8, t.c) FROM register JOIN t ON t.b = register.c & 255 WHERE size < (SELECT max(size) FROM feature)
), byte AS (
    SELECT f, size, size - 1 - i AS k, CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT) AS b FROM (SELECT f, size, x, unnest(range(size)) AS i FROM feature)
), bucketed AS (
    SELECT f, xor(xor(any_value(register.c), bit_xor(part.c)), 4294967295) % 10000 AS bucket
    FROM byte JOIN part USING (k, b) JOIN register USING (size) GROUP BY f
), counted AS (
    SELECT bucket, sum(n) FILTER (side = 's') AS s, sum(n) FILTER (side = 't') AS t FROM per_row JOIN bucketed USING (f) GROUP BY bucket
), gain AS (
    SELECT bucket, floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * (sum(s) OVER () + 10000)
                                   / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * (coalesce(sum(t) OVER (), 0) + 10000)))) AS g
    FROM counted
), weighed AS (
    SELECT row, sum(n) AS n, floor(sum(n * g) / sum(n)) AS weight FROM per_row JOIN bucketed USING (f) JOIN gain USING (bucket) WHERE side = 's' GROUP BY row
), scored AS (
    SELECT doc_id, len(w) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
           CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) + 0.5) / 4294967296.0))) AS BIGINT) AS score
    FROM words LEFT JOIN weighed USING (row) WHERE side = 's'
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (n_words >= 20) OVER () AS eligible FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= floor(25 * eligible / 100) THEN place END AS rank FROM ranked
"""

_CRC_TABLE = ("SELECT list(list_reduce(list_prepend(b, CAST(range(8) AS BIGINT[])), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t "
              "FROM (SELECT unnest(range(256)) AS b)")


def _crc32(text: str, table: str) -> str:
    """crc32 of a short ASCII text, given the list of the 256 remainders."""
    return (f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))), "
            f"lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1])), 4294967295)")


def _discounts(name: str, counts: str) -> str:
    """For one order of n-grams the share that counts of 1 to 5 keep, and up to which they are estimated."""
    return f"""
{name}_n AS (SELECT r, (SELECT count(*) FROM {counts} WHERE c = r) AS n FROM (SELECT unnest(range(1, 7)) AS r)),
{name}_try AS (
    SELECT k.r AS k, a.r, (b.r * b.n / nullif(a.r * a.n, 0) - k1.r * k1.n / nullif(one.n, 0)) / nullif(1 - k1.r * k1.n / nullif(one.n, 0), 0) AS d, a.n > 0 AND b.n > 0 AND k1.r * k1.n < one.n AS ok
    FROM {name}_n k JOIN {name}_n k1 ON k1.r = k.r + 1 JOIN {name}_n a ON a.r <= k.r JOIN {name}_n b ON b.r = a.r + 1 JOIN {name}_n one ON one.r = 1
), {name}_k AS (SELECT max(k) AS k FROM (SELECT k FROM {name}_try GROUP BY k HAVING bool_and(coalesce(ok AND d > 0 AND d < 1, false)))),
{name}_d AS (
    SELECT n.r, CASE WHEN k.k IS NULL THEN (n.r - 0.5) / n.r ELSE coalesce(t.d, 1) END AS d, coalesce(k.k, 5) AS k
    FROM {name}_n n CROSS JOIN {name}_k k LEFT JOIN {name}_try t ON t.k = k.k AND t.r = n.r WHERE n.r <= 5
)"""


ORACLE["op11_katz_backoff"] = rf"""
WITH crc AS ({_CRC_TABLE}),
docs AS (
    SELECT row_number() OVER () AS row, doc_id, {_crc32("CAST(doc_id AS VARCHAR)", "t")} % 7 = 2 AS held_out,
           list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
    FROM documents CROSS JOIN crc
), token AS (SELECT row, held_out, unnest(list_prepend(chr(10) || chr(10), words)) AS v, unnest(list_append(words, chr(10))) AS w FROM docs),
uni AS (SELECT w, count(*) AS c FROM token WHERE NOT held_out GROUP BY w),
bi AS (SELECT v, w, count(*) AS c FROM token WHERE NOT held_out GROUP BY v, w),
{_discounts('u', 'uni')}, {_discounts('b', 'bi')},
size AS (SELECT CAST(sum(c) AS BIGINT) AS n, count(*) AS types, coalesce(sum(c * (1 - d)), 0) AS rest FROM uni LEFT JOIN u_d ON u_d.r = uni.c),
whole AS (
    SELECT *, CASE WHEN rest > 0 THEN n ELSE n + 1 END AS all_,
           CASE WHEN rest > 0 THEN rest ELSE 1 END / CASE WHEN rest > 0 THEN n ELSE n + 1 END
               / (1 + (SELECT a.n * (a.n - 1) // (2 * (b.n + 1)) FROM u_n a, u_n b WHERE a.r = 1 AND b.r = 2)) AS unseen
    FROM size
), p1 AS (SELECT w, c, c * coalesce(d, 1) / all_ AS p FROM uni CROSS JOIN whole LEFT JOIN u_d ON u_d.r = uni.c),
context AS (
    SELECT v, sum(bi.c) AS c, sum(CASE WHEN d.r IS NULL THEN 0 ELSE bi.c * (1 - d.d) END) AS rest, bool_or(d.r <= d.k) AS leaves, sum(p1.p) AS reaches
    FROM bi JOIN p1 USING (w) LEFT JOIN b_d d ON d.r = bi.c GROUP BY v
), weight AS (
    SELECT v, CASE WHEN leaves THEN c ELSE c + 1 END AS all_, CASE WHEN leaves THEN rest ELSE 1 END / CASE WHEN leaves THEN c ELSE c + 1 END / (1 - reaches) AS a FROM context
), scored AS (
    SELECT row, p1.c, bi.c IS NULL AS backed,
           CASE WHEN bi.c IS NOT NULL THEN log10(bi.c * coalesce(d.d, 1) / weight.all_) ELSE log10(coalesce(weight.a, 1)) + log10(coalesce(p1.p, whole.unseen)) END AS s,
           log10((coalesce(p1.c, 0) + 1) / (whole.n + whole.types + 1)) AS b
    FROM token CROSS JOIN whole LEFT JOIN p1 USING (w) LEFT JOIN bi USING (v, w) LEFT JOIN weight USING (v) LEFT JOIN b_d d ON d.r = bi.c
)
SELECT doc_id, held_out, count(*) AS n_tokens, count(c) AS n_known, any_value(n) AS train_tokens, round(sum(b), 6) AS base_score, round(sum(s), 6) AS score,
       count(*) FILTER (backed) AS n_backed_off
FROM scored JOIN docs USING (row) CROSS JOIN size GROUP BY row, doc_id, held_out
"""
