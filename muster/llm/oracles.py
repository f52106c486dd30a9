"""DuckDB SQL for the queries that SQL can express. It shares no code with the operators."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

RULE_LEDGER = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), triples AS (
  SELECT r, unnest(range(1, len(w) - 1)) AS p, w FROM d WHERE len(w) >= 3
), three AS (
  SELECT r, p, count(*) OVER (PARTITION BY r, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2]) AS n FROM triples
), repeated AS (
  SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest([p, p + 1, p + 2]) AS q FROM three WHERE n > 1) GROUP BY r
), every_line AS (
  SELECT r, unnest(string_split(t, chr(10))) AS l FROM d
), worded AS (
  SELECT r, count(*) AS n, count(*) - count(DISTINCT l) AS again FROM every_line WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r
), m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(worded.again, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words,
         coalesce(worded.n, 0) AS n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS n_letters
  FROM d LEFT JOIN repeated USING (r) LEFT JOIN worded USING (r)
), bits AS (
  SELECT *, CAST(
    CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_symbols > 30 * n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END
    + CASE WHEN 100 * n_upper > 60 * n_letters THEN 64 ELSE 0 END AS BIGINT) AS failed
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & 3) <> 0 AS base_failed, failed = 0 AS kept, failed FROM bits
"""

DECONTAMINATE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS said
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)
), places AS (
  SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n
), hits AS (
  SELECT r, p, places.n, item_id FROM places JOIN item_windows ON places.n = item_windows.n AND array_to_string(w[p:p + places.n - 1], ' ') = said
), words_hit AS (
  SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM hits) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS k FROM hits) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words_hit USING (r) LEFT JOIN items USING (r)
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                               ELSE list_transform(range(1, len(w) - 2), lambda p: array_to_string(w[p:p + 3], ' ')) END) AS s FROM d)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))
), reach(x, y) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
)
SELECT d.doc_id, CAST(coalesce(sizes.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d LEFT JOIN sizes USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) c USING (doc_id)
"""

_OTHER = r"[^\x20\x09-\x0D。！？；，、]"
LINE_DEDUP = rf"""
WITH d AS (
  SELECT doc_id, text, regexp_extract_all(text, '({_OTHER}*[^\x20\x09-\x0D。！？；，、.!?;:,…][\x20\x09\x0B-\x0D]+){{0,11}}({_OTHER}+[。！？；，、]*|[。！？；，、]+)[\x20\x09-\x0D]*|[\x20\x09-\x0D]+') AS l FROM documents
), spots AS (
  SELECT doc_id, unnest(range(1, len(l) - 1)) AS p, l FROM d WHERE len(l) >= 3
), windows AS (
  SELECT doc_id, p, list_transform(l[p:p + 2], lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) AS k FROM spots
), repeated AS (
  SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, p) AS n FROM windows
), gone AS (
  SELECT doc_id, list(DISTINCT q) AS q FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM repeated WHERE n > 1) GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(len(l), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(q), 0) AS BIGINT) AS n_removed,
       CASE WHEN q IS NULL THEN text ELSE array_to_string(list_filter(l, lambda x, i: NOT list_contains(q, i)), '') END AS text
FROM d LEFT JOIN gone ON d.doc_id IS NOT DISTINCT FROM gone.doc_id
"""

SOURCE_DIVERGENCE = rf"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w, row_number() OVER () AS r FROM documents
), said AS (
  SELECT lang, source, r, unnest(w) AS term FROM d
), kept AS (
  SELECT lang, term, CAST(count(*) AS HUGEINT) AS total FROM said GROUP BY lang, term HAVING count(DISTINCT r) >= 3
), langs AS (
  SELECT lang, count(*) AS V, sum(total) AS M FROM kept GROUP BY lang
), counts AS (
  SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM said SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), sizes AS (
  SELECT lang, source, sum(n) AS N FROM counts GROUP BY lang, source
), grouped AS (
  SELECT g.lang, g.source, coalesce(N, 0) AS N, coalesce(V, 0) AS V FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN sizes USING (lang, source) LEFT JOIN langs USING (lang)
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (g.N + g.V) AS p, 1 + (1000000000 * (k.total + 1)) // (l.M + l.V) AS q
  FROM grouped g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(coalesce(total_f, 0) AS BIGINT) AS value
  FROM grouped a JOIN grouped b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS total_f FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL
  ) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
  SELECT lang, source, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT 'pair' AS part, *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS k FROM pairs
  UNION ALL SELECT 'term', *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM terms
)
SELECT lang, source, part, item, value, CAST(k AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR k <= 200
"""

ZIP_ARCHIVES = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages
), named AS (
  SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes, max(page_id) OVER (PARTITION BY t) AS last,
         array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([32768, 1024, 32, 1],
           lambda d: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[CAST(CAST('0x' || h[5 * i + 1:5 * i + 5] AS BIGINT) // d % 32 AS INT) + 1]), '')), '') AS payload_digest
  FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to FROM named
"""


def periodic_runs(bands: int = 22) -> str:
    """Runs by next occurrences: in a run of period q every block of at least q words stands next q words later.

    Blocks of 1, 2, 4, ... words are named by hashes of two halves; a band looks for the periods that its block is long enough for.
    """
    step = "xor(xor(c, e) >> 1, (xor(c, e) & 1) * 3988292384)"
    digits = "flatten(list_transform(range(1, length(s) + 1), lambda i: [CAST(ascii(s[i]) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))"
    parts, found = [], []
    for k in range(bands):
        size, over = 1 << k, (1 << k) // 2
        if k:
            parts.append(
                f"b{k} AS (SELECT r, i, n, h FROM (SELECT r, i, n, hash(h, lead(h, {over}) OVER (PARTITION BY r ORDER BY i)) AS h, i + {size} <= n AS whole"
                f" FROM b{k - 1} WHERE n > {4 * over}) WHERE whole)"
            )
        found.append(
            f"SELECT r, min(i) AS s, max(i) - min(i) + q + {size} AS len, q FROM (SELECT r, i, q, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island"
            f" FROM (SELECT r, i, lead(i) OVER (PARTITION BY r, h ORDER BY i) - i AS q FROM b{k}) WHERE q > {over} AND q <= {size})"
            f" GROUP BY r, q, island HAVING max(i) - min(i) + q + {size} >= greatest(6, 4 * q)"
        )
    return rf"""
WITH ids AS (
  SELECT row_number() OVER () AS r, doc_id, CAST(doc_id AS VARCHAR) AS s, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), d AS (
  SELECT r, doc_id, w, len(w) AS n, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {digits}), lambda c, e: {step}), 4294967295) AS h FROM ids
), planted AS (
  SELECT *, (h // 10) % n AS a, 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8) AS p FROM d WHERE n > 0
), said AS (
  SELECT r, n, i, w[1 + CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END] AS word FROM (SELECT r, n, h, a, p, w, unnest(range(n)) AS i FROM planted)
), b0 AS (
  SELECT r, i, n, hash(word) AS h FROM said
), {", ".join(parts)}, runs AS (
  {" UNION ALL ".join(found)}
), gone AS (
  SELECT DISTINCT r, unnest(range(s + q, s + len)) AS i FROM runs
), kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS t FROM said ANTI JOIN gone USING (r, i) GROUP BY r
), per AS (
  SELECT r, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS listed, arg_max([s, len, q], [len, -s, -q]) AS best FROM runs GROUP BY r
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(best[1] AS BIGINT) AS start, CAST(best[2] AS BIGINT) AS length, CAST(best[3] AS BIGINT) AS period,
       CAST(1000 * best[2] // best[3] AS BIGINT) AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM d LEFT JOIN per USING (r) LEFT JOIN kept USING (r)
"""
