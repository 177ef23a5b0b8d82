"""SQL of the queries that SQL can express."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_REACH = """
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_of AS (SELECT a, min(b) AS m FROM reach GROUP BY a)"""

OP1 = f"""
WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
pairs AS MATERIALIZED (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id < y.vec_id WHERE list_cosine_similarity(x.e, y.e) >= 0.9),
links AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),{_REACH},
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, least(v.vec_id, coalesce(m, v.vec_id)) AS component_id,
       v.vec_id = least(v.vec_id, coalesce(m, v.vec_id)) AS kept
FROM v LEFT JOIN n ON n.a = v.vec_id LEFT JOIN least_of l ON l.a = v.vec_id"""

OP4 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
       ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM w),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM g x JOIN g y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
pairs AS MATERIALIZED (SELECT a, b FROM o JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * o >= 90 * (p.n + q.n - o)),
links AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),{_REACH}
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN least_of l ON l.a = d.doc_id"""

OP9 = rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, range(0, 5) r(k) GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM w),
m AS (SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines,
        len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_stutter
      FROM w JOIN l USING (doc_id) LEFT JOIN cov USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 40 * n_lines
       OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 100 * n_stutter > 30 * n_words) AS kept
FROM m"""

_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
       lambda crc, x: list_reduce(list_prepend(xor(crc, x), range(8)), lambda y, i: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END)))"""

OP12 = rf"""
WITH t AS MATERIALIZED (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
       md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS g, CAST(len({_WORDS}) AS BIGINT) AS w
     FROM conversations WHERE conv_id IS NOT NULL),
c AS MATERIALIZED (SELECT conv_id, conv_id - conv_id % 20 AS base, {_CRC32} % 4 AS h, own FROM (SELECT conv_id, count(*) AS own FROM t GROUP BY conv_id)),
r AS MATERIALIZED (SELECT c.conv_id, pos AS d, g, w FROM c JOIN t ON t.conv_id = base AND pos <= h UNION ALL
     SELECT c.conv_id, least(c.h, coalesce(b.own, 0)) + pos - c.h, g, w FROM c JOIN t USING (conv_id) LEFT JOIN c b ON b.conv_id = c.base WHERE pos > c.h),
p AS MATERIALIZED (SELECT conv_id, d, w, string_agg(g, '') OVER (PARTITION BY conv_id ORDER BY d ROWS UNBOUNDED PRECEDING) AS k FROM r
     UNION ALL SELECT conv_id, 0, 0, '' FROM c),
e AS (SELECT k, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS s FROM (SELECT conv_id, k FROM p QUALIFY d = max(d) OVER (PARTITION BY conv_id)) GROUP BY k),
n AS MATERIALIZED (SELECT k, d, substr(k, 1, 32 * (d - 1)) AS up, min(conv_id) AS conv_id, count(*) AS n, (count(*) - 1) * max(w) AS saved FROM p GROUP BY k, d),
ch AS (SELECT up AS k, count(*) AS n FROM n WHERE d > 0 GROUP BY up),
s AS (SELECT substr(n.k, 1, 32 * i) AS k, sum(saved) AS saved, sum(CASE WHEN ch.n IS NULL THEN 1 ELSE 0 END) AS leaves
      FROM (SELECT k, saved, unnest(range(0, d + 1)) AS i FROM n) n LEFT JOIN ch USING (k) GROUP BY 1)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(ch.n, 0) AS n_children,
       CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, coalesce(e.s, sha256('')) AS ends_sha256
FROM n JOIN s USING (k) LEFT JOIN ch USING (k) LEFT JOIN e USING (k) LEFT JOIN n u ON n.d > 0 AND u.k = n.up"""

SQL: dict[str, str] = {"op1_near_vectors": OP1, "op4_ngram_join": OP4, "op9_quality_rules": OP9, "op12_prefix_trie": OP12}
