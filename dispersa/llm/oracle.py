"""DuckDB SQL for the queries that SQL can express whole."""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# A window is named by its length and its words; items of fewer than ten words have one window.
OP1 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT item_id, least(len(w), 10) AS n, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i, w
  FROM b WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS s FROM bw
), sizes AS (SELECT DISTINCT n FROM windows
), dw AS (
  SELECT doc_id, n, unnest(generate_series(1, len(w) - n + 1)) AS i, w FROM d JOIN sizes ON len(w) >= n
), found AS (
  SELECT doc_id, item_id, dw.n, i
  FROM (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS s FROM dw) dw
  JOIN windows USING (n, s)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS k FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP4 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), three AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS often
  FROM (SELECT doc_id, i, array_to_string(w[i : i + 2], ' ') AS s
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM d))
), again AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM three WHERE often > 1) GROUP BY doc_id
), split AS (
  SELECT doc_id, unnest(x) AS line, unnest(generate_series(1, len(x))) AS i
  FROM (SELECT doc_id, string_split(t, chr(10)) AS x FROM d)
), l AS (
  SELECT doc_id, line, w, len(w) AS n, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) > 1 AS dup,
         length(array_to_string(w, '')) AS chars, length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) AS symbols,
         length(regexp_replace(line, '[^A-ZÀ-ÖØ-Þ]', '', 'g')) AS upper_letters,
         length(regexp_replace(line, '[^A-ZÀ-ÖØ-Þa-zß-öø-ÿ]', '', 'g')) AS letters
  FROM (SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM split) WHERE len(w) > 0
), judged AS (
  SELECT doc_id, n, dup, dup
      OR NOT (regexp_matches(w[-1], '[.!?"'')…”’。！？]$')
              OR n >= 20 AND len(list_filter(w, lambda x: regexp_matches(x, '[.!?"'')]$'))) > 0)
      OR symbols > 0.1::DOUBLE * chars
      OR len(list_filter(w, lambda x: x IN ('|', '>', '/', '-'))) >= greatest(2, 0.2::DOUBLE * n)
      OR letters >= 10 AND upper_letters > 0.6::DOUBLE * letters
      OR regexp_matches(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '(^|[^0-9a-z])(lorem ipsum|javascript|cookie policy|privacy policy|terms of use|terms of service'
           || '|all rights reserved|sign in|log in|read more|click here|subscribe to our newsletter|share this'
           || '|licensed under the)([^0-9a-z]|$)') AS fails
  FROM l
), per AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dup) AS n_dup, count(*) FILTER (fails) AS n_bad,
         coalesce(sum(n) FILTER (fails), 0) AS lost
  FROM judged GROUP BY doc_id
), counted AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat, 0)::BIGINT AS n_repeat_words,
         coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_bad, 0)::BIGINT AS n_bad_lines,
         coalesce(lost, 0)::BIGINT AS n_lost_words
  FROM d LEFT JOIN per USING (doc_id) LEFT JOIN again USING (doc_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_lost_words <= 0.3::DOUBLE * n_words AS kept
FROM counted
"""

# Nodes of every depth; a row's leaf is the first one on its path that fits or has a single key.
OP5 = """
WITH k AS (
  SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT AS n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '/' || coalesce(text, '')), 1, 15))::BIGINT AS h
  FROM documents
), nodes AS (
  SELECT d, h >> (60 - d) AS p, sum(n_bytes) AS s, min(h) = max(h) AS one
  FROM k, range(0, 61) t(d) GROUP BY 1, 2
), leaf AS (
  SELECT k.doc_id, k.n_bytes, k.h, min(n.d) AS d
  FROM k, range(0, 61) t(d) JOIN nodes n ON n.d = t.d AND n.p = k.h >> (60 - t.d)
  WHERE n.s <= 1048576 OR n.one GROUP BY ALL
)
SELECT l.doc_id, l.n_bytes,
       CASE WHEN l.d = 0 THEN '' ELSE lpad(bin(l.h >> (60 - l.d)), l.d::INTEGER, '0') END AS shard,
       l.d::INTEGER AS depth, n.s::BIGINT AS shard_bytes, n.s <= 1048576 AS fits
FROM leaf l JOIN nodes n ON n.d = l.d AND n.p = l.h >> (60 - l.d)
"""

# Strings and runs of words are compared by MD5. Runs that overlap or touch, word to word, are one passage, from
# its first word's first byte to its last word's last byte.
OP7 = r"""
WITH d AS (
  SELECT doc_id, encode(t) AS b, octet_length(encode(t)) AS n, count(*) OVER (PARTITION BY t) > 1 AS copied,
         regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+') AS pieces
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
), starts AS (
  SELECT doc_id, p, count(*) OVER (PARTITION BY m) AS often
  FROM (SELECT doc_id, p, md5(b[p : p + 399]) AS m
        FROM (SELECT doc_id, b, unnest(generate_series(1, n - 399)) AS p FROM d))
), strings AS (SELECT doc_id, p AS lo, p + 399 AS hi FROM starts WHERE often > 1
), word_ends AS (
  SELECT doc_id, k, word, sum(size) OVER (PARTITION BY doc_id ORDER BY k) AS word_end
  FROM (SELECT doc_id, k, octet_length(encode(piece)) AS size, ltrim(piece, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS word
        FROM (SELECT doc_id, unnest(pieces) AS piece, unnest(generate_series(1, len(pieces))) AS k FROM d))
), placed AS (
  SELECT doc_id, list(word ORDER BY k) AS w, list(word_end ORDER BY k) AS ends FROM word_ends GROUP BY doc_id
), runs AS (
  SELECT doc_id, k, count(*) OVER (PARTITION BY m) AS often
  FROM (SELECT doc_id, k, md5(array_to_string(w[k : k + 50], ' ')) AS m
        FROM (SELECT *, unnest(generate_series(1, len(w) - 50)) AS k FROM placed))
), run_spans AS (
  SELECT doc_id, min(k) AS first_word, max(k) + 50 AS last_word
  FROM (SELECT doc_id, k, count(*) FILTER (opens) OVER (PARTITION BY doc_id ORDER BY k) AS span
        FROM (SELECT doc_id, k, k > 51 + lag(k) OVER (PARTITION BY doc_id ORDER BY k) AS opens FROM runs WHERE often > 1))
  GROUP BY doc_id, span
), passages AS (
  SELECT doc_id, ends[first_word] - octet_length(encode(w[first_word])) + 1 AS lo, ends[last_word] AS hi
  FROM run_spans JOIN placed USING (doc_id)
), wholes AS (SELECT doc_id, 1 AS lo, n AS hi FROM d WHERE copied AND len(pieces) >= 51
), covers AS (
  SELECT 1 AS kind, * FROM strings
  UNION ALL SELECT 2, * FROM strings
  UNION ALL SELECT 2, * FROM passages
  UNION ALL SELECT 2, * FROM wholes
), marked AS (
  SELECT *, lo > 1 + max(hi) OVER (PARTITION BY kind, doc_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS opens
  FROM covers
), numbered AS (
  SELECT *, count(*) FILTER (opens) OVER (PARTITION BY kind, doc_id ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS span FROM marked
), spans AS (SELECT kind, doc_id, span, min(lo) AS lo, max(hi) AS hi FROM numbered GROUP BY ALL
), removed AS (
  SELECT doc_id, sum(hi - lo + 1) FILTER (kind = 1) AS bytes, count(*) FILTER (kind = 1) AS n_spans,
         sum(hi - lo + 1) FILTER (kind = 2) AS passage_bytes, count(*) FILTER (kind = 2) AS n_passages
  FROM spans GROUP BY doc_id
), left_over AS (
  SELECT doc_id, string_agg(hex(b[after + 1 : lo - 1]), '' ORDER BY lo) AS h
  FROM (SELECT doc_id, lo, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS after
        FROM (SELECT doc_id, lo, hi FROM spans WHERE kind = 1 UNION ALL SELECT doc_id, n + 1, n + 1 FROM d))
  JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(bytes, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(h)) AS kept_sha256, coalesce(passage_bytes, 0)::BIGINT AS passage_bytes,
       coalesce(n_passages, 0)::BIGINT AS n_passages
FROM d LEFT JOIN removed USING (doc_id) LEFT JOIN left_over USING (doc_id)
"""

# Every pair of documents with a common shingle is counted; components by walking all links.
OP10 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i : i + 3], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS i FROM d WHERE len(w) > 0)
), size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), link AS (
  SELECT x, y FROM common JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)
), two_way AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link
), reach AS (
  SELECT x, y FROM two_way
  UNION SELECT reach.x, two_way.y FROM reach JOIN two_way ON reach.y = two_way.x
), least_of AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(y, d.doc_id)) AS component_id
FROM d LEFT JOIN size ON size.doc_id = d.doc_id LEFT JOIN least_of ON x = d.doc_id
"""

ORACLE: dict[str, str] = {
    "op1_decontamination": OP1,
    "op4_quality_rules": OP4,
    "op5_sharding": OP5,
    "op7_suffix_dedup": OP7,
    "op10_jaccard_groups": OP10,
}
