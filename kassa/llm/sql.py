"""DuckDB SQL of the operators that SQL can express, for the value check.

Written from the contract of each query, over the same tables.
"""

import re

from kassa.llm.license_scan import TEMPLATES

_FOLD = "translate(coalesce({t}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_NOT_SPACE = r"'[^\x20\x09-\x0D]+'"

_OP2 = rf"""
WITH bench AS (
  SELECT item_id, regexp_extract_all({_FOLD.format(t="text")}, {_ALNUM}) AS w FROM benchmark
), wins AS (
  SELECT DISTINCT item_id, CAST(least(len(w), 10) AS INT) AS size, w[i:i + least(len(w), 10) - 1] AS win
  FROM bench, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(i) WHERE len(w) > 0
), doc AS (
  SELECT doc_id, regexp_extract_all({_FOLD.format(t="text")}, {_ALNUM}) AS w FROM documents
), sizes AS (SELECT DISTINCT size FROM wins),
spots AS (
  SELECT doc_id, size, i, w[i:i + size - 1] AS win
  FROM doc, sizes, unnest(range(1, len(w) - size + 2)) AS u(i)
), found AS (
  SELECT s.doc_id, s.i, s.size, x.item_id FROM spots s JOIN wins x ON s.size = x.size AND s.win = x.win
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
    SELECT doc_id, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT doc_id, i, size FROM found)
  ) GROUP BY doc_id
), its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""

_OP4 = rf"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_NOT_SPACE}) AS w FROM documents
), grams AS (
  SELECT doc_id, i, w[i:i + 2] AS g FROM doc, unnest(range(1, len(w) - 1)) AS u(i)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1
), rep AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id
), cut AS (
  SELECT doc_id, j, lines[j] AS line, regexp_extract_all(lines[j], {_NOT_SPACE}) AS lw
  FROM (SELECT doc_id, string_split(t, chr(10)) AS lines FROM doc), unnest(range(1, len(lines) + 1)) AS u(j)
), line AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, line ORDER BY j) > 1 AS dup,
         length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) AS signs,
         translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM cut WHERE len(lw) > 0
), judged AS (
  SELECT doc_id, dup, len(lw) AS n,
    (signs > 0 AND (CASE WHEN ended THEN 3 ELSE 10 END) * signs >= len(lw))
    OR (NOT ended AND (len(lw) < 4 OR seps > 1 AND 4 * seps >= len(lw) OR 2 * menu >= len(lw)))
    OR contains(low, 'all rights reserved') OR contains(low, 'cookie policy') OR contains(low, 'enable javascript')
    OR contains(low, 'privacy policy') OR contains(low, 'terms of service')
    OR contains(low, 'subscribe to our newsletter') OR contains(low, 'click here to')
    OR contains(low, 'log in to') OR contains(low, 'sign up for') AS bad
  FROM (
    SELECT *, regexp_matches(line, '(\.|!|\?|…|:|;)["'')\]}}]*[\x20\x09-\x0D]*$') AS ended,
      len(list_filter(lw, lambda x: x IN ('|', '>', '<', '>>', '<<', '/', '//', '·', '•', '»', '«', '›', '‹', '→', '←'))) AS seps,
      len(list_filter(regexp_extract_all(low, {_NOT_SPACE}), lambda x: x IN (
        'home', 'about', 'contact', 'login', 'logout', 'register', 'search', 'news', 'blog', 'products', 'services',
        'shop', 'cart', 'checkout', 'account', 'help', 'support', 'faq', 'sitemap', 'careers', 'press', 'privacy',
        'terms', 'imprint', 'menu', 'next', 'previous', 'back', 'more', 'share', 'print', 'rss'))) AS menu
    FROM line
  )
), lost AS (
  SELECT doc_id, sum(CASE WHEN dup THEN 1 ELSE 0 END) AS n_dup_lines,
         sum(CASE WHEN dup OR bad THEN n ELSE 0 END) AS n_lost
  FROM judged GROUP BY doc_id
), base AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(n_lost, 0) AS BIGINT) AS n_lost_words
  FROM doc LEFT JOIN rep USING (doc_id) LEFT JOIN lost USING (doc_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * n_lost_words <= 50 * n_words AS kept
FROM base
"""

_OP5 = r"""
WITH doc AS (
  SELECT doc_id, encode(coalesce(text, '')) AS raw, lower(hex(encode(coalesce(text, '')))) AS h FROM documents
), spot AS (
  SELECT doc_id, p, raw[p + 1:p + 50] AS s FROM doc, unnest(range(0, octet_length(raw) - 49)) AS u(p)
), low AS (SELECT s, min(doc_id) AS first FROM spot GROUP BY s HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT doc_id, p FROM spot JOIN low USING (s) WHERE first < doc_id),
gaps AS (
  SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS q FROM hit
), runs AS (
  SELECT doc_id, p, sum(CASE WHEN q IS NULL OR p > q + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS r
  FROM gaps
), span AS (
  SELECT doc_id, r, min(p) AS a, max(p) + 50 AS b FROM runs GROUP BY doc_id, r
), kept AS (  -- what stands before each span and after the last
  SELECT s.doc_id, coalesce(lag(b) OVER w, 0) AS x, a AS y FROM span s WINDOW w AS (PARTITION BY s.doc_id ORDER BY a)
  UNION ALL
  SELECT s.doc_id, max(b), any_value(length(h)) // 2 FROM span s JOIN doc USING (doc_id) GROUP BY s.doc_id
), left_over AS (
  SELECT doc_id, string_agg(substr(h, CAST(2 * x + 1 AS BIGINT), CAST(2 * (y - x) AS BIGINT)), '' ORDER BY x) AS k
  FROM kept JOIN doc USING (doc_id) GROUP BY doc_id
), sums AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM span GROUP BY doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM doc LEFT JOIN sums USING (doc_id) LEFT JOIN left_over USING (doc_id)
"""

def _pattern(wording: str) -> str:
    """A wording as a pattern over words joined by blanks.  A region that may be
    absent at its start or end adds nothing there."""
    wording = re.sub(r"^\[\[[^\]]*\]\] | \[\[[^\]]*\]\]$", "", wording)
    wording = re.sub(r"\[\[([^\]]*)\]\] ", r"(\1 )?", wording + " ")
    return " " + re.sub(r"\{\{(\d+)\}\} ", r"([^ ]+ ){1,\1}", wording)


_NOTICES = tuple((label, _pattern(wording)) for label, wording in TEMPLATES)
_NOTICE_ROWS = " UNION ALL ".join(f"SELECT doc_id, '{label}' AS l FROM doc WHERE regexp_matches(j, '{p}')" for label, p in _NOTICES)

_OP6 = rf"""
WITH cut AS (
  SELECT doc_id, regexp_extract_all({_FOLD.format(t="text")}, {_ALNUM}) AS w FROM documents
), doc AS (SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS j FROM cut),
phrase(words, l) AS (VALUES (['mit', 'license'], 'mit'), (['apache', 'license'], 'apache'),
                            (['general', 'public', 'license'], 'gpl')),
spot AS (
  SELECT doc_id, i - 1 AS place, l
  FROM doc, phrase, unnest(range(1, len(w) - len(words) + 2)) AS u(i) WHERE w[i:i + len(words) - 1] = words
), base AS (
  SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
         string_agg(DISTINCT l, ',' ORDER BY l) AS base_labels
  FROM spot GROUP BY doc_id
), notice AS ({_NOTICE_ROWS}),
every AS (
  SELECT doc_id, string_agg(DISTINCT l, ',' ORDER BY l) AS labels, bool_or(l LIKE '%-notice' OR l LIKE '%-text') AS whole, bool_or(l LIKE '%-opening') AS opening
  FROM (SELECT doc_id, l FROM spot UNION ALL SELECT doc_id, l FROM notice) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(CASE WHEN whole THEN 1 WHEN opening THEN 0.75 WHEN n_base > 0 THEN 0.5 ELSE 0 END AS DOUBLE) AS score
FROM doc LEFT JOIN base USING (doc_id) LEFT JOIN every USING (doc_id)
"""

_OP7 = rf"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all({_FOLD.format(t="text")}, {_NOT_SPACE}) AS w FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
  FROM doc, unnest(range(1, greatest(len(w) - 1, 2))) AS u(i) WHERE len(w) > 0
), size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
both_have AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM both_have JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b
  WHERE 100 * c >= 85 * (p.n + q.n - c)
), reach(doc_id, seen) AS (
  SELECT doc_id, doc_id FROM doc
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN link l ON l.a = r.seen
), part AS (SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM part LEFT JOIN size USING (doc_id)
"""

_OP12 = rf"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_NOT_SPACE}) AS w FROM documents
), spot AS (
  SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS win FROM doc, unnest(range(1, len(w) - 33)) AS u(i)
), twice AS (SELECT win FROM spot GROUP BY win HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM spot JOIN twice USING (win)
), word AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM doc
), kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS k FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
), lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""

_OP13 = rf"""
WITH RECURSIVE letter(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders(o) AS (
  SELECT x FROM letter UNION ALL SELECT o || x FROM orders, letter WHERE NOT contains(o, x)
), step AS (
  SELECT o AS filter_order, CAST(i AS INT) AS step, o[i] AS f, o[1:i - 1] AS earlier
  FROM orders, unnest([1, 2, 3, 4, 5]) AS u(i) WHERE length(o) = 5
), doc AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), {_NOT_SPACE}) AS w
  FROM documents
), judged AS (
  SELECT doc_id, part,
         CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS failed
  FROM doc
), mark AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), grouped AS (
  SELECT part, failed, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
  FROM judged LEFT JOIN mark USING (doc_id) GROUP BY ALL
), told AS (
  SELECT part, filter_order, step, f, n, good, toxic, contains(failed, f) AS fails, failed = f AS alone,
         len(list_filter(string_split(earlier, ''), lambda x: x <> '' AND contains(failed, x))) > 0 AS went
  FROM grouped, step
), counts AS (
  SELECT part, filter_order, step, f,
         sum(CASE WHEN NOT fails AND NOT went THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN fails AND NOT went THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN fails AND went THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN alone THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN fails AND NOT went AND good THEN n ELSE 0 END) AS good_lost,
         sum(CASE WHEN fails AND NOT went AND toxic THEN n ELSE 0 END) AS toxic_lost
  FROM told GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counts
"""

SQL: dict[str, str] = {
    "op2_decontamination": _OP2,
    "op4_quality_rules": _OP4,
    "op5_suffix_dedup": _OP5,
    "op6_license_scan": _OP6,
    "op7_minhash_dedup": _OP7,
    "op12_substring_dedup": _OP12,
    "op13_filter_audit": _OP13,
}
