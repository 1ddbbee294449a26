"""SQL oracles (DuckDB dialect) of the queries that SQL can express over whole tables."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_SPACE = r"'[^\x20\x09-\x0D]+'"

_DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(13, len(ws)) AS n, array_to_string(ws[i : i + 12], ' ') AS k
  FROM b, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS t(i) WHERE len(ws) > 0
),
keys AS (SELECT DISTINCT n, k FROM win),
places AS (
  SELECT doc_id, i, n, array_to_string(ws[i : i + n - 1], ' ') AS k
  FROM d, (SELECT DISTINCT n FROM keys) AS sizes, unnest(range(1, len(ws) - n + 2)) AS t(i)
),
occ AS (SELECT places.* FROM places JOIN keys USING (n, k)),
hit AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM occ, unnest(range(i, i + n)) AS t(j) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM occ JOIN win USING (n, k)) GROUP BY doc_id
)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""

# Bytes as pairs of hexadecimal digits.
_REPEATS = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT doc_id, i, md5(substr(h, 2 * i - 1, 800)) AS k FROM d, unnest(range(1, len(h) // 2 - 398)) AS t(i)),
twice AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
opened AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400 THEN 0 ELSE 1 END AS opens
  FROM win SEMI JOIN twice USING (k)
),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM opened),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 400 AS b FROM numbered GROUP BY doc_id, span),
pieces AS (
  SELECT doc_id, a, b, substr(h, 2 * before - 1, 2 * (a - before)) AS piece, h
  FROM (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 1) AS before FROM spans) JOIN d USING (doc_id)
),
cut AS (
  SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans,
    string_agg(piece, '' ORDER BY a) || substr(any_value(h), 2 * max(b) - 1) AS kept
  FROM pieces GROUP BY doc_id
)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)"""

_SUBSTRING = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_SPACE}) AS ws FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(ws[i : i + 49], ' ')) AS k FROM d, unnest(range(1, len(ws) - 48)) AS t(i)
),
least_doc AS (SELECT k, min(doc_id) AS lowest FROM win GROUP BY k HAVING count(DISTINCT doc_id) > 1),
gone AS (
  SELECT DISTINCT doc_id, j FROM win JOIN least_doc USING (k), unnest(range(i, i + 50)) AS t(j) WHERE lowest < doc_id
),
removed AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(ws[j], ' ' ORDER BY j) AS words
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS j FROM d) AS each ANTI JOIN gone USING (doc_id, j)
  GROUP BY doc_id
)
SELECT doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
FROM d LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)"""

_JACCARD = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_SPACE}) AS ws FROM documents),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 2], ' ') AS s
  FROM d, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS t(i) WHERE len(ws) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY ALL
),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 90 * (p.n + q.n - c)
),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, l.y FROM reach r JOIN both_ways l ON l.x = r.other
)
SELECT d.doc_id, coalesce(sizes.n, 0) AS n_shingles, min(other) AS component_id
FROM d JOIN reach USING (doc_id) LEFT JOIN sizes USING (doc_id) GROUP BY ALL"""

_COLLOCATIONS = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
),
d AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces),
counts AS (
  SELECT lang, ws[i : i + k - 1] AS own, array_to_string(ws[i : i + k - 1], ' ') AS phrase, k, count(*) AS c
  FROM d, unnest(range(1, 6)) AS s(k), unnest(range(1, len(ws) - k + 2)) AS t(i) GROUP BY ALL
),
total AS (SELECT lang, CAST(sum(c) AS HUGEINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
cand AS (SELECT * FROM counts WHERE k >= 2 AND c >= 100),
cuts AS (
  SELECT cand.lang, cand.phrase, cand.c AS a, x.c AS l, y.c AS r, n, cand.k AS size, j, x.phrase AS head, y.phrase AS tail,
    (1000 * CAST(cand.c AS HUGEINT) * n) // (CAST(x.c AS HUGEINT) * y.c) AS score
  FROM cand, unnest(range(1, cand.k)) AS t(j)
  JOIN counts x ON x.lang = cand.lang AND x.phrase = array_to_string(cand.own[1 : j], ' ')
  JOIN counts y ON y.lang = cand.lang AND y.phrase = array_to_string(cand.own[j + 1 :], ' ')
  JOIN total ON total.lang = cand.lang
),
inside AS (
  SELECT DISTINCT s.lang, s.phrase FROM cand s JOIN cand b
    ON b.lang = s.lang AND b.k > s.k AND b.c >= s.c AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' ')
),
worst AS (SELECT * FROM cuts ANTI JOIN inside USING (lang, phrase) QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS place FROM worst)
SELECT lang, place AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE place <= 2000"""

# Kinds by number as in secret_scan; RE2 looks neither ahead nor behind, so bare runs are filtered afterwards.
_SECRET_KINDS = (
    r"""[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]""",
    r"AKIA[A-Z0-9]+",
    r"[0-9a-f]+",
    r"[A-Za-z0-9+/_.=-]+",
)
_SECRET_PATTERNS = (rf"""({_SECRET_KINDS[0]})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", *_SECRET_KINDS[1:])
_SECRET_MATCHES = " UNION ALL ".join(
    f"SELECT doc_id, owner, {kind} AS kind, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS gs FROM d"
    for kind, pattern in enumerate(_SECRET_PATTERNS)
)

_SECRETS = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS owner FROM documents),
m AS ({_SECRET_MATCHES}),
each AS (SELECT doc_id, owner, kind, i, ms[i] AS m, length(gs[i]) + length(ms[i]) AS step FROM m, unnest(range(1, len(ms) + 1)) AS x(i)),
placed AS (
  SELECT doc_id, owner, kind, m, CAST(sum(step) OVER (PARTITION BY doc_id, kind ORDER BY i) AS BIGINT) AS e,
    CASE WHEN kind = 0 THEN regexp_extract(m, '{_SECRET_PATTERNS[0]}', 2) ELSE m END AS v FROM each
),
sized AS (
  SELECT doc_id, owner, kind, e - length(m) AS s, e, regexp_replace(v, '[.=-]+$', '') AS v FROM placed
  WHERE length(v) >= [8, 16, 32, 8][kind + 1] AND (kind < 3 OR (regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')))
),
beside AS (
  SELECT *, max(CASE WHEN kind < 3 THEN e END) OVER (PARTITION BY doc_id ORDER BY s, kind ROWS UNBOUNDED PRECEDING) AS named_end,
    min(CASE WHEN kind < 3 THEN s END) OVER (PARTITION BY doc_id ORDER BY s, kind ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS named_start
  FROM sized
),
spans AS (
  SELECT doc_id, owner, kind, s, e, v, len(list_distinct(string_split(v, ''))) AS chars
  FROM beside WHERE kind < 3 OR NOT (coalesce(named_end, -1) > s OR coalesce(named_start, e) < e)
),
facts AS (SELECT v, count(DISTINCT owner) AS owners, max(CASE WHEN kind < 3 THEN 1 ELSE 0 END) AS named FROM spans GROUP BY v),
told AS (
  SELECT spans.*, named, owners > 2 AS copied,
    regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') AND chars >= 6
      AND NOT regexp_matches(lower(v), 'example|sample|dummy|placeholder|changeme|your|test|xxxx|0000|12345|abcdef|password|secret') AS looks,
    regexp_matches(v, '^[A-Za-z0-9+/_=-]{{20,}}$') AND regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[a-z]')
      AND regexp_matches(v, '[0-9].*[0-9]') AND chars >= 12 AND NOT regexp_matches(v, '/.*/.*/') AS random
  FROM spans JOIN facts USING (v)
),
kept AS (SELECT *, looks AND NOT copied AS live FROM told WHERE kind < 3 OR (looks AND NOT copied AND (named = 1 OR random))),
shown AS (SELECT *, ['assign', 'access', 'hex', 'bare'][kind + 1] || ':' || s || ':' || e AS span FROM kept),
by_doc AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    count(*) FILTER (live) AS n_live, count(*) FILTER (copied) AS n_copied,
    string_agg(span, ',' ORDER BY s, kind) FILTER (kind < 3) AS base, string_agg(span, ',' ORDER BY s, kind) AS spans
  FROM shown GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM d LEFT JOIN by_doc USING (doc_id)"""

ORACLE: dict[str, str] = {
    "op1_decontamination": _DECONTAMINATION,
    "op4_suffix_dedup": _REPEATS,
    "op5_substring_dedup": _SUBSTRING,
    "op8_jaccard_join": _JACCARD,
    "op11_secret_scan": _SECRETS,
    "op13_collocations": _COLLOCATIONS,
}
