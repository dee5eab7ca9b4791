"""SQL for DuckDB that the queries must agree with, where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from ledgersift.llm.language_ranks import TOP
from ledgersift.llm.pfair_mix import BLOCK_ROWS, CYCLE

ORACLE: dict[str, str] = {}

ORACLE["op1_suffix_dedup"] = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT r, i, md5(array_slice(b, i, i + 399)) AS h
      FROM d, unnest(range(1, octet_length(b) - 398)) AS t(i)),
twice AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
starts AS (SELECT r, i FROM w SEMI JOIN twice USING (h)),
marked AS (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 400 THEN 0 ELSE 1 END
           AS fresh FROM starts),
numbered AS (SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS k FROM marked),
cuts AS (SELECT r, min(i) AS a, max(i) + 400 AS z FROM numbered GROUP BY r, k),
pieces AS (
  SELECT d.r, lag(z, 1, 1) OVER (PARTITION BY d.r ORDER BY a) AS p, a AS q, b FROM cuts JOIN d USING (r)
  UNION ALL
  SELECT d.r, coalesce((SELECT max(z) FROM cuts WHERE cuts.r = d.r), 1), octet_length(b) + 1, b FROM d),
kept AS (SELECT r, sha256(unhex(string_agg(hex(array_slice(b, p, q - 1)), '' ORDER BY p))) AS s
         FROM pieces GROUP BY r),
sums AS (SELECT r, count(*) AS n, sum(z - a) AS cut FROM cuts GROUP BY r)
SELECT doc_id, CAST(octet_length(b) AS bigint) AS n_bytes, CAST(coalesce(cut, 0) AS bigint) AS n_removed,
       CAST(coalesce(n, 0) AS bigint) AS n_spans, s AS kept_sha256
FROM d JOIN kept USING (r) LEFT JOIN sums USING (r)
"""

_HOST = r"""lower(regexp_replace(regexp_replace(regexp_extract(coalesce(url, ''),
  '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', ''))"""
_PATH = r"regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"

ORACLE["op4_url_lists"] = f"""
WITH seen AS (SELECT DISTINCT {_HOST} AS host, string_split({_PATH}, '/')[2] AS folder FROM pages
              WHERE {_HOST} <> ''),
named AS (
  SELECT DISTINCT scope, value FROM (
    SELECT 'domain' AS scope, regexp_extract(host, '[^.]+[.][^.]+$') AS value FROM seen
    UNION ALL SELECT 'host', host FROM seen
    UNION ALL SELECT 'prefix', host || '/' || folder FROM seen WHERE folder <> '') WHERE value <> ''),
v AS (SELECT *, substr(md5(value), 1, 1) AS digit,
             CAST('0x' || substr(md5(value), 2, 2) AS bigint) AS day FROM named),
rule(scope, digits, list, action, base, per, added) AS (VALUES
  ('domain', '012345', 'domains', 'block', 20, 0, true), ('domain', '012', 'domains', 'block', 140, 0, false),
  ('domain', '0', 'domains', 'block', 260, 0, true), ('host', '0123', 'hosts', 'block', 0, 1, true),
  ('host', '01', 'hosts', 'block', 60, 1, false), ('host', 'ef', 'trusted', 'allow', 30, 0, true),
  ('prefix', '01', 'paths', 'block', 50, 0, true), ('prefix', '0', 'paths', 'block', 50, 1, false)),
events AS (SELECT list, v.scope, value, action, added, 1704067200 + 86400 * (base + per * day) AS "at"
           FROM v JOIN rule ON v.scope = rule.scope AND contains(digits, digit)),
valid AS (
  SELECT *, "at" AS since, lead("at") OVER (PARTITION BY list, scope, value ORDER BY "at", added DESC, action)
         AS until FROM events),
captures AS (SELECT page_id, url, 1704067200 + (page_id * 104729) % 31536000 AS fetched_at,
                    {_HOST} AS host, {_PATH} AS path FROM pages),
judged AS (
  SELECT c.page_id, c.url, c.fetched_at, e.action, e.scope, e.value, e.list,
         row_number() OVER (PARTITION BY c.page_id ORDER BY
           CASE e.scope WHEN 'prefix' THEN 3 WHEN 'host' THEN 2 WHEN 'domain' THEN 1 END DESC NULLS LAST,
           length(e.value) DESC, since DESC, e.list DESC, e.action DESC, e.value DESC) AS r
  FROM captures c LEFT JOIN valid e
    ON e.added AND since <= fetched_at AND (until IS NULL OR fetched_at < until) AND host <> ''
   AND ((e.scope = 'host' AND e.value = host)
     OR (e.scope = 'domain' AND (e.value = host OR ends_with(host, '.' || e.value)))
     OR (e.scope = 'prefix' AND starts_with(host || path || '/', e.value || '/'))))
SELECT page_id, url, CAST(fetched_at AS bigint) AS fetched_at, action, scope, value AS entry,
       list AS list_name, coalesce(action, '') <> 'block' AS kept
FROM judged WHERE r = 1
"""

ORACLE["op5_phrase_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT coalesce(CAST(item_id AS varchar), '') AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS p
  FROM b, unnest(range(1, greatest(2, len(w) - 8))) AS t(i) WHERE len(w) > 0),
pos AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS p
  FROM d, (SELECT DISTINCT n FROM win) AS sizes, unnest(range(1, len(w) - n + 2)) AS t(i)),
found AS (SELECT r, i, pos.n AS n, item FROM pos JOIN win ON pos.n = win.n AND pos.p = win.p),
words AS (SELECT r, count(DISTINCT k) AS n_hit FROM found, unnest(range(i, i + n)) AS t(k) GROUP BY r),
items AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS s
          FROM found GROUP BY r)
SELECT doc_id, CAST(len(w) AS bigint) AS n_words, CAST(coalesce(n_hit, 0) AS bigint) AS n_hit,
       CAST(coalesce(n_items, 0) AS bigint) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

ORACLE["op7_exact_dedup"] = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
           FROM documents),
g AS (SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id,
             count(*) OVER (PARTITION BY t) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept,
       sha256(t) AS text_sha256 FROM g
"""

ORACLE["op9_pfair_mixing"] = f"""
WITH RECURSIVE s AS (
  SELECT coalesce('s' || source, 'n') AS key, count(*) AS n,
         CAST(floor(sqrt(count(*))) AS bigint) AS root FROM documents GROUP BY 1),
shared AS (
  SELECT *, 1 + root * ({CYCLE} - count(*) OVER ()) // CAST(sum(root) OVER () AS bigint) AS base,
         (root * ({CYCLE} - count(*) OVER ())) % CAST(sum(root) OVER () AS bigint) AS rest FROM s),
weights AS (
  SELECT key, n, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, key)
                                  <= {CYCLE} - sum(base) OVER () THEN 1 ELSE 0 END AS a FROM shared),
src AS (SELECT list(key ORDER BY key) AS keys, list(a ORDER BY key) AS a, list(n ORDER BY key) AS n
        FROM weights),
edf AS (
  SELECT 0 AS t, list_transform(a, lambda x: 0) AS got, 0 AS k FROM src
  UNION ALL
  SELECT t + 1, list_transform(got, lambda g, i: CASE WHEN i = pick THEN g + 1 ELSE g END), pick
  FROM (SELECT t, got, list_min(list_transform(
          list_filter(range(1, len(src.a) + 1), lambda i: got[i] < src.a[i]
                      AND (got[i] * {CYCLE}) // src.a[i] <= t),
          lambda i: ((got[i] + 1) * {CYCLE} + src.a[i] - 1) // src.a[i] * 100000 + i)) % 100000 AS pick
        FROM edf, src WHERE t < {CYCLE})),
slots AS (SELECT t - 1 AS slot, src.keys[k] AS key, src.a[k] AS a, got[k] - 1 AS nth,
                 list_transform(got, lambda g, i: CASE WHEN i = k THEN g - 1 ELSE g END) AS before
          FROM edf, src WHERE t > 0),
ranked AS (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS key, row_number() OVER (
    PARTITION BY source ORDER BY md5(CAST(doc_id AS varchar)), doc_id) - 1 AS rank FROM documents),
blocks AS (SELECT *, rank // {BLOCK_ROWS} AS block FROM ranked)
SELECT doc_id, source, block AS mix_block,
       CAST((block // slots.a) * {CYCLE} + slot AS bigint) AS mix_slot,
       CAST(rank % {BLOCK_ROWS} + list_sum(list_transform(range(1, len(src.a) + 1),
         lambda i: least(src.n[i], {BLOCK_ROWS} * ((block // slots.a) * src.a[i] + before[i])))) AS bigint)
         AS mix_position
FROM blocks JOIN slots ON blocks.key = slots.key AND blocks.block % slots.a = slots.nth, src
"""

# the CRC of the id's digits, bit by bit: each digit is added, then shifted out in eight steps
_CRC = """xor(4294967295, list_reduce(
  list_prepend(CAST(4294967295 AS bigint), flatten(list_transform(
    string_split(coalesce(CAST(doc_id AS varchar), ''), ''),
    lambda x: CASE WHEN x = '' THEN [] ELSE [CAST(unicode(x) AS bigint), -1, -1, -1, -1, -1, -1, -1, -1] END))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END))"""

ORACLE["op11_language_ranks"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, {_CRC} % 5 = 0 AS held_out, string_split(
    ' ' || trim(regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}]+', ' ', 'g')) || ' ', '') AS c
  FROM documents),
spots AS (SELECT r, c[i] AS x, c[i + 1] AS y, c[i + 2] AS z
          FROM d, unnest(range(1, len(c) + 1)) AS t(i) WHERE len(c) > 2),
grams AS (
  SELECT r, CAST(unicode(x) AS bigint) * 4398046511104 AS gram FROM spots WHERE x <> ' '
  UNION ALL
  SELECT r, CAST(unicode(x) AS bigint) * 4398046511104 + unicode(y) * 2097152 FROM spots
  WHERE y IS NOT NULL
  UNION ALL
  SELECT r, CAST(unicode(x) AS bigint) * 4398046511104 + unicode(y) * 2097152 + unicode(z) FROM spots
  WHERE z IS NOT NULL AND y <> ' '),
counts AS (SELECT r, gram, count(*) AS n FROM grams GROUP BY r, gram),
known AS (
  SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY sum(n) DESC, gram) - 1 AS place
  FROM counts JOIN d USING (r) WHERE NOT held_out AND lang IS NOT NULL GROUP BY lang, gram
  QUALIFY place < {TOP}),
ranks AS (
  SELECT r, gram, row_number() OVER (PARTITION BY r ORDER BY n DESC, gram) - 1 AS place FROM counts
  QUALIFY place < {TOP}),
sizes AS (SELECT r, count(*) AS g FROM ranks GROUP BY r),
near AS (SELECT r, lang, sum({TOP} - least(abs(ranks.place - known.place), {TOP})) AS s
         FROM ranks JOIN known USING (gram) GROUP BY r, lang),
judged AS (
  SELECT r, g, l.lang, g * {TOP} - coalesce(s, 0) AS far
  FROM sizes CROSS JOIN (SELECT DISTINCT lang FROM known) AS l LEFT JOIN near USING (r, lang)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY far, l.lang) = 1)
SELECT doc_id, held_out, coalesce(judged.lang, 'und') AS lang_pred,
       coalesce(1.0::double - far::double / (g * {TOP})::double, 0.0::double) AS score
FROM d LEFT JOIN judged USING (r)
"""

ORACLE["op13_phrase_automata"] = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
f AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f
  FROM w, unnest([1, 2, 3]) AS s(size), unnest(range(1, len(w) - size + 2)) AS t(i) GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS bigint) AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS x FROM f WHERE size > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.phrase, c.size, c.f AS a, k, l.f AS l, r.f AS r,
         CAST(CAST(1000000 AS hugeint) * c.f * c.f // (CAST(l.f AS hugeint) * r.f) AS bigint) AS score
  FROM c, unnest(range(1, c.size)) AS t(k)
  JOIN f AS l ON l.lang = c.lang AND l.phrase = array_to_string(x[1:k], ' ')
  JOIN f AS r ON r.lang = c.lang AND r.phrase = array_to_string(x[k + 1:], ' ')),
weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, array_to_string(x[i:i + 1], ' ') AS phrase, max(f) AS longer
  FROM c, unnest([1, 2]) AS t(i) WHERE size = 3 GROUP BY ALL),
alone AS (
  SELECT weakest.* FROM weakest LEFT JOIN inner_ USING (lang, phrase)
  WHERE size = 3 OR longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
       phrase, a, l, r, n, score
FROM alone JOIN totals USING (lang) QUALIFY rank <= 2000
"""

if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
