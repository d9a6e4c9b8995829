"""DuckDB SQL of the registered queries, written from the contracts with literal values."""

OP1 = r"""
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS b, sha256(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, CASE WHEN b >= 100 THEN min(page_id) OVER (PARTITION BY h) ELSE page_id END AS first FROM p)
SELECT page_id, b AS payload_bytes, h AS payload_digest,
  CASE WHEN page_id = first OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM f
"""

OP3 = r"""
WITH k(kind_no, kind, pattern, grp, least) AS (VALUES
  (0, 'assign', '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
  (1, 'access', 'AKIA[A-Z0-9]+', 0, 20),
  (2, 'hex', '[0-9a-f]+', 0, 24)),
d AS (SELECT row_number() OVER () AS rid, doc_id, source, lang, coalesce(text, '') AS t FROM documents),
m AS (
  SELECT rid, source, lang, kind_no, kind, least,
    CASE kind_no WHEN 0 THEN regexp_extract_all(t, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0)
      WHEN 1 THEN regexp_extract_all(t, 'AKIA[A-Z0-9]+', 0) ELSE regexp_extract_all(t, '[0-9a-f]+', 0) END AS ms,
    CASE kind_no WHEN 0 THEN regexp_extract_all(t, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2)
      WHEN 1 THEN regexp_extract_all(t, 'AKIA[A-Z0-9]+', 0) ELSE regexp_extract_all(t, '[0-9a-f]+', 0) END AS vs,
    CASE kind_no WHEN 0 THEN regexp_split_to_array(t, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)')
      WHEN 1 THEN regexp_split_to_array(t, 'AKIA[A-Z0-9]+') ELSE regexp_split_to_array(t, '[0-9a-f]+') END AS gs
  FROM d, k),
e AS (SELECT rid, source, lang, kind_no, kind, least, unnest(ms) AS mt, unnest(vs) AS v, unnest(gs[1:len(ms)]) AS g, unnest(range(1, len(ms) + 1)) AS i FROM m WHERE len(ms) > 0),
p AS (SELECT *, sum(length(g)) OVER w + sum(length(mt)) OVER w AS stop FROM e WINDOW w AS (PARTITION BY rid, kind_no ORDER BY i)),
s AS (SELECT rid, source, lang, kind_no, kind, v, CAST(stop - length(mt) AS BIGINT) AS a, CAST(stop AS BIGINT) AS b FROM p WHERE length(v) >= least),
f AS (SELECT v, count(DISTINCT coalesce(source, '') || '/' || coalesce(lang, '')) AS n_rep, count(DISTINCT source) AS n_own FROM s GROUP BY v),
g AS (
  SELECT rid, count(*) FILTER (kind_no = 0) AS n_assign, count(*) FILTER (kind_no = 1) AS n_access, count(*) FILTER (kind_no = 2) AS n_hex,
    string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, kind_no) AS spans,
    count(*) FILTER (n_own = 1 AND n_rep <= 2) AS n_live, count(*) FILTER (n_own >= 3) AS n_example,
    count(*) FILTER (n_own < 3 AND NOT (n_own = 1 AND n_rep <= 2)) AS n_unclear
  FROM s JOIN f USING (v) GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example, coalesce(n_unclear, 0) AS n_unclear
FROM d LEFT JOIN g USING (rid)
"""

OP4 = r"""
WITH dw AS (
  SELECT row_number() OVER () AS rid, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
bw AS (
  SELECT item_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
bg AS (
  SELECT DISTINCT item_id, n, win FROM (
    SELECT item_id, least(len(w), 10) AS n,
      unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) AS win
    FROM bw WHERE len(w) > 0)),
dg AS (
  SELECT rid, n, unnest(range(1, len(w) - n + 2)) AS i,
    unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS win
  FROM dw, (SELECT DISTINCT n FROM bg) WHERE len(w) >= n),
h AS (SELECT rid, i, n, win FROM dg WHERE win IN (SELECT win FROM bg)),
c AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM h) GROUP BY rid),
it AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM h JOIN bg USING (win) WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN c USING (rid) LEFT JOIN it USING (rid)
"""

OP5 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
g AS (
  SELECT rid, unnest(range(1, len(w) - 6)) AS i, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) AS win
  FROM d WHERE len(w) >= 8),
r AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (
    SELECT rid, unnest(range(i, i + 8)) AS p FROM g JOIN (SELECT rid, win FROM g GROUP BY ALL HAVING count(*) > 1) USING (rid, win))
  GROUP BY rid),
m AS (
  SELECT rid, doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(l) AS BIGINT) AS n_lines,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN r USING (rid)),
b AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    least(1000 * n_symbols // greatest(word_chars, 1), 1000) AS s1,
    least(1000 * n_dup_lines // greatest(n_lines, 1), 1000) AS s2,
    least(1000 * n_repeat_words // greatest(n_words, 1), 1000) AS s3,
    least(1000 * word_chars // greatest(100 * n_words, 1), 1000) AS s4
  FROM m),
lr AS (
  SELECT doc_id, bool_or(coalesce(toxic = 1, false)) AS toxic, bool_and(coalesce(quality = 1, false)) AS well,
    bool_or(coalesce(quality = 0 OR toxic = 1, false)) AS bad, bool_and(coalesce(quality = 1 AND coalesce(toxic, 0) = 0, false)) AS good
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
kn AS (SELECT rid, coalesce(toxic, false) AS toxic FROM d LEFT JOIN lr USING (doc_id) WHERE toxic IS NULL OR (toxic AND well)),
dw AS (
  SELECT rid, unnest(list_distinct(list_filter(regexp_split_to_array(
    translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> ''))) AS word
  FROM d),
sz AS (SELECT count(*) FILTER (toxic) AS tn, count(*) FILTER (NOT toxic) AS o FROM kn),
sn AS (SELECT word, count(*) FILTER (toxic) AS a, count(*) FILTER (NOT toxic) AS b FROM dw JOIN kn USING (rid) GROUP BY word),
wt AS (SELECT word, a, (b + 0.5e0) / (o + 1) * tn AS chance, ln((a + 0.5e0) / (tn + 1)) - ln((b + 0.5e0) / (o + 1)) AS weight FROM sn, sz),
lx AS (
  SELECT word, CAST(round(100 * weight) AS INTEGER) AS w FROM wt
  WHERE a >= 5 AND a >= chance + sqrt(chance) * 4 + 4 AND weight >= 1 ORDER BY weight * a DESC, word LIMIT 256),
tx AS (SELECT rid, least(sum(w), 1000) AS s6 FROM dw JOIN lx USING (word) GROUP BY rid),
sc AS (
  SELECT rid, lang, base_failed, bad, coalesce(good, false) AS good, unnest([1, 2, 3, 4, 5, 6]) AS rule,
    unnest([s1, s2, s3, s4, 1000 - s4, coalesce(s6, 0)]) AS score
  FROM b LEFT JOIN tx USING (rid) LEFT JOIN lr USING (doc_id)),
ty AS (
  SELECT rule, score, count(*) FILTER (bad) AS bad, count(*) FILTER (bad IS NULL) AS other
  FROM sc WHERE NOT base_failed AND (bad IS NULL OR bad) GROUP BY ALL),
gr AS (SELECT * FROM (SELECT unnest([1, 2, 3, 4, 5, 6]) AS rule), (SELECT unnest(range(0, 1001)) AS v)),
ge AS (
  SELECT gr.rule, v, coalesce(sum(bad), 0) AS bad, coalesce(sum(other), 0) AS other
  FROM gr LEFT JOIN ty ON ty.rule = gr.rule AND ty.score >= v GROUP BY ALL),
fl AS (
  SELECT g.rule, g.v, CASE WHEN g.bad + g.other > 0
    THEN round(1000 * (ln((g.bad + 0.5e0) / (z.bad + 1)) - ln((g.other + 0.5e0) / (z.other + 1)))) ELSE 0 END AS f
  FROM ge g JOIN (SELECT * FROM ge WHERE v = 0) z ON g.rule = z.rule),
li AS (SELECT rule, v, greatest(max(f) OVER (PARTITION BY rule ORDER BY v), 0) AS lift FROM fl),
wo AS (
  SELECT rid, any_value(lang) AS lang, any_value(base_failed) AS base_failed, any_value(good) AS good, max(lift) AS worst
  FROM sc JOIN li ON sc.rule = li.rule AND sc.score = li.v GROUP BY rid),
h AS (SELECT lang, worst, count(*) AS n FROM wo WHERE good AND NOT base_failed GROUP BY ALL),
held AS (SELECT lang, sum(n) AS n FROM h GROUP BY lang),
terms AS (
  SELECT lang, n, k, sum(CASE WHEN k = 0 THEN n * ln(1 - 0.02e0) ELSE ln((n - k + 1) / k) + ln(0.02e0 / (1 - 0.02e0)) END)
    OVER (PARTITION BY lang ORDER BY k) AS log_term
  FROM (SELECT *, unnest(range(0, CAST(least(n, greatest(CAST(ceil(n * 0.02e0) AS BIGINT), 1)) + 1 AS BIGINT))) AS k FROM held)),
cdf AS (SELECT lang, k, sum(exp(log_term)) OVER (PARTITION BY lang ORDER BY k) AS p FROM terms),
allowed AS (SELECT lang, max(k) AS allowed FROM cdf WHERE p <= 0.05e0 / (SELECT count(*) FROM held) GROUP BY lang),
tails AS (
  SELECT lang, worst, coalesce(sum(n) OVER (PARTITION BY lang ORDER BY worst DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rejected FROM h),
cut AS (
  SELECT t.lang, min(worst) AS cutoff FROM tails t JOIN allowed a ON t.lang IS NOT DISTINCT FROM a.lang WHERE rejected <= allowed GROUP BY ALL),
beyond AS (SELECT rid FROM wo JOIN cut ON wo.lang IS NOT DISTINCT FROM cut.lang WHERE worst > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, b.base_failed, NOT b.base_failed AND beyond.rid IS NULL AS kept
FROM b LEFT JOIN beyond USING (rid)
"""

OP6 = r"""
WITH RECURSIVE m AS (SELECT conv_id, turn, role, coalesce(text, '') AS t FROM conversations),
p AS (
  SELECT DISTINCT conv_id, turn, trim(regexp_replace(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g')) AS passage
  FROM (SELECT conv_id, turn, unnest(regexp_split_to_array(t, '\n([ \t\r]*\n)+')) AS x FROM m)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
o AS (SELECT conv_id, passage, min(turn) AS first FROM p GROUP BY ALL),
q AS (SELECT conv_id, turn + lv AS turn, lv, passage FROM p, (VALUES (1), (2)) AS l(lv) WHERE (conv_id, turn + lv) IN (SELECT (conv_id, turn) FROM m)),
l AS (SELECT q.conv_id, q.turn, lv, first FROM q JOIN o USING (conv_id, passage)),
parent AS (SELECT conv_id, turn, max(first) AS parent FROM l WHERE lv = 1 GROUP BY ALL),
up AS (
  SELECT conv_id, turn, parent AS root, 1 AS depth FROM parent
  UNION ALL
  SELECT u.conv_id, u.turn, n.parent, u.depth + 1 FROM up u JOIN parent n ON u.conv_id = n.conv_id AND u.root = n.turn),
r AS (SELECT conv_id, turn, min(root) AS root, max(depth) AS depth FROM up GROUP BY ALL),
c AS (SELECT conv_id, turn, count(*) AS n FROM l GROUP BY ALL)
SELECT conv_id, turn, role,
  sha256(CASE WHEN regexp_matches(t, '[^ \t\r\n]') THEN regexp_replace(regexp_replace(t, '^([ \t\r]*\n)+', ''), '(\n[ \t\r]*)+$', '') ELSE '' END) AS text_sha256,
  parent AS parent_turn, coalesce(root, turn) AS root_turn, CAST(coalesce(depth, 0) AS BIGINT) AS depth, coalesce(n, 0) AS n_quoted, coalesce(n, 0) AS n_linked
FROM m LEFT JOIN parent USING (conv_id, turn) LEFT JOIN r USING (conv_id, turn) LEFT JOIN c USING (conv_id, turn)
"""

SQL: dict[str, str] = {
    "op1_warc_chains": OP1,
    "op3_secret_scan": OP3,
    "op4_decontamination": OP4,
    "op5_quality_rules": OP5,
    "op6_quotation_linking": OP6,
}
