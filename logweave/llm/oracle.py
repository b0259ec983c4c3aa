"""DuckDB SQL of the queries that SQL can express."""

_DECON = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
i AS (SELECT item_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
wi AS (SELECT DISTINCT item_id, least(len(ws), 10) AS k,
         array_to_string(ws[s:s + 9], ' ') AS win
       FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS s
             FROM i WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT k FROM wi),
pos AS (SELECT rid, k, s, array_to_string(ws[s:s + k - 1], ' ') AS win
        FROM (SELECT rid, ws, k, unnest(range(1, len(ws) - k + 2)) AS s FROM d, lens
              WHERE len(ws) >= k)),
hit AS (SELECT p.rid, p.s, p.k, w.item_id FROM pos p JOIN wi w ON p.win = w.win AND p.k = w.k),
n AS (SELECT rid, count(DISTINCT x) AS n_hit
      FROM (SELECT rid, unnest(range(s, s + k)) AS x FROM hit) GROUP BY rid),
it AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
       FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM hit WHERE item_id IS NOT NULL)
      GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
       CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (rid) LEFT JOIN it USING (rid)
"""

# The sharing of the targets, written as the fixed point over the sources
# ordered by the share at which each one stops (its cap divided by its weight).
_MIX = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source,
             CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                                  lambda x: x <> '')) AS BIGINT) AS size,
             md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS key
      FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1 AS weight FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST) AS r
      FROM w),
t AS (SELECT sum(source_size) AS total FROM s),
p AS (SELECT o.*, total - coalesce(sum(3 * source_size) OVER (ORDER BY r ROWS BETWEEN
               UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
             sum(weight) OVER (ORDER BY r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wr
      FROM o, t),
c AS (SELECT CAST(rest AS BIGINT) AS rest, CAST(wr AS BIGINT) AS wr, r FROM p
      WHERE rest * weight <= 3 * source_size * wr ORDER BY r LIMIT 1),
q AS (SELECT p.source, source_size,
             CASE WHEN p.r < c.r THEN CAST(3 * source_size AS DOUBLE)
                  ELSE CAST(c.rest * weight AS DOUBLE) / CAST(c.wr AS DOUBLE) END AS target,
             CASE WHEN p.r < c.r THEN 3 * source_size
                  ELSE (c.rest * weight) // c.wr END AS quota
      FROM p, c),
m AS (SELECT d.*, sum(size) OVER (PARTITION BY source ORDER BY key, size, rid
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM d)
SELECT m.doc_id, m.size, q.source_size, q.target,
       CAST(greatest(0, least(size, quota - coalesce(before, 0)))
          + greatest(0, least(size, quota - coalesce(before, 0) - source_size))
          + greatest(0, least(size, quota - coalesce(before, 0) - 2 * source_size)) AS BIGINT)
       AS taken
FROM m JOIN q ON m.source IS NOT DISTINCT FROM q.source
"""

_QUALITY = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t,
             list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                         lambda x: x <> '') AS ws FROM documents),
l AS (SELECT rid, source, t, ln, trim(regexp_replace(lower(ln), '[\x20\x09-\x0D]+', ' ', 'g')) AS nl
      FROM (SELECT rid, source, t, unnest(string_split(t, chr(10))) AS ln FROM d)
      WHERE regexp_matches(ln, '[^\x20\x09-\x0D]')),
dup AS (SELECT rid, count(*) - count(DISTINCT ln) AS n_dup_lines FROM l GROUP BY rid),
hosts AS (SELECT source, count(DISTINCT t) AS n FROM d GROUP BY source),
freq AS (SELECT source, nl, count(DISTINCT t) AS n FROM l GROUP BY source, nl),
bad AS (SELECT f.source, f.nl FROM freq f JOIN hosts h ON f.source IS NOT DISTINCT FROM h.source
        WHERE f.n > 20 AND f.n > 0.01 * h.n),
lost AS (SELECT rid, sum(len(string_split(l.nl, ' '))) AS n FROM l JOIN bad b
         ON l.source IS NOT DISTINCT FROM b.source AND l.nl = b.nl GROUP BY rid),
g AS (SELECT rid, p, array_to_string(ws[p:p + 4], ' ') AS gram
      FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS p FROM d WHERE len(ws) >= 5)),
rep AS (SELECT rid, count(DISTINCT x) AS n FROM (
          SELECT rid, unnest(range(p, p + 5)) AS x FROM (
            SELECT rid, p, count(*) OVER (PARTITION BY rid, gram) AS c FROM g) WHERE c > 1)
        GROUP BY rid),
f AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(lost.n, 0) AS BIGINT) AS n_boilerplate_words
      FROM d LEFT JOIN dup USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN lost USING (rid))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
       AND n_words - n_boilerplate_words >= 0.5 * n_words AS kept
FROM f
"""

_SUBSTRING = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
             list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                         lambda x: x <> '') AS ws FROM documents),
g AS (SELECT rid, p, md5(array_to_string(ws[p:p + 34], ' ')) AS h
      FROM (SELECT rid, ws, unnest(range(1, len(ws) - 33)) AS p FROM d WHERE len(ws) >= 35)),
r AS (SELECT h FROM g GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT rid, unnest(range(p, p + 35)) AS p FROM g JOIN r USING (h)),
per AS (SELECT rid, count(*) AS n FROM gone GROUP BY rid),
kept AS (SELECT w.rid, string_agg(w.word, ' ' ORDER BY w.p) AS txt
         FROM (SELECT rid, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM d) w
         LEFT JOIN gone USING (rid, p) WHERE gone.rid IS NULL GROUP BY w.rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(txt, '')) AS kept_sha256
FROM d LEFT JOIN per USING (rid) LEFT JOIN kept USING (rid)
"""

_PHRASES = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws
      FROM p),
n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f
      FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
            FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k)
      GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, k, phrase, f AS a, unnest(range(1, k)) AS cut, string_split(phrase, ' ') AS ws
      FROM g WHERE k > 1),
s AS (SELECT c.lang, c.k, c.phrase, c.a, c.cut, l.f AS l, r.f AS r,
             CAST(2000000::HUGEINT * c.a // (l.f::HUGEINT + r.f) AS BIGINT) AS score
      FROM c JOIN g l ON l.lang = c.lang AND l.k = cut AND l.phrase = array_to_string(ws[1:cut], ' ')
      JOIN g r ON r.lang = c.lang AND r.k = c.k - cut AND r.phrase = array_to_string(ws[cut + 1:c.k], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
sub AS (SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(f) AS longer
        FROM (SELECT lang, f, ws, m, unnest(range(1, k - m + 2)) AS i
              FROM (SELECT lang, k, f, string_split(phrase, ' ') AS ws, unnest(range(2, k)) AS m
                    FROM g WHERE k > 2)) GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank,
       b.phrase, a, l, r, n, score
FROM b JOIN n ON n.lang = b.lang LEFT JOIN sub ON sub.lang = b.lang AND sub.phrase = b.phrase
WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
QUALIFY rank <= 2000
"""

_FIM = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
             regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS ls FROM documents),
e AS (SELECT *, len(ls) AS n, ('0x' || h[1:8])::BIGINT % (len(ls) + 1) AS x,
        ('0x' || h[9:16])::BIGINT % (len(ls) + 1) AS y,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
             WHEN ('0x' || h[25:32])::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, array_to_string(ls[1:least(x, y)], '') AS prefix,
        array_to_string(ls[least(x, y) + 1:greatest(x, y)], '') AS middle,
        array_to_string(ls[greatest(x, y) + 1:n], '') AS suffix FROM e)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""

_WARC = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha256(coalesce(html, '')) AS digest FROM pages),
r AS (SELECT page_id, octet_length(b) AS n, digest,
             row_number() OVER (PARTITION BY digest ORDER BY page_id NULLS LAST) AS place,
             first_value(page_id) OVER (PARTITION BY digest ORDER BY page_id NULLS LAST) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 100 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND place > 1 THEN first END AS refers_to
FROM r
"""

ORACLE = {"op2_decontamination": _DECON, "op4_mixing": _MIX, "op9_substring_dedup": _SUBSTRING,
          "op10_quality_rules": _QUALITY, "op11_phrase_mining": _PHRASES,
          "op12_fill_in_middle": _FIM, "op13_warc": _WARC}
