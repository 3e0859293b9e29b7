"""DuckDB SQL of those queries that SQL can express, written from the
contracts; literals are stated anew here."""
from __future__ import annotations

OP2 = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html,
         CASE WHEN contains(coalesce(url, ''), '://') THEN url ELSE NULL END AS good, url
  FROM pages
), d AS (
  SELECT page_id, url, strlen(html) AS payload_bytes, sha1(html) AS payload_digest,
         coalesce(regexp_replace(url, '[\r\n]', '%0A', 'g'), 'urn:none') AS u
  FROM p
), first_copy AS (
  SELECT payload_digest, max(page_id) AS first_id FROM d WHERE payload_bytes >= 1000 GROUP BY 1 HAVING count(*) > 1
), j AS (
  SELECT d.*, f.first_id, f.payload_digest IS NOT NULL AND d.payload_bytes >= 1000
         AND d.page_id IS DISTINCT FROM f.first_id AS again
  FROM d LEFT JOIN first_copy f ON f.payload_digest = d.payload_digest AND d.payload_bytes >= 1000
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first_id END AS refers_to,
       CASE WHEN contains(u, '://') THEN
         array_to_string(list_reverse(string_split(translate(regexp_extract(u, '(?s)^[^:/?#]*://([^/?#]*)(.*)$', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '.')), ',') || ')'
         || regexp_extract(u, '(?s)^[^:/?#]*://([^/?#]*)(.*)$', 2)
       ELSE u END AS url_key,
       1700000000 + coalesce(page_id, 0) AS captured
FROM j
"""

OP4 = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ' ' || coalesce(md5(text), 'null')), 1, 15) AS BIGINT) AS h
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS w
  FROM d GROUP BY source
), filled AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap,
         sum(2.0::DOUBLE * source_size) OVER o AS caps, sum(w) OVER o AS ws,
         1.5::DOUBLE * sum(source_size) OVER () AS pool, sum(w) OVER () AS total_w
  FROM s WINDOW o AS (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST)
), levels AS (  -- the water level if exactly the first k sources are full: the right one is the highest
  SELECT max_by(struct_pack(c := caps - cap, w := total_w - (ws - w)), (pool - (caps - cap)) / (total_w - (ws - w))) AS l, any_value(pool) AS pool
  FROM filled
), t AS (
  SELECT f.source, f.source_size, least(f.cap, f.w * (f.pool - l.l.c) / l.l.w) AS target
  FROM filled f, levels l
), b AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS rounds FROM t
), r AS (
  SELECT *, target - rounds * source_size AS budget FROM b
), g AS (
  SELECT source, h, sum(size)::BIGINT AS size FROM d WHERE size > 0 GROUP BY ALL
), c AS (
  SELECT g.*, sum(size) OVER (PARTITION BY source ORDER BY h) AS upto FROM g
), x AS (
  SELECT r.source, min_by(c.h + CASE WHEN c.upto - r.budget < r.budget - (c.upto - c.size) THEN 1 ELSE 0 END, c.h) AS cutoff
  FROM r JOIN c ON r.source IS NOT DISTINCT FROM c.source AND c.upto >= r.budget WHERE r.budget > 0 GROUP BY ALL
)
SELECT d.doc_id, d.size, r.source_size, r.target,
       d.size * (r.rounds + CASE WHEN d.h < coalesce(x.cutoff, 0) THEN 1 ELSE 0 END) AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source LEFT JOIN x ON d.source IS NOT DISTINCT FROM x.source
"""

OP6 = r"""
WITH p AS (
  SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN regexp_extract(url, '(?s)^.*?://(.*)$', 1) ELSE '' END AS tail
  FROM pages
), q AS (
  SELECT page_id, translate(regexp_extract(tail, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(tail, '(?s)^[^/?#]*(/[^?#]*)', 1) AS path
  FROM p
), parts AS (
  SELECT *, string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS l,
         CASE WHEN len(l) >= 3 AND length(l[-1]) = 2 AND l[-2] IN ('ac','co','com','edu','gob','gouv','gov','gv','mil','ne','net','nom','or','org') THEN 2 ELSE 1 END AS k
  FROM q
), named AS (
  SELECT page_id, host, path, array_to_string(l[greatest(1, len(l) - k):], '.') AS domain,
         array_to_string(l[greatest(1, len(l) - k + 1):], '.') AS suffix
  FROM parts
), outcomes AS (
  SELECT n.host, n.domain, n.suffix, CASE WHEN b.quality = 0 OR b.toxic = 1 THEN 1 ELSE 0 END AS bad
  FROM named n JOIN labels b ON b.doc_id = TRY_CAST(regexp_extract(n.path, '^/[a-z]+/([0-9]+)', 1) AS BIGINT)
  WHERE b.quality = 0 OR b.toxic = 1 OR (b.quality IS NOT NULL AND b.toxic IS NOT NULL)
), hs AS (SELECT host, domain, suffix, sum(bad)::DOUBLE AS b, count(*)::DOUBLE AS n FROM outcomes GROUP BY ALL),
dm AS (SELECT domain, suffix, sum(b) AS db, sum(n) AS dn FROM hs GROUP BY ALL),
sx AS (SELECT suffix, sum(b) AS sb, sum(n) AS sn FROM hs GROUP BY ALL),
al AS (SELECT coalesce(sum(b), 0) AS b, coalesce(sum(n), 0) AS n FROM hs),
m0 AS (  -- each suffix's prior: the corpus without it, 20 labels of rate 0.05 added
  SELECT suffix, sb, sn, (1.0 + al.b - sb) / (20.0 + al.n - sn) AS m FROM sx, al
), r1 AS (SELECT sum((sb - sn * m)^2 / sn) AS s, sum(m * (1 - m)) AS v, sum(m * (1 - m) * (sn - 1)) AS w FROM m0),
s1 AS (SELECT CASE WHEN coalesce(w, 0) = 0 THEN 20.0 WHEN s <= v THEN 10000.0 ELSE least(greatest(w / (s - v) - 1, 1.0), 10000.0) END AS k FROM r1),
m1 AS (SELECT d.*, (s1.k * m0.m + sb - db) / (s1.k + sn - dn) AS m FROM dm d JOIN m0 USING (suffix), s1),
r2 AS (SELECT sum((db - dn * m)^2 / dn) AS s, sum(m * (1 - m)) AS v, sum(m * (1 - m) * (dn - 1)) AS w FROM m1),
s2 AS (SELECT CASE WHEN coalesce(w, 0) = 0 THEN 20.0 WHEN s <= v THEN 10000.0 ELSE least(greatest(w / (s - v) - 1, 1.0), 10000.0) END AS k FROM r2),
m2 AS (SELECT h.*, (s2.k * m1.m + db - b) / (s2.k + dn - n) AS m FROM hs h JOIN m1 USING (domain, suffix), s2),
r3 AS (SELECT sum((b - n * m)^2 / n) AS s, sum(m * (1 - m)) AS v, sum(m * (1 - m) * (n - 1)) AS w FROM m2),
s3 AS (SELECT CASE WHEN coalesce(w, 0) = 0 THEN 20.0 WHEN s <= v THEN 10000.0 ELSE least(greatest(w / (s - v) - 1, 1.0), 10000.0) END AS k FROM r3),
each AS (  -- hosts without labels fall back level by level
  SELECT DISTINCT p.host, coalesce(sx.sb, 0) AS sb, coalesce(sx.sn, 0) AS sn, coalesce(dm.db, 0) AS db, coalesce(dm.dn, 0) AS dn,
         coalesce(hs.b, 0) AS hb, coalesce(hs.n, 0) AS hn
  FROM named p LEFT JOIN sx USING (suffix) LEFT JOIN dm ON dm.domain = p.domain AND dm.suffix = p.suffix LEFT JOIN hs ON hs.host = p.host
), up AS (
  SELECT host, hb, hn, (s2.k * ((s1.k * ((1.0 + al.b - sb) / (20.0 + al.n - sn)) + sb - db) / (s1.k + sn - dn)) + db - hb) / (s2.k + dn - hn) AS m
  FROM each, al, s1, s2
), post AS (SELECT host, s3.k * m + hb AS a, s3.k * (1 - m) + hn - hb AS b FROM up, s3),
verdicts AS (  -- P(rate <= 1/4) of Beta(a, b) as a power series of positive terms
  SELECT host, CASE WHEN list_sum(list_transform(range(0, CAST(400 + ceil(20 * sqrt(a + b)) + 2 * greatest(0, ceil((b * 0.25 - a * 0.75) / 0.75)) AS BIGINT)),
    lambda j: exp(lgamma(a + b + j) - lgamma(b) - lgamma(a + 1 + j) + (a + j) * ln(0.25) + b * ln(0.75)))) < 0.05 THEN 'block' ELSE 'allow' END AS own
  FROM post
)
SELECT n.page_id, n.host, n.path,
  CASE WHEN (n.host = 'example.com' OR n.host LIKE '%.example.com') AND starts_with(n.path, '/de/') THEN 'example.com/de/'
       WHEN (n.host = 'example.net' OR n.host LIKE '%.example.net') AND starts_with(n.path, '/en/') THEN 'example.net/en/'
       WHEN (n.host = 'org' OR n.host LIKE '%.org') AND starts_with(n.path, '/fr/') THEN 'org/fr/'
       WHEN (n.host = 'net' OR n.host LIKE '%.net') AND starts_with(n.path, '/') THEN 'net/' END AS rule,
  CASE rule WHEN 'example.com/de/' THEN 'block' WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow'
            WHEN 'net/' THEN 'block' ELSE v.own END AS verdict
FROM named n JOIN verdicts v USING (host)
"""

OP8 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), base AS (
  SELECT r, doc_id, lang, t, w, len(w) AS n_words,
         length(array_to_string(w, '')) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
         len(regexp_extract_all(t, '\p{Lu}')) AS n_upper, len(regexp_extract_all(t, '\p{Nd}')) AS n_digit,
         len(regexp_extract_all(t, '[.,;:!?()''"-]')) AS n_mark,
         len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
         - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines
  FROM d
), win AS (
  SELECT r, i, array_to_string(w[i:i+4], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1
), covered AS (
  SELECT r, sum(least(5, i - coalesce(before, -5))) AS n_repeat_words
  FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM twice) GROUP BY r
), shorts AS (
  SELECT r, lang, lower(x) AS x FROM (SELECT r, lang, unnest(w) AS x FROM d WHERE lang IS NOT NULL)
), counts AS (SELECT lang, x, count(*) AS n FROM shorts GROUP BY ALL),
totals AS (
  SELECT lang, sum(n_words) AS total, sum(n_upper) AS c0, sum(n_digit) AS c1, sum(length(t) - word_chars) AS c2, sum(n_symbols) AS c3,
         sum(n_mark) AS c4, sum(length(t)) AS chars FROM base GROUP BY lang
), top AS (
  SELECT c.lang, x, n::DOUBLE / total AS p FROM (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, encode(x)) AS k FROM counts) c JOIN totals USING (lang) WHERE k <= 32
), classes AS (
  SELECT lang, [c0, c1, c2, c3, c4, chars - c0 - c1 - c2 - c3 - c4] AS c, greatest(chars, 1) AS chars FROM totals
  WHERE lang IN (SELECT lang FROM top)
  UNION ALL SELECT NULL, [sum(c0), sum(c1), sum(c2), sum(c3), sum(c4), sum(chars - c0 - c1 - c2 - c3 - c4)], greatest(sum(chars), 1) FROM totals
), cell AS (  -- character classes, then common words, as (document, test, reference share, own share)
  SELECT b.r, 'c' AS test, c.c[k]::DOUBLE / c.chars AS p,
         [n_upper, n_digit, length(t) - word_chars, n_symbols, n_mark,
          length(t) - n_upper - n_digit - (length(t) - word_chars) - n_symbols - n_mark][k]::DOUBLE / greatest(length(t), 1) AS q
  FROM (SELECT *, unnest(range(1, 7)) AS k FROM base WHERE length(t) >= 150) b
  JOIN classes c ON c.lang IS NOT DISTINCT FROM (CASE WHEN b.lang IN (SELECT lang FROM top) THEN b.lang END)
  UNION ALL
  SELECT b.r, 'w', top.p, coalesce(s.n, 0)::DOUBLE / b.n_words
  FROM base b JOIN top USING (lang) LEFT JOIN (SELECT r, x, count(*) AS n FROM shorts GROUP BY ALL) s ON s.r = b.r AND s.x = top.x
  WHERE b.n_words >= 50
), whole AS (
  SELECT * FROM cell UNION ALL SELECT r, 'w', 1 - sum(p), 1 - sum(q) FROM cell WHERE test = 'w' GROUP BY r
), gaps AS (
  SELECT r, test, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2 AS jsd
  FROM whole GROUP BY ALL
), far AS (SELECT DISTINCT r FROM gaps WHERE jsd > CASE test WHEN 'c' THEN 0.08 ELSE 0.18 END)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
       n_words < 10 OR 100 * coalesce(n_repeat_words, 0) > 20 * n_words AS base_failed,
       NOT base_failed AND far.r IS NULL AS kept
FROM base LEFT JOIN covered USING (r) LEFT JOIN far USING (r)
"""


OP11 = r"""
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), good AS (
  SELECT r, vec_id, e FROM v
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT a.r AS a, b.r AS b FROM good a JOIN good b ON a.r < b.r AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (
  SELECT r AS a, r AS b FROM v
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), low AS (SELECT reach.a AS r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY 1)
SELECT v.vec_id, CAST((SELECT count(*) FROM links WHERE links.a = v.r) AS BIGINT) AS n_links, low.component_id,
       v.vec_id IS NOT DISTINCT FROM low.component_id AS kept
FROM v JOIN low ON low.r = v.r
"""

OP12 = r"""
WITH tab AS (  -- the table of the CRC-32, from its rule
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
              lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END) ORDER BY i) AS tab
  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i)
), t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS txt,
         sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS id
  FROM conversations WHERE conv_id IS NOT NULL
), o AS (
  SELECT conv_id, list(struct_pack(id := id, n := len(regexp_extract_all(txt, '[^\x20\x09-\x0D]+'))) ORDER BY turn NULLS FIRST, id) AS own
  FROM t GROUP BY conv_id
), h AS (
  SELECT o.conv_id, own, xor(list_reduce([4294967295] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
         lambda x, b: xor(x // 256, tab.tab[xor(x, b) % 256 + 1])), 4294967295) % 4 AS h
  FROM o, tab
), p AS (
  SELECT h.conv_id, coalesce(b.own, [])[1:h.h] || h.own[h.h + 1:] AS path
  FROM h LEFT JOIN o b ON b.conv_id = h.conv_id - h.conv_id % 20
), m AS (  -- a row per conversation and node on its path
  SELECT conv_id, len(path) AS size, d, coalesce(path[d].n, 0) AS n_words,
         sha256(array_to_string(list_transform(path[1:d], lambda x: x.id), ',')) AS node,
         CASE WHEN d > 0 THEN sha256(array_to_string(list_transform(path[1:d - 1], lambda x: x.id), ',')) END AS up
  FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS d FROM p)
), n AS (
  SELECT node, d, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n_words) AS n_words,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE size = d), '')) AS ends_sha256
  FROM m GROUP BY node, d
), kids AS (SELECT up AS node, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY up),
below AS (  -- every node with each node on the way up from it
  SELECT m.node AS top, n.n_words, n.n_convs, k.n_children
  FROM n JOIN m ON m.conv_id = n.conv_id AND m.d <= n.d LEFT JOIN kids k ON k.node = n.node
), sums AS (
  SELECT top AS node, sum((n_convs - 1) * n_words) AS saved, count(*) FILTER (WHERE n_children IS NULL) AS leaves FROM below GROUP BY top
)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, a.conv_id AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs,
       CAST(coalesce(k.n_children, 0) AS BIGINT) AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN sums s ON s.node = n.node LEFT JOIN kids k ON k.node = n.node LEFT JOIN n a ON a.node = n.up
"""

OP13 = r"""
WITH w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)
), totals AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (
    SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)
), f AS (
  SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS f FROM g GROUP BY ALL HAVING count(*) >= 30
), cut AS (
  SELECT c.lang, c.k, c.phrase, c.f AS a, i, string_split(c.phrase, ' ') AS s,
         array_to_string(s[1:i], ' ') AS lp, array_to_string(s[i + 1:], ' ') AS rp
  FROM (SELECT *, unnest(range(1, k)) AS i FROM f WHERE k > 1) c
), scored AS (
  SELECT cut.lang, cut.k, cut.phrase, a, l.f AS l, r.f AS r, i, (2000000 * a) // (l.f + r.f) AS score
  FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = lp JOIN f r ON r.lang = cut.lang AND r.phrase = rp
), best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) AS o FROM scored) WHERE o = 1
), kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM f x WHERE x.lang = b.lang AND x.k > b.k AND contains(' ' || x.phrase || ' ', ' ' || b.phrase || ' ') AND 100 * x.f >= 80 * b.a)
)
SELECT kept.lang, CAST(row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, encode(phrase)) AS BIGINT) AS rank, phrase,
       CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept JOIN totals ON totals.lang = kept.lang QUALIFY rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_warc_index": OP2, "op4_source_mix": OP4, "op6_host_reputation": OP6, "op8_distribution_quality": OP8,
            "op11_hyperplane_dedup": OP11, "op12_prefix_trie": OP12, "op13_collocations": OP13}
