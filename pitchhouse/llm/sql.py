"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

MIX = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS tie,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS k
  FROM sized GROUP BY source
), weighed AS (
  SELECT source, source_size, CASE k WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w
  FROM per
), levels AS (
  -- one row for each set of stopped sources that can be the last: those of the smallest limits per weight
  SELECT source, source_size, w, row_number() OVER o AS place,
         (sum(source_size) OVER () * 1.5 - coalesce(sum(2.0 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed WINDOW o AS (ORDER BY source_size / w, source NULLS LAST)
), stop AS (
  SELECT level, place FROM levels WHERE 2.0 * source_size >= level * w ORDER BY place LIMIT 1
), goal AS (
  SELECT l.source, l.source_size, CASE WHEN l.place < s.place THEN 2.0 * l.source_size ELSE s.level * l.w END::DOUBLE AS target
  FROM levels l CROSS JOIN stop s
), placed AS (
  SELECT s.doc_id, s.size, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS rate,
         ('0x' || md5('mix:' || coalesce(s.source, chr(0) || 'null'))[1:8])::BIGINT / 4294967296.0::DOUBLE AS u,
         (row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id NULLS LAST, s.tie))::DOUBLE AS place
  FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
       (size * least(2, floor(place * rate + u) - floor((place - 1) * rate + u)))::BIGINT AS taken
FROM placed
"""

DECONTAMINATION = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM items WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM words, lengths WHERE len(w) >= n)
), found AS (
  SELECT p.doc_id, p.i, p.n, x.item_id FROM places p JOIN windows x ON p.n = x.n AND p.win = x.win
), hits AS (
  SELECT doc_id, count(DISTINCT word_at) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS word_at FROM found) GROUP BY doc_id
), listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words d LEFT JOIN hits USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


URLS = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), base AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), known AS (
  SELECT doc_id, min(CASE WHEN quality = 1 AND coalesce(toxic, 0) = 0 THEN 1 ELSE 0 END) AS y
  FROM labels WHERE quality IS NOT NULL GROUP BY doc_id
), hosts AS (
  SELECT host, count(y) AS n, coalesce(sum(y), 0) AS y FROM base LEFT JOIN known ON page_id = doc_id GROUP BY host
), named AS (
  SELECT host, n, y, string_split(host, '.') AS l,
         CASE WHEN array_to_string(l[-2:], '.') IN (%(suffixes)s) THEN 2 ELSE 1 END AS k,
         array_to_string(l[-(k + 1):], '.') AS domain, array_to_string(l[-k:], '.') AS suffix
  FROM hosts
), level0 AS (
  SELECT suffix, sum(n) AS n, sum(y) AS y, (sum(sum(y)) OVER () + 1.0::DOUBLE) / (sum(sum(n)) OVER () + 2) AS m
  FROM named GROUP BY suffix
), r0 AS (
  SELECT least(greatest(coalesce(round(sum((y - n * m) ** 2 / (m * (1 - m)) - n) / nullif(sum(n * (n - 1)), 0), 6), 0.5), 0.001), 0.5) AS r FROM level0
), suffixes AS (
  SELECT suffix, ((1 / r - 1) * m + y) / ((1 / r - 1) + n) AS m FROM level0, r0
), level1 AS (
  SELECT suffix, domain, sum(n) AS n, sum(y) AS y, any_value(s.m) AS m
  FROM named JOIN suffixes s USING (suffix) GROUP BY suffix, domain
), r1 AS (
  SELECT least(greatest(coalesce(round(sum((y - n * m) ** 2 / (m * (1 - m)) - n) / nullif(sum(n * (n - 1)), 0), 6), 0.5), 0.001), 0.5) AS r FROM level1
), domains AS (
  SELECT suffix, domain, ((1 / r - 1) * m + y) / ((1 / r - 1) + n) AS m FROM level1, r1
), level2 AS (
  SELECT host, n, y, d.m FROM named JOIN domains d USING (suffix, domain)
), r2 AS (
  SELECT least(greatest(coalesce(round(sum((y - n * m) ** 2 / (m * (1 - m)) - n) / nullif(sum(n * (n - 1)), 0), 6), 0.5), 0.001), 0.5) AS r FROM level2
), beta AS (
  SELECT host, (1 / r - 1) * m + y AS a, (1 / r - 1) * (1 - m) + n - y AS b FROM level2, r2
), posterior AS (
  SELECT host, a / (a + b) AS mean, sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS deviation FROM beta
), rules AS (SELECT * FROM (VALUES %(rules)s) AS t(verdict, rule_host, rule_path)
), fits AS (
  SELECT DISTINCT b.host, b.path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM (SELECT DISTINCT host, path FROM base) b
  JOIN rules ON (b.host = rule_host OR ends_with(b.host, '.' || rule_host)) AND starts_with(b.path, rule_path)
  GROUP BY b.host, b.path
)
SELECT b.page_id, b.host, b.path, f.rule,
       coalesce(f.verdict, CASE WHEN round(p.mean - 1.2816 * p.deviation, 6) >= 0.5 THEN 'allow' ELSE 'block' END) AS verdict,
       round(p.mean, 6) AS host_mean, round(p.mean - 1.2816 * p.deviation, 6) AS host_bound
FROM base b JOIN posterior p USING (host) LEFT JOIN fits f ON b.host = f.host AND b.path = f.path
""" % {
    "suffixes": """'ac.uk','co.in','co.jp','co.kr','co.nz','co.uk','co.za','com.ar','com.au','com.br','com.cn','com.mx',
    'com.tr','com.tw','edu.au','gov.au','gov.uk','net.au','ne.jp','or.jp','org.au','org.uk'""",
    "rules": """('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')""",
}


TRIE = r"""
WITH powers AS (
  -- CRC-32 of every byte, from its polynomial
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END) ORDER BY i) AS of_byte
  FROM (SELECT unnest(range(256))::BIGINT AS i)
), turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, left(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 32)) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, c - c % 100 AS base, count(*) AS n,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda k: ascii(k)::BIGINT)),
                         lambda v, k: xor(v // 256, of_byte[1 + xor(v, k) % 256])), 4294967295) % 6 AS h
  FROM turns CROSS JOIN powers GROUP BY c, of_byte
), sized AS (
  SELECT v.c, v.base, v.h, least(v.h, coalesce(b.n, 0)) AS taken FROM convs v LEFT JOIN convs b ON b.c = v.base
), built AS (
  SELECT t.c, t.pos - s.h + s.taken AS d, t.r, t.x FROM turns t JOIN sized s ON s.c = t.c WHERE t.pos > s.h
  UNION ALL
  SELECT s.c, t.pos, t.r, t.x FROM turns t JOIN sized s ON s.base = t.c WHERE t.pos <= s.h
), ways AS (
  SELECT c, d, length(x) AS chars,
         string_agg(length(r) || ':' || r || length(x) || ':' || x, '') OVER (PARTITION BY c ORDER BY d) AS p
  FROM built
  UNION ALL
  SELECT c, 0, 0, '' FROM convs
), linked AS (
  SELECT *, lag(p) OVER (PARTITION BY c ORDER BY d) AS up, lead(d) OVER (PARTITION BY c ORDER BY d) IS NULL AS ends FROM ways
), nodes AS (
  SELECT d, p, any_value(up) AS up, any_value(chars) AS chars, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM linked GROUP BY d, p
), children AS (SELECT up AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY up),
under AS (
  SELECT DISTINCT a.p AS top, b.p FROM ways a JOIN ways b ON a.c = b.c AND b.d >= a.d
), sums AS (
  SELECT u.top AS p, count(*) FILTER (k.n_children IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved_tokens
  FROM under u JOIN nodes n ON n.p = u.p LEFT JOIN children k ON k.p = u.p GROUP BY u.top
)
SELECT n.conv_id::BIGINT AS conv_id, n.d::BIGINT AS depth, q.conv_id::BIGINT AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       coalesce(k.n_children, 0)::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens,
       n.ends_sha256
FROM nodes n JOIN sums s ON s.p = n.p LEFT JOIN children k ON k.p = n.p LEFT JOIN nodes q ON q.p = n.up
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filters": URLS, "op3_benchmark_decontamination": DECONTAMINATION, "op10_mix_sources": MIX,
            "op11_conversation_prefix_trie": TRIE}
