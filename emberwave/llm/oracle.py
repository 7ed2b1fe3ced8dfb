"""SQL that the operators' queries are held against, where SQL can say what they compute.

The others have none: suffix arrays, tokenizers, trained models, HTML trees and WARC records. Brute-force versions in tests/llm stand in for them. The SQL of near duplicates compares all pairs
that share a shingle and closes the links transitively, which is for tables of thousands of rows.
"""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_TOKENS = f"regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+')"

SQL: dict[str, str] = {
    "op9_source_mix": f"""WITH d AS (SELECT doc_id, text, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
 z AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
 w AS (SELECT source, source_size, CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS DOUBLE) AS weight, CAST(source_size AS DOUBLE) * 2 AS room FROM z),
 r AS (SELECT *, room / weight AS fits FROM w),
 s AS (SELECT *, coalesce(sum(room) OVER before, 0) AS held, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS free, CAST(sum(source_size) OVER () AS DOUBLE) * CAST(1.5 AS DOUBLE) AS total FROM r
  WINDOW before AS (ORDER BY fits, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 l AS (SELECT *, (total - held) / free AS level FROM s),
 t AS (SELECT source, source_size, coalesce(least(room, weight * (SELECT level FROM l WHERE level <= fits ORDER BY fits, level LIMIT 1)), room) AS target FROM l),
 q AS (SELECT doc_id, d.source, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE CAST(0 AS DOUBLE) END AS rate,
  CAST('0x' || substr(md5('9:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(text, '')), 1, 13) AS BIGINT) AS h,
  length(bin(size)) * 16 + (size >> CAST(greatest(length(bin(size)) - 4, 0) AS BIGINT)) AS step, (SELECT greatest(64, CAST(ceil(count(*) / 10000) AS BIGINT)) FROM d) AS buckets FROM d JOIN t ON t.source IS NOT DISTINCT FROM d.source),
 g AS (SELECT source, step, h % buckets AS bucket, count(*) AS n, any_value(rate - floor(rate)) AS part,
  CAST(CAST('0x' || substr(md5('9:' || coalesce(source, 'null')), 1, 13) AS BIGINT) AS DOUBLE) * CAST({2.0**-52!r} AS DOUBLE) AS shift FROM q GROUP BY source, step, bucket),
 p AS (SELECT *, CAST(coalesce(sum(n) OVER (PARTITION BY source ORDER BY step, bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS before FROM g),
 k AS (SELECT source, step, bucket, floor((before + n) * part + shift) - floor(before * part + shift) AS k FROM p),
 o AS (SELECT q.*, k.k, rank() OVER (PARTITION BY q.source, q.step, k.bucket ORDER BY h) AS place FROM q JOIN k ON k.source IS NOT DISTINCT FROM q.source AND k.step = q.step AND k.bucket = q.h % q.buckets)
 SELECT doc_id, size, source_size, target, CAST(floor(rate) + CASE WHEN place <= k THEN 1 ELSE 0 END AS BIGINT) * size AS taken FROM o""",
    "op7_minmax_near_dedup": f"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, {_TOKENS} AS w FROM documents),
 s AS (SELECT r, doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct([w[i] || chr(31) || w[i + 1] for i in range(1, len(w))]) END AS g FROM d),
 e AS (SELECT r, unnest(g) AS k FROM s),
 met AS (SELECT a.r AS a, b.r AS b, count(*) AS n FROM e a JOIN e b ON a.k = b.k AND a.r < b.r GROUP BY a.r, b.r),
 links AS (SELECT a, b FROM met JOIN s x ON x.r = met.a JOIN s y ON y.r = met.b WHERE 100 * n >= 80 * (len(x.g) + len(y.g) - n)),
 ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
 reach AS (SELECT r, r AS q FROM s UNION SELECT reach.r, ways.b FROM reach JOIN ways ON ways.a = reach.q),
 least AS (SELECT reach.r, min(s.doc_id) AS component_id FROM reach JOIN s ON s.r = reach.q GROUP BY reach.r)
 SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN least ON least.r = s.r""",
    "op4_decontamination": f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents), i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
 sized AS (SELECT item, w, least(10, len(w)) AS n FROM i WHERE len(w) > 0),
 windows AS (SELECT DISTINCT item, n, array_to_string(w[CAST(p AS INTEGER) + 1:CAST(p AS INTEGER) + n], ' ') AS k FROM (SELECT item, n, w, unnest(range(0, len(w) - n + 1)) AS p FROM sized) q),
 lengths AS (SELECT DISTINCT n FROM windows),
 places AS (SELECT r, w, unnest(range(0, len(w))) AS p FROM d),
 grams AS (SELECT r, p, n, array_to_string(w[CAST(p AS INTEGER) + 1:CAST(p AS INTEGER) + n], ' ') AS k FROM places, lengths WHERE p + n <= len(w)),
 met AS (SELECT g.r, g.p, g.n, v.item FROM grams g JOIN windows v ON v.n = g.n AND v.k = g.k),
 words AS (SELECT r, count(DISTINCT p + o.o) AS n_hit FROM met, range(0, 10) o(o) WHERE o.o < n GROUP BY r),
 items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS said FROM (SELECT DISTINCT r, item FROM met) q GROUP BY r)
 SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(words.n_hit, 0) AS n_hit, coalesce(items.n_items, 0) AS n_items, sha256(coalesce(items.said, '')) AS items_sha256, coalesce(words.n_hit, 0) > 0 AS contaminated
 FROM d LEFT JOIN words ON words.r = d.r LEFT JOIN items ON items.r = d.r""",
    "op12_prefix_trie": """WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
  md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, '')) AS g, length(coalesce(text, '')) AS chars FROM conversations WHERE conv_id IS NOT NULL),
 c AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 100 AS base,
  xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
   lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y >> 1, CAST(3988292384 AS BIGINT)) ELSE y >> 1 END)), CAST(4294967295 AS BIGINT)) % 6 AS h FROM t GROUP BY conv_id),
 r AS (SELECT t.conv_id, t.i - c.h + least(c.h, coalesce(b.n, 0)) AS depth, g, chars FROM t JOIN c ON c.conv_id = t.conv_id LEFT JOIN c b ON b.conv_id = c.base WHERE t.i > c.h
  UNION ALL SELECT c.conv_id, t.i, g, chars FROM c JOIN t ON t.conv_id = c.base AND t.i <= c.h),
 p AS (SELECT conv_id, depth, chars, sha256(string_agg(g, ',') OVER (PARTITION BY conv_id ORDER BY depth)) AS node, max(depth) OVER (PARTITION BY conv_id) = depth AS ends FROM r
  UNION ALL SELECT c.conv_id, 0, 0, '', NOT EXISTS (SELECT 1 FROM r WHERE r.conv_id = c.conv_id) FROM c),
 n AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saved, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM p GROUP BY node, depth),
 e AS (SELECT n.node, p.node AS parent, n.depth FROM n JOIN p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
 k AS (SELECT parent, count(*) AS n_children FROM e GROUP BY parent),
 s AS (SELECT p.node, CAST(sum(CASE WHEN k.parent IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves, CAST(sum(n.saved) AS BIGINT) AS saved_tokens FROM n LEFT JOIN k ON k.parent = n.node
  JOIN p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY p.node)
 SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, a.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
 FROM n JOIN s ON s.node = n.node LEFT JOIN k ON k.parent = n.node LEFT JOIN e ON e.node = n.node LEFT JOIN n a ON a.node = e.parent""",
    "op13_filter_audit": """WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
 w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM d),
 first AS (SELECT text, min(doc_id) AS least FROM d GROUP BY text),
 known AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS bad FROM labels GROUP BY doc_id),
 failed AS (SELECT w.part, coalesce(known.good, false) AS good, coalesce(known.bad, false) AS bad,
  (CASE WHEN len(words) < 200 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END)
  || (CASE WHEN 100 * len(regexp_extract_all(w.text, '[A-Z]')) > 3 * length(w.text) THEN 'C' ELSE '' END) || (CASE WHEN regexp_matches(w.text, '[#$%&*|]') THEN 'D' ELSE '' END)
  || (CASE WHEN w.doc_id > first.least THEN 'E' ELSE '' END) AS fails
  FROM w JOIN first ON first.text = w.text LEFT JOIN known ON known.doc_id = w.doc_id),
 counted AS (SELECT part, good, bad, fails, count(*) AS n FROM failed GROUP BY ALL),
 letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
 orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
 steps AS (SELECT filter_order, CAST(k AS INTEGER) AS step, substr(filter_order, 1, k - 1) AS before, substr(filter_order, k, 1) AS own FROM orders, (SELECT unnest(range(1, 6)) AS k) q),
 met AS (SELECT part, filter_order, step, own, n, good, bad, fails, contains(fails, own) AS fail, length(translate(before, fails, '')) < length(before) AS earlier FROM counted, steps),
 added AS (SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (NOT fail AND NOT earlier), 0) AS kept, coalesce(sum(n) FILTER (fail AND NOT earlier), 0) AS removed,
  coalesce(sum(n) FILTER (fail AND earlier), 0) AS redundant, coalesce(sum(n) FILTER (fails = own), 0) AS unique_fails,
  coalesce(sum(n) FILTER (fail AND NOT earlier AND good), 0) AS good_lost, coalesce(sum(n) FILTER (fail AND NOT earlier AND bad), 0) AS toxic_lost FROM met GROUP BY part, filter_order, step, own)
 SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
 CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM added""",
}
