"""SQL (DuckDB) for the queries of this package that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op7_warc"] = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM p
), r AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS response FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND response <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND response <> page_id THEN response END AS refers_to
FROM r
"""

ORACLE["op8_decontamination"] = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT item_id, least(len(w), 10) AS k,
         unnest([array_to_string(w[i : i + least(len(w), 10) - 1], ' ') FOR i IN range(1, len(w) - least(len(w), 10) + 2)]) AS t
  FROM iw WHERE len(w) > 0
), sizes AS (
  SELECT DISTINCT k FROM win
), dwin AS (
  SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS t
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, sizes WHERE len(w) >= k)
), occ AS (
  SELECT d.doc_id, d.k, d.i, b.item_id FROM dwin d JOIN win b ON d.k = b.k AND d.t = b.t
), hit AS (
  SELECT doc_id, count(*) AS n_hit FROM (
    SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS at FROM (SELECT DISTINCT doc_id, i, k FROM occ)
  ) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM occ) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLE["op2_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest([array_to_string(w[i : i + least(len(w), 5) - 1], ' ') FOR i IN range(1, len(w) - least(len(w), 5) + 2)]) AS t
  FROM w WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM s a JOIN s b ON a.t = b.t AND a.doc_id <> b.doc_id
  JOIN sizes m ON m.doc_id = a.doc_id JOIN sizes n ON n.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, m.n, n.n
  HAVING 100 * count(*) >= 80 * (m.n + n.n - count(*))
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) r USING (doc_id)
"""

ORACLE["op4_substring_dedup"] = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i : i + 34], ' ') AS t
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM w WHERE len(w) >= 35)
), twice AS (
  SELECT t FROM win GROUP BY t HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS word_at FROM win SEMI JOIN twice USING (t)
), lists AS (
  SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id
), kept AS (
  SELECT w.doc_id, string_agg(x.word, ' ' ORDER BY x.word_at) AS t
  FROM w, (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS word_at FROM w) x
  WHERE w.doc_id = x.doc_id AND NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = x.doc_id AND g.word_at = x.word_at)
  GROUP BY w.doc_id
)
SELECT w.doc_id, len(w.w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN lists USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

ORACLE["op9_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS line_no
  FROM documents
), s AS (
  SELECT doc_id, line_no, line, list_sort(list_distinct(regexp_extract_all(
    translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'))) AS w
  FROM l
), node AS (
  SELECT row_number() OVER () AS node, w, len(w) AS n, min((doc_id, line_no)) AS age FROM s WHERE len(w) >= 1 GROUP BY w
), head AS (
  SELECT node, unnest(w[1 : n - ((80 * n + 99) // 100) + 1]) AS word FROM node WHERE 100 * n >= 80 * (n + 1)  -- others match equal sets only
), pairs AS (
  SELECT DISTINCT least(a.node, b.node) AS x, greatest(a.node, b.node) AS y FROM head a JOIN head b ON a.word = b.word AND a.node <> b.node
), matched AS (
  SELECT DISTINCT CASE WHEN m.age > k.age THEN m.node ELSE k.node END AS node
  FROM pairs JOIN node m ON m.node = x JOIN node k ON k.node = y
  WHERE 100 * least(m.n, k.n) >= 80 * greatest(m.n, k.n)
    AND 100 * len(list_intersect(m.w, k.w)) >= 80 * (m.n + k.n - len(list_intersect(m.w, k.w)))
), kept AS (
  SELECT s.doc_id, s.line_no, s.line, s.w,
         len(s.w) < 1 OR (node.age = (s.doc_id, s.line_no) AND matched.node IS NULL) AS stays
  FROM s LEFT JOIN node ON s.w = node.w LEFT JOIN matched ON matched.node = node.node
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (stays), '')) AS kept_sha256
FROM kept GROUP BY doc_id
"""


def _spread(name: str, seeds: str, edges: str, steps: int = 20) -> str:
    """CTEs ``{name}0 .. {name}{steps}`` of personalised PageRank, one step each."""
    parts = [
        f"{name}_jump AS (SELECT host, 0.15::DOUBLE AS score FROM ({seeds}))",
        f"{name}_edge AS (SELECT src, dst, 0.85 / count(*) OVER (PARTITION BY src) AS share FROM ({edges}))",
        f"{name}0 AS (SELECT * FROM {name}_jump)",
    ]
    parts += [
        f"{name}{i} AS MATERIALIZED (SELECT host, sum(score) AS score FROM (SELECT e.dst AS host, e.share * s.score AS score "
        f"FROM {name}_edge e JOIN {name}{i - 1} s ON s.host = e.src UNION ALL SELECT host, score FROM {name}_jump) GROUP BY host)"
        for i in range(1, steps + 1)
    ]
    return ",\n".join(parts)


ORACLE["op1_url_filters"] = (
    r"""
WITH u AS (
  SELECT page_id, html,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), rules(rule, verdict) AS (
  VALUES ('net/', 'block'), ('example.net/en/', 'allow'), ('example.com/de/', 'block'), ('org/fr/', 'allow')
), r AS (
  SELECT u.page_id, u.host, u.path, u.html, x.rule, x.verdict
  FROM u LEFT JOIN rules x ON (u.host = split_part(x.rule, '/', 1) OR ends_with(u.host, '.' || split_part(x.rule, '/', 1)))
    AND starts_with(u.path, substr(x.rule, strpos(x.rule, '/')))
), longest AS (
  SELECT * FROM r WHERE rule IS NULL OR length(rule) = (SELECT max(length(q.rule)) FROM r q WHERE q.host = r.host AND q.path = r.path)
), hosts AS (
  SELECT host, avg(CASE WHEN verdict = 'allow' THEN 1.0 ELSE 0.0 END) AS allowed, avg(CASE WHEN verdict = 'block' THEN 1.0 ELSE 0.0 END) AS blocked
  FROM longest WHERE host <> '' GROUP BY host
), links AS (
  SELECT DISTINCT host AS src, translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst
  FROM (SELECT host, unnest(regexp_extract_all(html, '(?i)(?:href|src|action)\s*=\s*["'']?\s*(?:https?:)?//([^/?#"''\s>]+)', 1)) AS x FROM u WHERE host <> '')
  WHERE host <> translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
),
"""
    + _spread("t", "SELECT host FROM hosts WHERE allowed > 0.5", "SELECT src, dst FROM links")
    + ",\n"
    + _spread("d", "SELECT host FROM hosts WHERE blocked > 0.5", "SELECT dst AS src, src AS dst FROM links")
    + """
SELECT l.page_id, l.host, l.path, l.rule,
       coalesce(l.verdict, CASE WHEN coalesce(d20.score, 0) > coalesce(t20.score, 0) AND coalesce(d20.score, 0) > 1e-4 THEN 'block' ELSE 'allow' END) AS verdict
FROM longest l LEFT JOIN t20 ON t20.host = l.host LEFT JOIN d20 ON d20.host = l.host
"""
)


ORACLE["op11_source_mixing"] = r"""
WITH said AS (
  SELECT doc_id, max(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id
), d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         -ln((CAST('0x' || substr(md5('mix-' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)
           / CASE quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END::DOUBLE AS key
  FROM documents LEFT JOIN said USING (doc_id)
), s AS (
  SELECT source, sum(size)::DOUBLE AS source_size,
         [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
  FROM d GROUP BY source
), filled AS (  -- sources by how soon they are full; the first k of them are capped
  SELECT *, 1.5 * sum(source_size) OVER () AS budget,
         coalesce(sum(2 * source_size) OVER (ORDER BY source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
         sum(weight) OVER (ORDER BY source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
         2 * source_size / weight AS full_at
  FROM s
), level AS (
  SELECT budget - capped AS words_left, open_weight FROM filled
  WHERE (budget - capped) / open_weight <= full_at ORDER BY full_at LIMIT 1
), t AS (
  SELECT source, source_size, least(2 * source_size, weight * words_left / open_weight) AS target FROM s, level
), k AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs,
         sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), r AS (
  SELECT *, target - epochs * source_size AS rest FROM k
)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
       (size * (epochs + CASE WHEN rest > before AND 2 * (rest - before) > size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""

ORACLE["op12_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

ORACLE["op13_filter_audit"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), said AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN min(doc_id) OVER (PARTITION BY t) < doc_id THEN 'E' ELSE '' END AS fails
  FROM d LEFT JOIN said USING (doc_id)
), c AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic FROM f GROUP BY part, fails
), x(x) AS (
  VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT part, filter_order, step, filter_order[step] AS own, filter_order[1 : step - 1] AS earlier
  FROM orders, (SELECT unnest(range(1, 6)) AS step), (SELECT DISTINCT part FROM c)
), j AS (
  SELECT s.*, c.n, c.n_good, c.n_toxic, c.fails, contains(c.fails, s.own) AS here,
         s.earlier <> '' AND c.fails <> '' AND regexp_matches(c.fails, '[' || s.earlier || '-]') AS gone
  FROM steps s JOIN c USING (part)
), r AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (NOT here AND NOT gone), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (here AND NOT gone), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (here AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (fails = own), 0)::BIGINT AS unique_fails,
         coalesce(sum(n_good) FILTER (here AND NOT gone), 0)::BIGINT AS good_lost, coalesce(sum(n_toxic) FILTER (here AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM j GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM r
"""
