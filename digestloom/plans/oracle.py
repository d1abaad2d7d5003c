"""The catalogue's queries as plain SQL for an independent engine (DuckDB dialect).

Written from the meaning of each query, the long way round: pair joins instead of factored
sums, global windows instead of range partitions.
"""

from __future__ import annotations

from digestloom.functions.slug import SIGNS, accents
from digestloom.functions.text import STOPWORDS
from digestloom.plans.queries import AS_OF, BASE_URL, LISTING_PAGES, READINGS, SCRIPTS, SEARCH_TERMS, STOP_TABLE, STYLE

WS = r"[\t\n\x0B\f\r \x1C-\x1F\x{85}\p{Z}]"


def _values(items) -> str:
    return ", ".join("'" + i.replace("'", "''") + "'" for i in items)


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def _id(n: str) -> str:
    return f"CAST(20240101000000 + {n} AS VARCHAR)"


def _terms(table: str = "documents", key: str = "doc_id", column: str = "text", prefix: str = "", k: int = 7) -> str:
    """CTEs ``{prefix}tok`` (kept tokens), ``{prefix}cnt`` (counts) and ``{prefix}tot``."""
    return f"""
{prefix}tok AS (
  SELECT {key}, term, pos FROM (
    SELECT {key}, unnest(l) AS term, generate_subscripts(l, 1) AS pos
    FROM (SELECT {key}, regexp_extract_all(lower({column}), '[\\p{{L}}\\p{{N}}]+') AS l FROM {table}))
  WHERE length(term) > 1 AND term NOT IN ({_values(STOPWORDS)})),
{prefix}cnt AS (
  SELECT {key}, term, count(*) AS tf_count, min(pos) AS first_pos FROM {prefix}tok GROUP BY ALL),
{prefix}tot AS (SELECT {key}, count(*) AS n_tokens FROM {prefix}tok GROUP BY ALL),
{prefix}top AS (
  SELECT * FROM (
    SELECT {key}, term, tf_count,
           row_number() OVER (PARTITION BY {key} ORDER BY tf_count DESC, first_pos) AS rn
    FROM {prefix}cnt) WHERE rn <= {k}),
{prefix}kw AS (
  SELECT {key}, string_agg(term, ', ' ORDER BY rn) AS keywords, list(term ORDER BY rn) AS tags
  FROM {prefix}top GROUP BY ALL)"""


def _sentences(table: str = "documents", key: str = "doc_id", column: str = "text", lines: bool = False) -> str:
    """CTE ``sent``: one row per sentence, counted from 0; ``lines`` ends sentences with the line, too."""
    marked = f"regexp_replace({column}, '([.!?]){WS}+', '\\1' || chr(30), 'g')"
    if lines:
        marked = f"translate({marked}, chr(10) || chr(13), chr(30) || chr(30))"
    return f"""
cut AS (
  SELECT {key}, string_split({marked}, chr(30)) AS l
  FROM {table}),
raw AS (SELECT {key}, {_strip("unnest(l)")} AS sentence, generate_subscripts(l, 1) AS nth FROM cut),
sent AS (
  SELECT {key}, row_number() OVER (PARTITION BY {key} ORDER BY nth) - 1 AS sent_idx, sentence
  FROM raw WHERE sentence <> '')"""


RANK_STEPS = 40


_SPACED = f"string_split_regex(lower(sentence), '{WS}+')"
_TOKENS = "regexp_extract_all(lower(sentence), '[\\p{L}\\p{N}]+')"


def _edges(key: str = "doc_id", words: str = _SPACED) -> str:
    """Similarity of every ordered pair of sentences, the diagonal included."""
    return f"""
word AS (
  SELECT {key}, sent_idx, unnest({words}) AS w FROM sent),
inc AS (
  SELECT {key}, sent_idx, w, count(*) AS n FROM word WHERE w <> '' GROUP BY ALL),
len AS (SELECT {key}, sent_idx, ln(sum(n)) AS a FROM inc GROUP BY ALL),
overlap AS (
  SELECT p.{key}, p.sent_idx AS i, q.sent_idx AS j, sum(p.n * q.n) AS same
  FROM inc p JOIN inc q ON p.{key} = q.{key} AND p.w = q.w GROUP BY ALL),
edge AS MATERIALIZED (
  SELECT o.{key}, i, j,
         CASE WHEN x.a + y.a > 0 THEN same / (x.a + y.a) ELSE same * 1.0::DOUBLE END AS sim
  FROM overlap o
  JOIN len x ON x.{key} = o.{key} AND x.sent_idx = i
  JOIN len y ON y.{key} = o.{key} AND y.sent_idx = j
  UNION ALL  -- a sentence without words is alone
  SELECT {key}, sent_idx, sent_idx, 0 FROM sent s
  WHERE NOT EXISTS (SELECT 1 FROM len l WHERE l.{key} = s.{key} AND l.sent_idx = s.sent_idx)),
deg AS MATERIALIZED (SELECT {key}, i, sum(sim) AS degree FROM edge GROUP BY ALL)"""


def _ranks(key: str = "doc_id", steps: int = RANK_STEPS, words: str = _SPACED) -> str:
    """CTE ``rank``: power iteration until a document moves by at most 1e-4."""
    parts = [_edges(key, words), f"""
share AS MATERIALIZED (
  SELECT e.{key}, e.i, e.j, e.sim / (d.degree + 1e-7::DOUBLE) AS p
  FROM edge e JOIN deg d ON d.{key} = e.{key} AND d.i = e.i),
size AS MATERIALIZED (SELECT {key}, count(*) AS n FROM sent GROUP BY ALL),
r0 AS (
  SELECT s.{key}, s.sent_idx, 1.0::DOUBLE / n AS r, TRUE AS going
  FROM sent s JOIN size z ON z.{key} = s.{key})"""]
    for k in range(1, steps + 1):
        parts.append(f"""
n{k} AS MATERIALIZED (
  SELECT s.{key}, s.j AS sent_idx, (1 - 0.85::DOUBLE) / any_value(z.n) + 0.85::DOUBLE * sum(r.r * s.p) AS r
  FROM r{k - 1} r
  JOIN share s ON s.{key} = r.{key} AND s.i = r.sent_idx
  JOIN size z ON z.{key} = r.{key}
  WHERE r.going GROUP BY s.{key}, s.j),
d{k} AS MATERIALIZED (
  SELECT n.{key}, sqrt(sum((n.r - o.r) * (n.r - o.r))) > 1e-4::DOUBLE AS going
  FROM n{k} n JOIN r{k - 1} o ON o.{key} = n.{key} AND o.sent_idx = n.sent_idx GROUP BY ALL),
r{k} AS MATERIALIZED (
  SELECT n.{key}, n.sent_idx, n.r, d.going FROM n{k} n JOIN d{k} d ON d.{key} = n.{key}
  UNION ALL
  SELECT {key}, sent_idx, r, FALSE FROM r{k - 1} WHERE NOT going)""")
    return ",".join(parts)


def _summary(key: str = "doc_id", table: str = "documents", k: int = 4) -> str:
    """CTE ``summ``: the best sentences in order, for documents with any sentence."""
    return f"""
best AS (
  SELECT {key}, sent_idx, row_number() OVER (
    PARTITION BY {key} ORDER BY round(r, 12) DESC, sent_idx) AS rn FROM r{RANK_STEPS}),
summ AS (
  SELECT s.{key}, string_agg(s.sentence, ' ' ORDER BY s.sent_idx) AS summary
  FROM sent s JOIN best b ON b.{key} = s.{key} AND b.sent_idx = s.sent_idx
  WHERE b.rn <= {k} GROUP BY ALL)"""


def _lead(key: str = "doc_id") -> str:
    return f"""
leadin AS (
  SELECT {key}, string_agg(sentence, ' ' ORDER BY sent_idx) AS summary
  FROM sent WHERE sent_idx < 4 GROUP BY ALL)"""


def _slug(x: str) -> str:
    x = f"regexp_replace({x}, '''+', '-', 'g')"
    for sign, ascii_text in SIGNS.items():
        x = f"replace({x}, '{sign}', '{ascii_text}')"
    marked, plain = accents()
    x = f"lower(regexp_replace(translate({x}, '{marked}', '{plain}'), '[‘’‛′]', '', 'g'))"
    for _ in range(2):
        x = f"regexp_replace({x}, '([0-9]),([0-9])', '\\1\\2', 'g')"
    x = f"regexp_replace({x}, '[^a-z0-9]+', '-', 'g')"
    x = f"regexp_replace({x}, '^-|-$', '', 'g')"
    return f"regexp_replace(left({x}, 50), '-$', '')"


# What the letters of SCRIPTS read as, in their order.
_READ = "ga gag han~ mei~ ka ki ya da du vu zh shch iu ia ps th o f s ae bo an xie~ zhu~ tsu 字".split()


def _scripts(readings: str) -> str:
    """Slugs of first sentences in other scripts; ``readings`` replaces phrases of the title ``t``."""
    given = ", ".join(f"'{c}': '{r}'" for c, r in zip(SCRIPTS[1], (x.replace("~", " ") for x in _READ)))
    read = f"array_to_string(list_transform(string_split(t, ''), lambda c: coalesce(map_extract_value(MAP {{{given}}}, c), c)), '')"
    return f"""{_sentences()},
t AS (
  SELECT d.doc_id, translate(lower(coalesce(sentence, '')), '{SCRIPTS[0]}', '{SCRIPTS[1]}') AS t
  FROM documents d LEFT JOIN sent s ON s.doc_id = d.doc_id AND s.sent_idx = 0),
g AS (SELECT doc_id, {readings} AS t FROM t),
r AS (SELECT doc_id, {read} AS t FROM g)
SELECT doc_id, {_slug('t')} AS slug, CAST(length(t) - length(replace(t, '字', '')) AS BIGINT) AS unspelled FROM r"""


def _phrases() -> str:
    longest = sorted((x for x, _ in READINGS), key=len, reverse=True)
    given = ", ".join(f"'{x}': '{r}'" for x, r in READINGS)
    cut = f"regexp_extract_all(t, '(?s){'|'.join(longest)}|.')"
    return f"array_to_string(list_transform({cut}, lambda x: coalesce(map_extract_value(MAP {{{given}}}, x), x)), '')"


_ATTRS = r"""(?:[^>"'']+|"[^"]*"|''[^'']*'')*"""


def _text(fragment: str, sep: str) -> str:
    x = f"""regexp_replace({fragment}, '</?[a-zA-Z]{_ATTRS}>|</?[a-zA-Z][^>]*>|<[!?][^>]*>', chr(1), 'g')"""
    for name, char in (("middot", "·"), ("copy", "©"), ("quot", '"'), ("lt", "<"), ("gt", ">"),
                       ("nbsp", " "), ("amp", "&")):
        x = f"replace({x}, '&{name};', '{char}')"
    nodes = f"list_transform(string_split({x}, chr(1)), lambda t: {_strip('t')})"
    return f"array_to_string(list_filter({nodes}, lambda t: t <> ''), {sep})"


def _articles() -> str:
    """CTE ``art``: pages as articles."""
    hidden = "|".join(rf"<{t}\b[^>]*>.*?(?:</{t}\s*>|\z)" for t in ("script", "style"))
    body = "regexp_extract(page, '(?is)<article\\b[^>]*>(.*?)</article', 1)"
    for t in ("figure", "iframe", "ins"):
        body = f"regexp_replace({body}, '(?is)<{t}\\b[^>]*>.*?</{t}>', chr(1), 'g')"
    head = "regexp_extract(page, '(?is)<h1\\b[^>]*>(.*?)</h1', 1)"
    return f"""
clean AS (
  SELECT page_id, {_id('page_id')} AS article_id,
         regexp_replace(html, '(?is)<!--.*?(?:-->|\\z)|{hidden}', chr(1), 'g') AS page FROM pages),
art AS (
  SELECT page_id, article_id, '{BASE_URL}/' || article_id AS url, {_text(head, "''")} AS title,
         '' AS published_at, {_text(body, "chr(10)")} AS raw_text, 'AI/SW' AS section FROM clean)"""


_TYPED = (
    r"^(yes|Yes|YES|no|No|NO|true|True|TRUE|false|False|FALSE|on|On|ON|off|Off|OFF|~|null|Null|NULL"
    r"|[-+]?0b[0-1_]+|[-+]?0[0-7_]+|[-+]?(0|[1-9][0-9_]*)|[-+]?0x[0-9a-fA-F_]+)$"
)


def _scalar(x: str, in_list: bool = False) -> str:
    marked = r"^[#,\[\]{}&*!|>''\"%@`]|^[?:-](\s|$)|^---|^\.\.\.|:\s|:$|\s#|^\s|\s$|^$"
    need = f"regexp_matches({x}, '{_TYPED}') OR regexp_matches({x}, '{marked}')"
    if in_list:
        need += f" OR regexp_matches({x}, '[,?\\[\\]{{}}:]')"
    return f"CASE WHEN {need} THEN '''' || replace({x}, '''', '''''') || '''' ELSE {x} END"


def _posts(article_cte: str, summary_cte: str, ts: str) -> str:
    """CTE ``post``: path, front matter and body of rendered articles."""
    cats = ", ".join(STYLE.categories)
    return f"""
post AS (
  SELECT a.article_id, a.url, a.title, coalesce(k.keywords, '') AS keywords,
         coalesce(s.summary, '') AS summary,
         strftime({ts}, '%Y-%m-%d') || '-' || coalesce(nullif({_slug('a.title')}, ''), a.article_id) || '.md' AS path,
         CAST({ts} AS DATE) AS post_date, strftime({ts}, '%Y-%m-%d %H:%M:%S') || ' +0900' AS date,
         '---' || chr(10) || 'layout: {STYLE.layout}' || chr(10) || 'title: ' || {_scalar('a.title')} || chr(10)
         || 'date: ' || strftime({ts}, '%Y-%m-%d %H:%M:%S') || ' +0900' || chr(10)
         || 'categories: [{cats}]' || chr(10) || 'tags: ['
         || coalesce(array_to_string(list_transform(k.tags, lambda t: {_scalar('t', True)}), ', '), '') || ']' || chr(10)
         || 'source_url: ' || a.url || chr(10) || 'auto_generated: true' || chr(10) || '---' || chr(10) AS front_matter,
         '## Keywords' || chr(10) || coalesce(k.keywords, '') || chr(10) || chr(10)
         || '## Summary' || chr(10) || coalesce(s.summary, '') || chr(10) || chr(10) || '---' || chr(10)
         || '*This post was automatically generated from [{STYLE.section_name}]({STYLE.section_url}). '
         || '[Read original article →](' || a.url || ')*' || chr(10) AS body
  FROM {article_cte} a LEFT JOIN kw k ON k.article_id = a.article_id
  LEFT JOIN {summary_cte} s ON s.article_id = a.article_id)"""


_ASOF_TS = f"TIMESTAMP '{AS_OF}'"


def _lead_posts() -> str:
    return ",".join([
        _articles(), _terms("art", "article_id", "raw_text"), _sentences("art", "article_id", "raw_text"),
        _lead("article_id"), _posts("art", "leadin", _ASOF_TS),
    ])


_ITEMS = """
items AS (
  SELECT event_id, ts, strftime(ts, '%Y%m%d') || lpad(CAST(event_id AS VARCHAR), 6, '0') AS article_id,
         CASE WHEN event_id % 97 = 0 THEN '' ELSE strftime(ts, '%Y-%m-%d %H:%M') END AS published_at
  FROM events),
parsed AS (SELECT *, try_strptime(published_at, '%Y-%m-%d %H:%M') AS pts FROM items)"""

_LISTING = f"""{_ITEMS},
listing AS (
  SELECT *, CAST((rn - 1) * {LISTING_PAGES} // (SELECT count(*) FROM parsed) AS BIGINT) + 1 AS page
  FROM (SELECT *, row_number() OVER (ORDER BY ts DESC, event_id) AS rn FROM parsed)),
firsts AS (
  SELECT article_id, arg_min(published_at, page * 1000000000 + rn) AS published_at,
         arg_min(pts, page * 1000000000 + rn) AS pts, min(page) AS page, min(rn) AS pos
  FROM listing WHERE length(article_id) = 14 GROUP BY ALL)"""

_PATHS = f"""{_sentences()},
paths AS (
  SELECT {_id('d.doc_id')} AS article_id, '2024-01-31-' || coalesce(
           nullif({_slug("coalesce(s.sentence, '')")}, ''), {_id('d.doc_id')}) || '.md' AS path,
         d.doc_id AS write_seq
  FROM documents d LEFT JOIN sent s ON s.doc_id = d.doc_id AND s.sent_idx = 0)"""

_TAGGED = f"""{_terms()},
tagged AS (
  SELECT d.doc_id, DATE '2024-01-01' + CAST(d.doc_id % 60 AS INTEGER) AS post_date, k.tags
  FROM documents d JOIN kw k ON k.doc_id = d.doc_id)"""


def _search() -> str:
    return f"""WITH {_terms()},
size AS (SELECT count(*) AS n_docs, avg(n_tokens) AS avg_tokens FROM tot),
hits AS (
  SELECT c.doc_id, c.term, c.tf_count AS tf, t.n_tokens FROM cnt c JOIN tot t ON t.doc_id = c.doc_id
  WHERE term IN ({_values(SEARCH_TERMS)})),
freq AS (SELECT term, count(*) AS df FROM hits GROUP BY ALL)
SELECT doc_id, count(*) AS n_matched,
       round(sum(ln(1 + (n_docs - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE
                 / (tf + 1.2::DOUBLE * (1 - 0.75::DOUBLE + 0.75::DOUBLE * n_tokens / avg_tokens))), 6) AS score
FROM hits JOIN freq USING (term), size GROUP BY doc_id ORDER BY score DESC, doc_id LIMIT 20"""


def oracle_sql() -> dict[str, str]:
    terms, sents = _terms(), _sentences()
    return {
        "keywords_topn": f"""WITH {terms}
SELECT t.doc_id, rn, term, tf_count,
       round(tf_count / n_tokens * (1 + (tf_count - 1) * 0.15::DOUBLE), 9) AS score
FROM top t JOIN tot n ON n.doc_id = t.doc_id""",
        "keyword_lists": f"""WITH {terms}
SELECT d.doc_id, coalesce(keywords, '') AS keywords FROM documents d LEFT JOIN kw k ON k.doc_id = d.doc_id""",
        "term_counts": f"""WITH {terms}
SELECT c.doc_id, term, tf_count, n_tokens FROM cnt c JOIN tot t ON t.doc_id = c.doc_id""",
        "document_frequency": f"WITH {terms} SELECT term, count(*) AS df FROM cnt GROUP BY ALL",
        "tfidf_topn": f"""WITH {terms},
freq AS (SELECT term, count(*) AS df FROM cnt GROUP BY ALL),
w AS (
  SELECT doc_id, term, tf_count, df,
         tf_count * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS weight
  FROM cnt JOIN freq USING (term)),
s AS (SELECT *, weight / sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)) AS score FROM w),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, term) AS rn FROM s)
SELECT doc_id, rn, term, tf_count, df, round(score, 6) AS score FROM r WHERE rn <= 7""",
        "stopword_anti": f"""WITH stop AS (
  SELECT unnest([{_values((*STOP_TABLE, *STOPWORDS))}]) AS term),
tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS term FROM documents)
SELECT doc_id, count(*) AS n_kept, count(DISTINCT term) AS n_terms FROM tok t
WHERE length(term) > 1 AND NOT EXISTS (SELECT 1 FROM stop s WHERE s.term = t.term) GROUP BY ALL""",
        "embedding_rank": """WITH c AS (
  SELECT label, vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS dim FROM embeddings),
m AS (SELECT label, dim, avg(v) AS m FROM c GROUP BY ALL),
s AS (
  SELECT c.label, c.vec_id, sum(v * m) / (sqrt(sum(v * v)) * sqrt(sum(m * m))) AS score
  FROM c JOIN m ON m.label = c.label AND m.dim = c.dim GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY round(score, 6) DESC NULLS LAST, vec_id) AS rn FROM s)
SELECT label, rn, vec_id, round(score, 4) AS score FROM r WHERE rn <= 7""",
        "sentences": f"WITH {sents} SELECT doc_id, sent_idx, sentence FROM sent",
        "lead_summary": f"""WITH {sents}, {_lead()}
SELECT d.doc_id, coalesce(summary, '') AS summary FROM documents d LEFT JOIN leadin s ON s.doc_id = d.doc_id""",
        "textrank_degrees": f"""WITH {sents}, {_edges()}
SELECT doc_id, i AS sent_idx, round(degree, 6) AS degree FROM deg""",
        "textrank_ranks": f"""WITH {sents}, {_ranks()}
SELECT doc_id, sent_idx, round(r, 8) AS rank FROM r{RANK_STEPS}""",
        "textrank_summary": f"""WITH {sents}, {_ranks()}, {_summary()}
SELECT d.doc_id, coalesce(summary, '') AS summary FROM documents d LEFT JOIN summ s ON s.doc_id = d.doc_id""",
        "textrank_line_degrees": f"""WITH {_sentences(lines=True)}, {_edges(words=_TOKENS)}
SELECT doc_id, i AS sent_idx, round(degree, 6) AS degree FROM deg""",
        "textrank_line_summary": f"""WITH {_sentences(lines=True)}, {_ranks(words=_TOKENS)}, {_summary()}
SELECT d.doc_id, coalesce(summary, '') AS summary FROM documents d LEFT JOIN summ s ON s.doc_id = d.doc_id""",
        "isolated_keywords": f"""WITH able AS (
  SELECT doc_id, unnest(l) AS term, generate_subscripts(l, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, '[a-z]+') AS l FROM documents WHERE contains(text, '.'))),
c AS (
  SELECT doc_id, term, count(*) AS n, min(pos) AS pos FROM able
  WHERE length(term) > 1 AND term NOT IN ({_values(STOPWORDS)}) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, pos) AS rn FROM c),
k AS (SELECT doc_id, string_agg(term, ', ' ORDER BY rn) AS keywords FROM r WHERE rn <= 7 GROUP BY ALL)
SELECT d.doc_id, coalesce(keywords, '') AS keywords,
       CASE WHEN NOT contains(text, '.') THEN 'tokenizer: ValueError: no sentence' END AS error
FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id""",
        "isolated_split": """WITH s AS (
  SELECT doc_id, list_filter(string_split(text, '.'), lambda t: t <> '') AS l, contains(text, '#') AS bad FROM documents)
SELECT doc_id, CASE WHEN bad THEN '' ELSE array_to_string(list_transform(l[1:2], lambda t: t || '.'), ' ') END AS summary,
       CASE WHEN bad THEN 'splitter: ValueError: sign' END AS error FROM s""",
        "isolated_run": f"""WITH {_articles()},
new AS (SELECT * FROM art WHERE page_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)),
f AS (SELECT length(raw_text) % 5 = 0 AS failed FROM new)
SELECT count(*) AS candidates, count(*) FILTER (NOT failed) AS processed, count(*) FILTER (failed) AS failed,
       CAST(0 AS BIGINT) AS missing, CAST(20 AS BIGINT) AS last_page, CAST(NULL AS BIGINT) AS cut_page, FALSE AS cap_hit FROM f""",
        "extraction_results": f"""WITH {terms}, {sents}, {_ranks()}, {_summary()}
SELECT d.doc_id, coalesce(keywords, '') AS keywords, coalesce(summary, '') AS summary, 'tf+textrank' AS method
FROM documents d LEFT JOIN kw k ON k.doc_id = d.doc_id LEFT JOIN summ s ON s.doc_id = d.doc_id""",
        "read_time": f"""SELECT doc_id, greatest(1, CAST(ceil(
  len(list_filter(string_split_regex(coalesce(text, ''), '{WS}+'), lambda w: w <> '')) / 200.0::DOUBLE) AS BIGINT)) AS minutes,
  length(text) AS n_chars FROM documents""",
        "html_article": f"""WITH {_articles()}
SELECT article_id, url, title, published_at, raw_text, section FROM art""",
        "html_published": f"""SELECT {_id('page_id')} AS article_id, CASE WHEN page_id % 7 = 0 THEN '' ELSE
  '2024-01-1' || (page_id % 10) || ' 09:' || lpad(CAST(page_id % 60 AS VARCHAR), 2, '0') END AS published_at FROM pages""",
        "discover_gap": f"""WITH {_LISTING}
SELECT article_id, page, pos, published_at FROM firsts WHERE page < 10""",
        "url_params": f"""SELECT page_id,
  nullif(regexp_extract(url, '^[^#]*[?&]page=([^&#]*)', 1), '') AS page_param,
  nullif(regexp_extract(url, '^[^#]*[?&]utm_source=([^&#]*)', 1), '') AS utm_source,
  {_id('page_id')} AS article_id, left({_id('page_id')}, 8) AS id_date, substr({_id('page_id')}, 9, 6) AS id_serial
FROM pages""",
        "post_dates": f"""WITH {_ITEMS}
SELECT event_id, strftime(coalesce(pts, {_ASOF_TS}), '%Y-%m-%d') AS file_date,
  strftime(coalesce(pts, {_ASOF_TS}), '%Y-%m-%d %H:%M:%S') || ' +0900' AS post_date,
  strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%S.%f') || '+09:00' AS stamp FROM parsed""",
        "lookback_filter": f"""WITH {_ITEMS}
SELECT article_id, published_at FROM parsed WHERE pts IS NULL OR pts >= {_ASOF_TS} - INTERVAL 7 DAY""",
        "discover_pages": f"""WITH {_LISTING}
SELECT article_id, page, pos, published_at FROM firsts
WHERE page <= coalesce((SELECT min(page) FROM firsts WHERE pts < {_ASOF_TS} - INTERVAL 14 DAY), 1000000)""",
        "discovery_report": f"""WITH {_LISTING},
cut AS (SELECT min(page) AS cut_page FROM firsts WHERE page <= 20 AND pts < {_ASOF_TS} - INTERVAL 60 DAY)
SELECT least((SELECT max(page) FROM firsts WHERE page <= 20), coalesce(cut_page, 20)) AS last_page, cut_page,
       cut_page IS NULL AND (SELECT max(page) FROM firsts WHERE page <= 20) = 20 AS cap_hit FROM cut""",
        "run_report": f"""WITH {_LISTING}
SELECT (SELECT max(page) FROM firsts) AS last_page,
       (SELECT min(page) FROM firsts WHERE pts < {_ASOF_TS} - INTERVAL 60 DAY) AS cut_page, FALSE AS cap_hit""",
        "listing_scan": f"WITH {_LISTING} SELECT article_id, published_at, page, rn AS pos FROM listing",
        "unprocessed_anti": f"""SELECT {_id('doc_id')} AS article_id, source FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
        "state_merge": f"""SELECT article_id, min(processed_at) AS processed_at FROM (
  SELECT {_id('doc_id')} AS article_id, '2024-01-30T00:00:00.000000+09:00' AS processed_at FROM labels
  UNION ALL
  SELECT {_id('doc_id')}, '2024-01-31T00:00:00.000000+09:00' FROM documents) GROUP BY ALL""",
        "state_audit": f"""SELECT {_id('coalesce(d.doc_id, l.doc_id)')} AS article_id,
  d.doc_id IS NOT NULL AS in_state, l.doc_id IS NOT NULL AS in_posts
FROM (SELECT DISTINCT doc_id FROM documents) d FULL JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = d.doc_id""",
        "state_json": f"""SELECT DISTINCT {_id('doc_id')} AS article_id,
  '2024-01-31T00:00:00.000000+09:00' AS processed_at FROM documents""",
        "run_counters": f"""WITH e AS (
  SELECT text IS NULL OR {_strip('text')} = '' OR NOT contains(text, '.') AS bad FROM documents)
SELECT count(*) AS candidates, count(*) FILTER (NOT bad) AS processed, count(*) FILTER (bad) AS failed FROM e""",
        "missing_pages": f"""SELECT {_id('doc_id')} AS article_id FROM documents
WHERE doc_id NOT IN (SELECT page_id FROM pages)""",
        "slug_title": f"""WITH {sents}
SELECT d.doc_id, {_slug("coalesce(s.sentence, '')")} AS slug
FROM documents d LEFT JOIN sent s ON s.doc_id = d.doc_id AND s.sent_idx = 0""",
        "slug_scripts": f"WITH {_scripts('t')}",
        "slug_readings": f"WITH {_scripts(_phrases())}",
        "front_matter": f"WITH {_lead_posts()} SELECT article_id, path, front_matter FROM post",
        "post_body": f"WITH {_lead_posts()} SELECT article_id, post_date, body FROM post",
        "post_scan": f"""WITH {_lead_posts()}
SELECT path, '{STYLE.layout}' AS layout, title, date, '{", ".join(STYLE.categories)}' AS categories,
  keywords AS tags, url AS source_url, TRUE AS auto_generated, keywords AS keyword_line, summary, article_id
FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY article_id DESC) AS w FROM post) WHERE w = 1""",
        "digest_post": f"""WITH {_lead_posts()}
SELECT post_date, strftime(post_date, '%Y-%m-%d') || '-daily-digest.md' AS path, CAST(0 AS BIGINT) AS entry_no,
  '---' || chr(10) || 'layout: {STYLE.layout}' || chr(10) || 'title: Daily digest ' || strftime(post_date, '%Y-%m-%d') || chr(10)
  || 'date: ' || strftime(post_date, '%Y-%m-%d') || ' 00:00:00 +0900' || chr(10) || 'categories: [{", ".join(STYLE.categories)}]' || chr(10)
  || 'tags: [daily-digest]' || chr(10) || 'auto_generated: true' || chr(10) || '---' || chr(10) || chr(10) || count(*) || ' articles' AS value
FROM post GROUP BY post_date
UNION ALL
SELECT post_date, strftime(post_date, '%Y-%m-%d') || '-daily-digest.md',
  row_number() OVER (PARTITION BY post_date ORDER BY article_id),
  chr(10) || '## [' || title || '](' || url || ')' || chr(10) || keywords || chr(10) || chr(10) || summary FROM post""",
        "store_runs": f"""WITH {_articles()}
SELECT article_id, title, 'r' || CAST(page_id % 3 AS VARCHAR) AS run_id, '2024-01-31T00:00:00.000000+09:00' AS processed_at
FROM art WHERE page_id % 3 <> 2""",
        "post_invariants": f"""WITH {_lead_posts()}
SELECT count(*) AS n_posts, CAST(0 AS BIGINT) AS tags_differ,
  count(*) FILTER (left(path, 10) <> left(date, 10)) AS dates_differ,
  count(*) FILTER (substr(date, 18, 2) <> '00') AS seconds_set,
  count(*) FILTER (len(list_filter(string_split(keywords, ', '), lambda t: length(t) = 1)) > 0) AS short_tags,
  count(*) FILTER (keywords = '') AS untagged,
  count(*) FILTER (len(string_split(keywords, ', ')) > 7) AS overtagged FROM post""",
        "path_last_write": f"""WITH {_PATHS}
SELECT arg_max(article_id, write_seq) AS article_id, path, max(write_seq) AS write_seq FROM paths GROUP BY path""",
        "path_collisions": f"""WITH {_PATHS}
SELECT path, count(*) AS n_articles, min(article_id) AS first_id, max(article_id) AS last_id
FROM paths GROUP BY path HAVING count(*) > 1""",
        "path_suffix": f"""WITH {_PATHS}
SELECT article_id, write_seq, CASE WHEN write_seq = min(write_seq) OVER (PARTITION BY path) THEN path
  ELSE left(path, length(path) - 3) || '--' || article_id || '.md' END AS path FROM paths""",
        "daily_posts": f"""WITH {_articles()},
new AS (SELECT * FROM art WHERE page_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)),
{_terms("new", "article_id", "raw_text")}, {_sentences("new", "article_id", "raw_text")},
{_ranks("article_id")}, {_summary("article_id", "new")},
{_posts("new", "summ", "TIMESTAMP '2024-01-30 09:00:00'").replace("2024-01-30 09:00:00", AS_OF)}
SELECT article_id, path, post_date, front_matter || chr(10) || body AS content, 'tf+textrank' AS method FROM post""",
        "tag_counts": f"""WITH {_TAGGED}
SELECT tag, count(*) AS n_posts FROM (SELECT unnest(tags) AS tag FROM tagged) GROUP BY ALL""",
        "category_counts": """SELECT tag, count(*) AS n_posts FROM (
  SELECT lang AS tag FROM documents UNION ALL SELECT source FROM documents) GROUP BY ALL""",
        "keyword_trend": f"""WITH {_TAGGED},
c AS (SELECT post_date, tag, count(*) AS n_posts FROM (SELECT post_date, unnest(tags) AS tag FROM tagged) GROUP BY ALL)
SELECT * FROM (
  SELECT post_date, tag, n_posts, row_number() OVER (PARTITION BY post_date ORDER BY n_posts DESC, tag) AS rn FROM c)
WHERE rn <= 5""",
        "archive_counts": """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n_posts
FROM orders GROUP BY ALL""",
        "daily_digest": """SELECT CAST(ts AS DATE) AS post_date,
  row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts DESC, event_id) AS entry_no, event_id,
  '- ' || strftime(ts, '%H:%M') || ' ' || event_type AS line FROM events""",
        "digest_headers": """SELECT CAST(ts AS DATE) AS post_date, count(*) AS n_entries,
  min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY ALL""",
        "paginate": """SELECT event_id, position, CAST((position + 9) // 10 AS BIGINT) AS page FROM (
  SELECT event_id, row_number() OVER (ORDER BY ts DESC, event_id) AS position FROM events)""",
        "feed_latest": "SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id LIMIT 20",
        "search_index": f"""WITH {terms}
SELECT term, c.doc_id, tf_count AS tf, n_tokens FROM cnt c JOIN tot t ON t.doc_id = c.doc_id""",
        "search_topk": _search(),
        "search_segments": _search(),
        "tfidf_stored": f"""WITH {terms},
freq AS (SELECT term, count(*) AS n FROM cnt WHERE doc_id % 3 <> 1 GROUP BY ALL),
w AS (
  SELECT doc_id, term, tf_count, coalesce(n, 0) + 1 AS df,
         tf_count * (ln((2 + (SELECT count(*) FROM documents WHERE doc_id % 3 <> 1)) / (2 + coalesce(n, 0))) + 1) AS weight
  FROM cnt LEFT JOIN freq USING (term) WHERE doc_id % 3 = 1),
s AS (SELECT *, weight / sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)) AS score FROM w),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, term) AS rn FROM s)
SELECT doc_id, rn, term, tf_count, df, round(score, 6) AS score FROM r WHERE rn <= 7""",
        "related_docs": f"""WITH {_TAGGED},
x AS (SELECT doc_id, unnest(tags) AS tag FROM tagged),
p AS (
  SELECT a.doc_id, b.doc_id AS related_id, count(*) AS overlap
  FROM x a JOIN x b ON a.tag = b.tag AND a.doc_id <> b.doc_id GROUP BY ALL)
SELECT * FROM (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY overlap DESC, related_id) AS rn, related_id, overlap
  FROM p) WHERE rn <= 4""",
        "related_forty": f"""WITH {_terms(k=40)},
p AS (
  SELECT a.doc_id, b.doc_id AS related_id, count(*) AS overlap
  FROM top a JOIN top b ON a.term = b.term AND a.doc_id <> b.doc_id GROUP BY ALL)
SELECT * FROM (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY overlap DESC, related_id) AS rn, related_id, overlap
  FROM p) WHERE rn <= 4""",
        "incremental_stream": f"""WITH {_ITEMS},
f AS (SELECT CAST(e.user_id AS VARCHAR) AS user, p.event_id, p.published_at, p.pts,
        row_number() OVER (PARTITION BY e.user_id ORDER BY p.ts, p.event_id) AS n
      FROM parsed p JOIN events e ON e.event_id = p.event_id)
SELECT user, event_id, published_at FROM f
WHERE n = 1 AND (pts IS NULL OR pts >= {_ASOF_TS} - INTERVAL 30 DAY)""",
        "daily_counts_stream": """SELECT * FROM (
  SELECT CAST(ts AS DATE) AS post_date, count(*) AS n_entries FROM events GROUP BY CAST(ts AS DATE))
WHERE post_date + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 7 DAY""",
        "stream_job": f"""WITH {_lead_posts()}
SELECT article_id, path, post_date, front_matter || chr(10) || body AS content, 'tf+lead' AS method FROM post""",
        "dedup_stream": "SELECT DISTINCT CAST(user_id AS VARCHAR) AS article_id FROM events",
    }
