"""DuckDB twins of the registered queries (the correctness oracle).

Each SQL string runs on DuckDB with the driver's tables as views.  The SQL
restates the semantics independently (recursive CTEs for the greedy folds,
window functions for ranks); only the fixed values (patterns, word lists,
templates) are shared with the Spark side.
"""

from __future__ import annotations

from folio.functions.text import EMAIL_PATTERN, FILE_KEY_DEFAULT, FILE_KEY_INVALID, STOP_WORDS, TOKEN_PATTERN, WS
from folio.functions.urls import ARTICLE_EXCLUDE, TRACKING_PARAMS
from folio.operators.enrich import FAILED, FAILED_PART, NO_SUMMARY, PROMPT_TEMPLATE
from folio.operators.routing import (DAVINCI_CODE, DAVINCI_TEXT, DEFAULT_LIMIT, MODEL_LIMITS, MODEL_RULES)
from folio.plans import catalog as C
from folio.plans.derived import RUN_START


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


NL2 = "chr(10) || chr(10)"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {lit(rf'\A[{WS}]+|[{WS}]+\z')}, '', 'g')"


def tokens(x: str) -> str:
    return f"CAST(coalesce(len(regexp_extract_all({x}, {lit(TOKEN_PATTERN)})), 0) AS INTEGER)"


def words(x: str) -> str:
    return f"regexp_extract_all({x}, {lit(rf'[^{WS}]+')})"


def word_count(x: str) -> str:
    return f"CAST(coalesce(len({words(x)}), 0) AS INTEGER)"


# ------------------------------------------------------------------ URLs
_SPLIT = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?$"


def prep(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '[\\t\\r\\n]', '', 'g'), '^[\\x00-\\x20]+', '')"


def part(x: str, i: int) -> str:
    return f"regexp_extract({prep(x)}, {lit(_SPLIT)}, {i})"


def scheme(x): return f"lower({part(x, 1)})"
def netloc(x): return part(x, 3)
def has_netloc(x): return f"({part(x, 2)} <> '')"
def path(x): return part(x, 4)
def query(x): return part(x, 6)
def has_query(x): return f"({part(x, 5)} <> '')"
def fragment(x): return part(x, 8)


def strict_valid(x: str) -> str:
    return f"coalesce(regexp_matches({prep(x)}, '^[Hh][Tt][Tt][Pp][Ss]?://[^/?#]'), false)"


def prefix_valid(x: str) -> str:
    return f"coalesce(starts_with({x}, 'http://') OR starts_with({x}, 'https://'), false)"


def normalize(x: str) -> str:
    track = "[" + ", ".join(lit(t) for t in TRACKING_PARAMS) + "]"
    kept = (f"array_to_string(list_filter(string_split({query(x)}, '&'), lambda p: contains(p, '=') AND "
            f"NOT list_contains({track}, lower(split_part(p, '=', 1)))), '&')")
    base = f"{scheme(x)} || '://' || {netloc(x)} || regexp_replace({path(x)}, ';[^/]*$', '')"
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {has_query(x)} AND {kept} <> '' "
            f"THEN {base} || '?' || {kept} ELSE {base} END")


def _dots(segs: str) -> str:
    red = (f"list_reduce({segs}, lambda acc, s: CASE WHEN s = '..' THEN acc[1:len(acc) - 1] "
           f"WHEN s = '.' THEN acc ELSE list_append(acc, s) END, []::VARCHAR[])")
    tail = f"({segs})[len({segs})] IN ('.', '..')"
    resolved = f"CASE WHEN {tail} THEN list_append({red}, '') ELSE {red} END"
    joined = f"array_to_string({resolved}, '/')"
    joined = f"CASE WHEN {joined} = '' THEN '/' ELSE {joined} END"
    return f"CASE WHEN left({joined}, 1) <> '/' THEN '/' || {joined} ELSE {joined} END"


def resolve(base: str, href: str) -> str:
    q = lambda v: f"CASE WHEN {v} <> '' THEN '?' || {v} ELSE '' END"
    f = lambda v: f"CASE WHEN {v} <> '' THEN '#' || {v} ELSE '' END"
    hp, hq, hf = path(href), query(href), fragment(href)
    bp, bq, bf = path(base), query(base), fragment(base)
    prefix = f"{scheme(base)} || '://' || {netloc(base)}"
    bsegs = f"string_split({bp}, '/')"
    bdir = f"CASE WHEN ({bsegs})[len({bsegs})] <> '' THEN ({bsegs})[1:len({bsegs}) - 1] ELSE {bsegs} END"
    rel_all = f"list_concat({bdir}, string_split({hp}, '/'))"
    rel = (f"CASE WHEN len({rel_all}) > 2 THEN list_concat(list_concat(({rel_all})[1:1], "
           f"list_filter(({rel_all})[2:len({rel_all}) - 1], lambda s: s <> '')), ({rel_all})[len({rel_all}):len({rel_all})]) "
           f"ELSE {rel_all} END")
    h_scheme = f"lower(regexp_extract({prep(href)}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1))"
    eff = f"CASE WHEN {h_scheme} <> '' THEN {h_scheme} ELSE {scheme(base)} END"
    ep_q = f"CASE WHEN {hq} <> '' THEN {hq} ELSE {bq} END"
    ep_f = f"CASE WHEN {hq} <> '' OR {hf} <> '' THEN {hf} ELSE {bf} END"
    return (
        f"CASE WHEN {href} IS NULL OR {href} = '' THEN {base} "
        f"WHEN {h_scheme} <> '' AND {h_scheme} <> {scheme(base)} THEN {href} "
        f"WHEN {has_netloc(href)} THEN {eff} || '://' || {netloc(href)} || {hp} || {q(hq)} || {f(hf)} "
        f"WHEN {hp} = '' THEN {prefix} || {bp} || {q(ep_q)} || {f(ep_f)} "
        f"WHEN starts_with({hp}, '/') THEN {prefix} || {_dots(f"string_split({hp}, '/')")} || {q(hq)} || {f(hf)} "
        f"ELSE {prefix} || {_dots(rel)} || {q(hq)} || {f(hf)} END"
    )


def is_article(x: str) -> str:
    p = f"lower({path(x)})"
    excl = " OR ".join(f"contains({p}, {lit(e)})" for e in ARTICLE_EXCLUDE)
    return (f"(NOT ({excl}) AND (regexp_matches({p}, '/[0-9]{{4}}/[0-9]{{2}}/') OR contains({p}, '/story/') "
            f"OR contains({p}, '/article/') OR contains({p}, '/news/')))")


# ------------------------------------------------------------------ HTML
def unescape(x: str) -> str:
    out = x
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        out = f"replace({out}, {lit(ent)}, {lit(ch)})"
    return out


def strip_tags(x: str) -> str:
    return f"regexp_replace({x}, '<[^>]*>', '', 'g')"


# the oracle's own patterns: no possessive parts, attributes are cut out of the tag step by step
TITLE_SQL = r"(?is)<title(?:\s[^>]*)?>(.*?)</title>"
ARTICLE_SQL = r"(?is)<article(?:\s[^>]*)?>(.*?)</article>"
ATTR_SQL = r"""\s[^\s=>"'/]+\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""


def opening(tag: str) -> str:
    return lit(rf"""(?i)<{tag}\s(?:"[^"]*"|'[^']*'|[^>"'])*>""")


def attribute(tag: str, name: str) -> str:
    first = f"(list_filter(regexp_extract_all({tag}, {lit(ATTR_SQL)}), lambda a: regexp_matches(a, {lit(rf'(?i)^\s{name}\s*=')})))[1]"
    value = f"regexp_replace({first}, {lit(r'^[^=]*=\s*')}, '')"
    quoted = f"substr({value}, 1, 1) IN ('\"', chr(39))"
    return f"CASE WHEN {quoted} THEN substr({value}, 2, length({value}) - 2) ELSE {value} END"


def html_title(h: str) -> str:
    return unescape(strip_tags(f"regexp_extract({h}, {lit(TITLE_SQL)}, 1)"))


def html_text(h: str) -> str:
    inner = f"CASE WHEN regexp_matches({h}, {lit(ARTICLE_SQL)}) THEN regexp_extract({h}, {lit(ARTICLE_SQL)}, 1) ELSE {h} END"
    segs = f"regexp_split_to_array({inner}, {lit('(?i)<p(?:[ \\t\\r\\n\\f][^>]*)?>')})"
    piece = strip(unescape(strip_tags("regexp_replace(s, '(?is)</p\\s*>.*', '')")))
    cleaned = f"list_transform(({segs})[2:], lambda s: {piece})"
    return f"array_to_string(list_filter({cleaned}, lambda s: s <> ''), {NL2})"


def _meta(h: str, attr: str, name: str) -> str:
    tags = f"list_filter(regexp_extract_all({h}, {opening('meta')}), lambda t: lower({attribute('t', attr)}) = {lit(name)})"
    return f"list_filter(list_transform({tags}, lambda t: {attribute('t', 'content')}), lambda c: c IS NOT NULL)"


def html_authors(h):
    return f"list_filter(list_transform({_meta(h, 'name', 'author')}, lambda s: {strip(unescape('s'))}), lambda s: s <> '')"


def html_keywords(h):
    first = f"coalesce(({_meta(h, 'name', 'keywords')})[1], '')"
    return f"list_filter(list_transform(string_split({first}, ','), lambda s: {strip(unescape('s'))}), lambda s: s <> '')"


def html_description(h):
    first = f"({_meta(h, 'name', 'description')})[1]"
    return f"coalesce({strip(unescape(first))}, '')"


def html_image(h):
    first = f"({_meta(h, 'property', 'og:image')})[1]"
    return f"nullif(coalesce({unescape(first)}, ''), '')"


def hrefs(h: str) -> str:
    every = f"list_transform(regexp_extract_all({h}, {opening('a')}), lambda t: {attribute('t', 'href')})"
    return f"list_filter({every}, lambda x: x IS NOT NULL)"


# ------------------------------------------------------------------ shared CTEs
def ts_iso(t: str) -> str:
    return (f"CASE WHEN {t} IS NULL THEN NULL WHEN strftime({t}, '%f') <> '000000' "
            f"THEN strftime({t}, '%Y-%m-%dT%H:%M:%S') || '.' || strftime({t}, '%f') "
            f"ELSE strftime({t}, '%Y-%m-%dT%H:%M:%S') END")


def run_ts(k: str) -> str:
    return f"(TIMESTAMP {lit(RUN_START)} + to_microseconds(CAST({k} AS BIGINT) * 1500000))"


LINES = f"""lines AS (
  SELECT page_id * 6 + v AS line_no,
    CASE v WHEN 0 THEN url WHEN 1 THEN '  ' || url WHEN 2 THEN url || ' ' || chr(9)
           WHEN 3 THEN 'HTTP' || substr(url, 5) WHEN 4 THEN 'http:///p' || CAST(page_id AS VARCHAR)
           ELSE '# ' || url END AS value
  FROM (SELECT page_id, url, unnest(range(6)) AS v FROM pages))"""

FIELDS = f"""fields AS (
  SELECT page_id, url, {html_title('html')} AS raw_title, {html_text('html')} AS raw_text,
         {html_authors('html')} AS authors, {html_image('html')} AS top_image,
         {html_description('html')} AS meta_description, {html_keywords('html')} AS meta_keywords
  FROM pages)"""

PAGE_ARTICLES = f"""fetch_fields AS (
  SELECT page_id, {strip('url')} AS url, {html_title('html')} AS raw_title, {html_text('html')} AS raw_text,
         {html_authors('html')} AS authors, {html_image('html')} AS top_image,
         {html_description('html')} AS meta_description, {html_keywords('html')} AS meta_keywords
  FROM pages WHERE {prefix_valid('url')}),
page_articles AS (
  SELECT page_id, sha256(url) AS id, url, {strip('raw_title')} AS title, {strip('raw_text')} AS content,
         authors, top_image, meta_description, meta_keywords, {netloc('url')} AS source_domain,
         {word_count(strip('raw_text'))} AS word_count, {run_ts('page_id')} AS scraped_at
  FROM fetch_fields WHERE raw_title <> '' AND raw_text <> '')"""

DOC_URL = "'https://' || source || '.example.com/' || lang || '/news/' || CAST(doc_id AS VARCHAR)"
DOC_ARTICLES = f"""doc_articles AS (
  SELECT doc_id, lang, source, sha256({DOC_URL}) AS id, {DOC_URL} AS url,
         {strip("split_part(text, chr(10), 1)")} AS title, {strip('text')} AS content,
         source || '.example.com' AS source_domain,
         {word_count(strip('text'))} AS word_count, {run_ts('doc_id')} AS scraped_at
  FROM documents WHERE split_part(text, chr(10), 1) <> '' AND text <> '')"""


def sentence_walk(src: str, key: str, text: str, budget: str, prefix: str) -> str:
    """CTEs <prefix>units/<prefix>walk/<prefix>chunks for the sentence chunker over table ``src``."""
    return f"""{prefix}s0 AS (SELECT {key} AS k, {budget} AS budget, u.raw, u.sidx FROM {src},
     unnest(string_split(replace({text}, chr(10), ' '), '. ')) WITH ORDINALITY AS u(raw, sidx)),
{prefix}s1 AS (SELECT k, budget, sidx, {strip('raw')} AS s FROM {prefix}s0),
{prefix}s2 AS (SELECT k, budget, sidx, CASE WHEN ends_with(s, '.') THEN s ELSE s || '.' END AS s FROM {prefix}s1 WHERE s <> ''),
{prefix}s3 AS (SELECT *, {tokens('s')} AS tok FROM {prefix}s2),
{prefix}u0 AS (
  SELECT k, budget, sidx, 0 AS widx, s AS txt, tok, 0 AS grp FROM {prefix}s3 WHERE tok <= budget
  UNION ALL
  SELECT x.k, x.budget, x.sidx, w.widx, w.txt, {tokens('w.txt')} AS tok, x.sidx AS grp
  FROM (SELECT * FROM {prefix}s3 WHERE tok > budget) x, unnest({words('x.s')}) WITH ORDINALITY AS w(txt, widx)),
{prefix}units AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY sidx, widx) AS i FROM {prefix}u0),
{prefix}walk(k, i, chunk, total, grp) AS (
  SELECT k, i, 0, tok, grp FROM {prefix}units WHERE i = 1
  UNION ALL
  SELECT u.k, u.i,
    w.chunk + CASE WHEN u.grp <> w.grp OR w.total + u.tok > u.budget THEN 1 ELSE 0 END,
    CASE WHEN u.grp <> w.grp OR w.total + u.tok > u.budget THEN u.tok ELSE w.total + u.tok END,
    u.grp
  FROM {prefix}walk w JOIN {prefix}units u ON u.k = w.k AND u.i = w.i + 1),
{prefix}chunks AS (
  SELECT w.k, CAST(w.chunk AS INTEGER) AS chunk_index, string_agg(u.txt, ' ' ORDER BY u.i) AS chunk
  FROM {prefix}walk w JOIN {prefix}units u ON u.k = w.k AND u.i = w.i GROUP BY w.k, w.chunk
  UNION ALL
  SELECT {key}, 0, substr({text}, 1, {budget}) FROM {src}
  WHERE {key} NOT IN (SELECT k FROM {prefix}units))"""


def paragraph_walk(src: str, key: str, text: str, limit: str, prefix: str) -> str:
    """CTEs for the paragraph chunker; final CTE <prefix>pchunks(k, chunk_index, chunk)."""
    return f"""{prefix}p0 AS (SELECT {key} AS k, {limit} AS lim, p.ptxt, p.pidx FROM {src},
     unnest(string_split({text}, {NL2})) WITH ORDINALITY AS p(ptxt, pidx)),
{prefix}p1 AS (SELECT *, {tokens('ptxt')} AS ptok FROM {prefix}p0),
{prefix}pu0 AS (
  SELECT k, lim, pidx, 0 AS sidx, ptxt AS txt, ptok AS tok, 0 AS kind, {NL2} AS sep FROM {prefix}p1 WHERE ptok <= lim
  UNION ALL
  SELECT x.k, x.lim, x.pidx, s.sidx, s.stxt, {tokens('s.stxt')}, CASE WHEN s.sidx = 1 THEN 1 ELSE 2 END, '. '
  FROM (SELECT * FROM {prefix}p1 WHERE ptok > lim) x, unnest(string_split(x.ptxt, '. ')) WITH ORDINALITY AS s(stxt, sidx)),
{prefix}pu AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY pidx, sidx) AS i FROM {prefix}pu0),
{prefix}pw(k, i, chunk, total, nonempty) AS (
  SELECT k, i, 0, tok, txt <> '' FROM {prefix}pu WHERE i = 1
  UNION ALL
  SELECT u.k, u.i,
    w.chunk + CASE WHEN u.kind = 1 OR w.total + u.tok + CASE WHEN u.kind = 2 AND w.nonempty THEN 1 ELSE 0 END > u.lim THEN 1 ELSE 0 END,
    CASE WHEN u.kind = 1 OR w.total + u.tok + CASE WHEN u.kind = 2 AND w.nonempty THEN 1 ELSE 0 END > u.lim THEN u.tok
         ELSE w.total + u.tok + CASE WHEN u.kind = 2 AND w.nonempty THEN 1 ELSE 0 END END,
    CASE WHEN u.kind = 1 OR w.total + u.tok + CASE WHEN u.kind = 2 AND w.nonempty THEN 1 ELSE 0 END > u.lim THEN u.txt <> ''
         ELSE w.nonempty OR u.txt <> '' END
  FROM {prefix}pw w JOIN {prefix}pu u ON u.k = w.k AND u.i = w.i + 1),
{prefix}pj AS (
  SELECT w.k, w.chunk, u.i, u.txt, u.sep,
         min(CASE WHEN u.txt <> '' THEN u.i END) OVER (PARTITION BY w.k, w.chunk) AS fne
  FROM {prefix}pw w JOIN {prefix}pu u ON u.k = w.k AND u.i = w.i),
{prefix}pc AS (
  SELECT k, chunk, string_agg(CASE WHEN fne IS NOT NULL AND i > fne THEN sep ELSE '' END || txt, '' ORDER BY i) AS chunk_text
  FROM {prefix}pj GROUP BY k, chunk),
{prefix}pchunks AS (
  SELECT k, CAST(row_number() OVER (PARTITION BY k ORDER BY chunk) - 1 AS INTEGER) AS chunk_index, chunk_text AS chunk
  FROM {prefix}pc WHERE chunk_text <> '')"""


def records(arts: str, max_tokens: int, prefix: str = "r_") -> str:
    """CTEs ending in <prefix>records(id, article_id, chunk_index, total_chunks, document, ...arts columns)."""
    return f"""{prefix}a AS (SELECT *, {tokens('title')} AS tt, {tokens('content')} AS ct FROM {arts}),
{prefix}long AS (SELECT *, {max_tokens} - tt - 10 AS budget FROM {prefix}a WHERE tt + ct > {max_tokens}),
{sentence_walk(f'{prefix}long', 'id', 'content', 'budget', prefix)},
{prefix}records AS (
  SELECT a.id, a.id AS article_id, 0 AS chunk_index, 1 AS total_chunks, a.title || {NL2} || a.content AS document,
         a.* EXCLUDE (id, tt, ct)
  FROM {prefix}a a WHERE a.tt + a.ct <= {max_tokens}
  UNION ALL
  SELECT a.id || '_chunk_' || CAST(c.chunk_index AS VARCHAR), a.id, c.chunk_index,
         CAST(count(*) OVER (PARTITION BY a.id) AS INTEGER), a.title || {NL2} || c.chunk,
         a.* EXCLUDE (id, tt, ct, budget)
  FROM {prefix}long a JOIN {prefix}chunks c ON c.k = a.id)"""


def with_(*ctes: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes) + "\n"


# ------------------------------------------------------------------ model limits, prompts, replies
def context_limit(m: str) -> str:
    exact = " ".join(f"WHEN {lit(k)} THEN {v}" for k, v in MODEL_LIMITS.items())
    rules = []
    for needles, limit in MODEL_RULES:
        cond = " OR ".join(f"contains(lower({m}), {lit(n)})" for n in needles)
        rules.append(f"WHEN {cond} THEN {limit}")
    rules.append(f"WHEN contains(lower({m}), 'davinci') AND contains(lower({m}), 'code') THEN {DAVINCI_CODE}")
    rules.append(f"WHEN contains(lower({m}), 'davinci') THEN {DAVINCI_TEXT}")
    return (f"CAST(coalesce(CASE {m} {exact} ELSE NULL END, CASE {' '.join(rules)} ELSE {DEFAULT_LIMIT} END) AS INTEGER)")


def model_of(doc_id: str) -> str:
    names = "[" + ", ".join(lit(n) for n in C.MODEL_CANDIDATES) + "]"
    return f"({names})[CAST({doc_id} % {len(C.MODEL_CANDIDATES)} AS INTEGER) + 1]"


def planted(doc_id: str, part_: str, lang: str, source: str) -> str:
    doc_id, part_ = f"({doc_id})", f"({part_})"
    pid = f"CAST({doc_id} AS VARCHAR) || '.' || CAST({part_} AS VARCHAR)"
    return (f"CASE WHEN {doc_id} % 11 = 0 THEN 'not json' "
            f"WHEN {doc_id} % 7 = 0 THEN '{{\"topics\":[\"' || {source} || '\",\" x \"]}}' "
            f"WHEN {doc_id} % 5 = 0 THEN '{{\"summary\":\"\"}}' "
            f"WHEN {doc_id} % 13 = 0 THEN '{{\"summary\":\"s' || {pid} || '\",\"topics\":[\"' || {lang} || '\",7]}}' "
            f"WHEN {doc_id} % 17 = 0 THEN '{{\"summary\":null,\"topics\":null}}' "
            f"WHEN {doc_id} % 19 = 0 THEN '{{\"summary\":0,\"topics\":{{\"' || {lang} || '\":1,\" k \":2}}}}' "
            f"WHEN {doc_id} % 23 = 0 THEN '{{\"summary\":\"s' || {pid} || '\",\"topics\":\"' || {lang} || ' x\"}}' "
            f"ELSE '{{\"summary\":\"s' || {pid} || '\",\"topics\":[\" ' || {lang} || ' \",\"' || upper({lang}) || '\",\"' || {source} "
            f"|| '\",\"t' || CAST({part_} % 3 AS VARCHAR) || '\",\"\"]}}' END")


def _truthy(kind: str, path: str) -> str:
    """Python truth value of the JSON value at ``path`` of ``j`` (missing counts as false)."""
    return (f"CASE WHEN {kind} IS NULL OR {kind} = 'NULL' THEN false "
            f"WHEN {kind} = 'VARCHAR' THEN json_extract_string(j, '{path}') <> '' "
            f"WHEN {kind} = 'BOOLEAN' THEN json_extract_string(j, '{path}') = 'true' "
            f"WHEN {kind} = 'ARRAY' THEN json_array_length(j, '{path}') > 0 "
            f"WHEN {kind} = 'OBJECT' THEN len(json_keys(j, '{path}')) > 0 "
            f"ELSE coalesce(TRY_CAST(json_extract_string(j, '{path}') AS DOUBLE) <> 0, true) END")


def parsed(src: str, body: str = "body") -> str:
    """Rows of ``src`` plus the reply fields: is_obj, has_s, has_t, s_true, t_true, s_str,
    iterable (topics iterate to strings) and topics_clean."""
    b = strip(body)
    items = ("CASE WHEN t_type = 'ARRAY' THEN json_extract_string(j, '$.topics[*]') "
             "WHEN t_type = 'VARCHAR' THEN string_split(json_extract_string(j, '$.topics'), '') "
             "WHEN t_type = 'OBJECT' THEN json_keys(j, '$.topics') END")
    all_str = ("coalesce(list_bool_and(list_transform(json_extract(j, '$.topics[*]'), "
               "lambda e: json_type(e) = 'VARCHAR')), true)")
    return f"""(SELECT *,
  {_truthy('s_type', '$.summary')} AS s_true,
  {_truthy('t_type', '$.topics')} AS t_true,
  CASE WHEN t_type = 'ARRAY' THEN {all_str} WHEN t_type IN ('VARCHAR', 'OBJECT') THEN true ELSE false END AS iterable,
  coalesce(list_filter(list_transform({items}, lambda t: {strip('t')}), lambda t: t <> ''), []::VARCHAR[]) AS topics_clean
FROM (SELECT *,
  coalesce(json_type(j) = 'OBJECT', false) AS is_obj,
  coalesce(json_type(j) = 'OBJECT' AND json_exists(j, '$.summary'), false) AS has_s,
  coalesce(json_type(j) = 'OBJECT' AND json_exists(j, '$.topics'), false) AS has_t,
  CASE WHEN json_type(j) = 'OBJECT' THEN json_type(j, '$.summary') END AS s_type,
  CASE WHEN json_type(j) = 'OBJECT' THEN json_type(j, '$.topics') END AS t_type,
  json_extract_string(j, '$.summary') AS s_str
FROM (SELECT *, CASE WHEN json_valid({b}) THEN CAST({b} AS JSON) END AS j FROM {src})))"""


def single_parse(src: str) -> str:
    ok = "(is_obj AND has_s AND has_t AND (NOT t_true OR iterable))"
    return f"""SELECT *,
  CASE WHEN {ok} THEN CASE WHEN s_true THEN s_str ELSE {lit(NO_SUMMARY)} END ELSE {lit(FAILED)} END AS summary,
  CASE WHEN {ok} AND t_true THEN topics_clean ELSE []::VARCHAR[] END AS topics,
  {ok} AS ok
FROM {src}"""


def part_parse(src: str) -> str:
    ok = "(is_obj AND (NOT has_t OR iterable))"
    failed = FAILED_PART.split("{}")
    return f"""SELECT *,
  CASE WHEN {ok} THEN CASE WHEN NOT has_s THEN {lit(NO_SUMMARY)} ELSE coalesce(s_str, '') END
       ELSE {lit(failed[0])} || CAST(part AS VARCHAR) || {lit(failed[1])} END AS summary,
  CASE WHEN {ok} AND has_t THEN topics_clean ELSE []::VARCHAR[] END AS topics,
  {ok} AS ok
FROM {src}"""


def prompt(text: str, part_: str, parts: str) -> str:
    before, after = PROMPT_TEMPLATE.replace("{{", "{").replace("}}", "}").split("{context}")
    ctx = f"CASE WHEN {parts} > 1 THEN ' (Part ' || CAST({part_} AS VARCHAR) || ' of ' || CAST({parts} AS VARCHAR) || ')' ELSE '' END"
    return f"{lit(before)} || {ctx} || {lit(after)} || {text}"


def sqdist(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[])), lambda x: (x[1] - x[2]) * (x[1] - x[2])))"


def knn_sql(queries: str, store: str, k: int, extra_cols: str = "") -> str:
    """SELECT over CTEs named by the caller: queries(qid, qv), store(id, emb, ...)."""
    return f"""d AS (SELECT q.qid, s.id, {sqdist('q.qv', 's.emb')} AS distance {extra_cols} FROM {queries} q, {store} s),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY qid ORDER BY distance, id) AS INTEGER) AS rank FROM d QUALIFY rank <= {k})"""


# ------------------------------------------------------------------ the queries
SQL: dict[str, str] = {}

SQL["url_list_scan"] = with_(LINES) + f"""SELECT line_no, {strip('value')} AS url FROM lines
WHERE starts_with(value, 'http') AND {strict_valid(strip('value'))}"""

SQL["url_valid"] = with_(LINES) + f"""SELECT line_no, {strict_valid('value')} AS strict_valid,
  {prefix_valid('value')} AS prefix_valid, {strip('value')} AS trimmed FROM lines"""

SQL["url_normalize"] = with_(LINES) + f"SELECT line_no, {normalize('value')} AS normalized FROM lines"

SQL["url_dedup"] = f"""SELECT {normalize('url')} AS normalized, min(page_id) AS first_page_id, count(*) AS copies
FROM pages GROUP BY 1"""

SQL["url_domain"] = f"SELECT {netloc('url')} AS domain, count(*) AS pages FROM pages GROUP BY 1"

SQL["page_fields"] = with_(FIELDS) + """SELECT page_id, raw_title AS title, raw_text AS text,
  array_to_string(authors, '|') AS authors, top_image, meta_description, array_to_string(meta_keywords, '|') AS meta_keywords
FROM fields"""

SQL["drop_incomplete"] = with_(FIELDS) + "SELECT page_id, url FROM fields WHERE raw_title <> '' AND raw_text <> ''"

SQL["articles"] = with_(PAGE_ARTICLES) + f"""SELECT page_id, id, url, title, content, source_domain, word_count,
  array_to_string(authors, '|') AS authors, array_to_string(meta_keywords, '|') AS meta_keywords,
  meta_description, top_image, '' AS topics, CAST(NULL AS VARCHAR) AS summary, {ts_iso('scraped_at')} AS scraped_at
FROM page_articles"""

SQL["ingest_outcome"] = f"""SELECT count(*) AS attempted,
  count(*) FILTER (WHERE {prefix_valid('url')} AND {html_title('html')} <> '' AND {html_text('html')} <> '') AS kept,
  count(*) - count(*) FILTER (WHERE {prefix_valid('url')} AND {html_title('html')} <> '' AND {html_text('html')} <> '') AS dropped
FROM pages"""

SQL["ingest_order"] = with_(LINES, PAGE_ARTICLES, f"""listed AS (SELECT pos, {strip('value')} AS url
  FROM (SELECT row_number() OVER (ORDER BY line_no) - 1 AS pos, value FROM lines) WHERE starts_with(value, 'http') AND {strict_valid(strip('value'))}),
one AS (SELECT id, arg_min(title, page_id) AS title FROM page_articles GROUP BY id)""") + """SELECT pos, l.url, o.id AS article_id, o.title, o.title IS NOT NULL AS kept
FROM listed l LEFT JOIN one o ON o.id = sha256(l.url)"""

LINKS = f"""links AS (SELECT page_id, url, CAST(h.pos - 1 AS INTEGER) AS pos, {unescape('h.href')} AS href
  FROM pages, unnest({hrefs('html')}) WITH ORDINALITY AS h(href, pos))"""

SQL["page_links"] = with_(LINKS) + "SELECT page_id, pos, href FROM links"
SQL["page_links_abs"] = with_(LINKS) + f"SELECT page_id, pos, {resolve('url', 'href')} AS link FROM links"
SQL["page_links_same_domain"] = with_(LINKS, f"abs_links AS (SELECT page_id, url, pos, {resolve('url', 'href')} AS link FROM links)") + \
    f"SELECT page_id, pos, link FROM abs_links WHERE {netloc('link')} = {netloc('url')}"

HUB = """hub AS (
  SELECT 'https://n' || CAST(o_custkey % 25 AS VARCHAR) || '.example.com/' AS url, o_orderkey AS pos,
    CASE WHEN o_orderkey % 3 = 0 THEN 'https://www.n' || CAST(o_custkey % 25 AS VARCHAR) || '.example.com' || p ELSE p END
    || CASE WHEN o_orderkey % 2 = 0 THEN '#top' ELSE '' END AS href
  FROM (SELECT *, CASE WHEN o_orderkey % 5 = 0 THEN '/category' WHEN o_orderkey % 7 = 0 THEN '/Story' ELSE '' END
          || '/' || strftime(o_orderdate, '%Y/%m') || '/' || lower(o_orderstatus) || '-' || CAST(o_orderkey % 4 AS VARCHAR) AS p
        FROM orders))"""
SQL["article_links"] = with_(HUB, f"res AS (SELECT url, pos, {resolve('url', 'href')} AS link FROM hub)") + f"""
SELECT url AS hub, link, CAST(min(pos) AS BIGINT) AS first_pos, count(*) AS n_refs FROM res
WHERE {netloc('link')} = {netloc('url')} AND {is_article('link')} GROUP BY url, link"""

_CLEAN = (f"regexp_replace(regexp_replace(regexp_replace(text, {lit(f'[{WS}]+')}, ' ', 'g'), '\\[.*?\\]', '', 'g'), "
          f"'\\(.*?\\)', '', 'g')")
_CLEAN = (f"replace(translate(replace({_CLEAN}, {lit(chr(0xA0))}, ' '), {lit('\u2019\u201c\u201d\u2013')}, "
          f"{lit(chr(39) + '\"\"-')}), {lit('\u2014')}, '--')")
SQL["clean_text"] = f"SELECT doc_id, CASE WHEN text IS NULL THEN '' ELSE {strip(_CLEAN)} END AS cleaned FROM documents"

_HEAD = "substr(text, 1, 97)"
_LAST = f"CASE WHEN instr({_HEAD}, ' ') > 0 THEN length(regexp_replace({_HEAD}, ' [^ ]*\\z', '')) ELSE -1 END"
SQL["truncate_text"] = f"""SELECT doc_id, CASE WHEN length(text) <= 100 THEN text
  ELSE (CASE WHEN {_LAST} > 70 THEN substr({_HEAD}, 1, {_LAST}) ELSE {_HEAD} END) || '...' END AS truncated FROM documents"""

_STOP = "(" + ", ".join(lit(w) for w in STOP_WORDS) + ")"
SQL["keywords"] = f"""WITH w AS (
  SELECT doc_id, t.word, t.pos FROM documents,
    unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}\\p{{N}}_]+')) WITH ORDINALITY AS t(word, pos)),
c AS (SELECT doc_id, word, CAST(count(*) AS INTEGER) AS freq, min(pos) AS first_pos FROM w
      WHERE regexp_full_match(word, '[a-zA-Z]{{3,}}') AND word NOT IN {_STOP} GROUP BY doc_id, word)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY freq DESC, first_pos) AS INTEGER) AS rank, word, freq
FROM c QUALIFY rank <= 10"""

SQL["word_count"] = f"SELECT doc_id, {word_count('text')} AS words FROM documents"
SQL["token_count"] = f"SELECT doc_id, {tokens('text')} AS tokens FROM documents"

SQL["email_audit"] = f"""WITH tokens AS (
  SELECT source, token FROM (SELECT source, unnest({words('text')}) AS token FROM documents) WHERE contains(token, '@'))
SELECT s.source, count(t.token) AS candidates,
  count(t.token) FILTER (WHERE regexp_matches(t.token, {lit(EMAIL_PATTERN)})) AS valid,
  count(t.token) FILTER (WHERE NOT regexp_matches(t.token, {lit(EMAIL_PATTERN)})) AS invalid
FROM (SELECT DISTINCT source FROM documents) s LEFT JOIN tokens t ON s.source IS NOT DISTINCT FROM t.source GROUP BY s.source"""


def file_key(x: str) -> str:
    s = f"regexp_replace({x}, {lit(FILE_KEY_INVALID)}, '_', 'g')"
    s = f"regexp_replace({s}, '\\A[. ]+|[. ]+\\z', '', 'g')"
    return f"coalesce(nullif({s}, ''), {lit(FILE_KEY_DEFAULT)})"


SQL["export_key"] = with_(FIELDS) + f"SELECT page_id, {file_key('url')} AS url_key, {file_key(strip('raw_title'))} AS title_key FROM fields"

SQL["export_write"] = with_(FIELDS) + f"""SELECT page_id, url, {strip('raw_title')} AS title, {netloc('url')} AS domain,
  {file_key(netloc('url'))} AS file_key FROM fields"""

SQL["batch_assign"] = f"""SELECT page_id, domain, CAST((rn - 1) // {C.BATCH_SIZE} AS INTEGER) AS batch_no,
  CAST((rn - 1) % {C.BATCH_SIZE} AS INTEGER) AS batch_pos
FROM (SELECT page_id, {netloc('url')} AS domain, row_number() OVER (PARTITION BY {netloc('url')} ORDER BY page_id) AS rn FROM pages)"""


def human_size(b: str) -> str:
    units = ["B", "KB", "MB", "GB", "TB"]
    whens = " ".join(
        f"WHEN CAST({b} AS DOUBLE) / {1024.0 ** i!r} < 1024.0 THEN printf('%.1f', CAST({b} AS DOUBLE) / {1024.0 ** i!r}) || '{u}'"
        for i, u in enumerate(units))
    return f"CASE {whens} ELSE printf('%.1f', CAST({b} AS DOUBLE) / {1024.0 ** 5!r}) || 'PB' END"


SQL["size_report"] = f"""SELECT domain, pages, bytes, {human_size('bytes')} AS size FROM (
  SELECT {netloc('url')} AS domain, count(*) AS pages, CAST(sum(octet_length(encode(html))) AS BIGINT) AS bytes
  FROM pages GROUP BY 1)"""

SQL["duration_report"] = """SELECT user_id, events, seconds,
  CASE WHEN seconds < 60 THEN printf('%.1f', seconds) || 's' WHEN seconds < 3600 THEN printf('%.1f', seconds / 60.0) || 'm'
       ELSE printf('%.1f', seconds / 3600.0) || 'h' END AS active
FROM (SELECT user_id, count(*) AS events, CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS DOUBLE) / 1000000.0 AS seconds
      FROM events GROUP BY user_id)"""

SQL["storage_gate"] = with_(DOC_ARTICLES, records("doc_articles", 8000), recursive=True) + \
    "SELECT id, article_id, chunk_index, total_chunks, document FROM r_records"

SQL["sentence_chunks"] = with_(sentence_walk("documents", "doc_id", "text", str(C.CHUNK_BUDGET), "s_"), recursive=True) + \
    f"SELECT k AS doc_id, chunk_index, chunk, {tokens('chunk')} AS tokens FROM s_chunks"

SQL["chunk_records"] = with_(DOC_ARTICLES, records("doc_articles", C.STORE_TEST_MAX_TOKENS), recursive=True) + \
    "SELECT id, article_id, chunk_index, total_chunks, document FROM r_records"

LONG_TEXTS = f"long_texts AS (SELECT conv_id, string_agg(text, {NL2} ORDER BY turn) AS content FROM conversations GROUP BY conv_id)"
SQL["paragraph_chunks"] = with_(LONG_TEXTS, paragraph_walk("long_texts", "conv_id", "content",
                                                          str(C.LONG_TEXT_MAX_TOKENS - 1000), "c_"), recursive=True) + \
    "SELECT k AS conv_id, chunk_index, chunk FROM c_pchunks"

SQL["context_limit"] = f"""SELECT doc_id, model, {context_limit('model')} AS context_limit
FROM (SELECT doc_id, {model_of('doc_id')} AS model FROM documents)"""

ROUTED = f"""routed AS (
  SELECT *, CASE WHEN n_tokens <= context_limit - 1000 THEN 'single' ELSE 'parts' END AS route
  FROM (SELECT *, {context_limit('model')} AS context_limit, {tokens('content')} AS n_tokens
        FROM (SELECT *, {model_of('doc_id')} AS model FROM doc_articles))),
long_routed AS (SELECT * FROM routed WHERE route = 'parts'),
{paragraph_walk('long_routed', 'id', 'content', 'context_limit - 1000', 'e_')},
parts_count AS (SELECT k, CAST(count(*) AS INTEGER) AS n FROM e_pchunks GROUP BY k)"""

SQL["analysis_route"] = with_(DOC_ARTICLES, ROUTED, recursive=True) + """SELECT r.id, r.model, r.n_tokens, r.context_limit, r.route,
  CASE WHEN r.route = 'single' THEN 1 ELSE coalesce(p.n, 0) END AS n_parts
FROM routed r LEFT JOIN parts_count p ON p.k = r.id"""

REQUESTS = f"""requests AS (
  SELECT id AS request_id, 1 AS part, 1 AS parts, route, {prompt('content', '1', '1')} AS prompt, doc_id, lang, source
  FROM routed WHERE route = 'single'
  UNION ALL
  SELECT r.id, c.chunk_index + 1, CAST(p.n AS INTEGER), r.route, {prompt('c.chunk', 'c.chunk_index + 1', 'p.n')}, r.doc_id, r.lang, r.source
  FROM routed r JOIN e_pchunks c ON c.k = r.id JOIN parts_count p ON p.k = r.id)"""

SQL["prompt_requests"] = with_(DOC_ARTICLES, ROUTED, REQUESTS, recursive=True) + \
    "SELECT request_id, CAST(part AS INTEGER) AS part, CAST(parts AS INTEGER) AS parts, route, prompt FROM requests"

SINGLE_RESP = f"""single_resp AS (SELECT doc_id, {planted('doc_id', '1', 'lang', 'source')} AS body FROM documents),
single_p AS (SELECT * FROM {parsed('single_resp')})"""
SQL["parse_single"] = with_(SINGLE_RESP) + f"""SELECT doc_id, summary, array_to_string(topics, '|') AS topics, ok
FROM ({single_parse('single_p')})"""

PART_RESP = f"""{sentence_walk('documents', 'doc_id', 'text', str(C.CHUNK_BUDGET), 'q_')},
part_resp AS (
  SELECT d.doc_id, CAST(c.chunk_index + 1 AS INTEGER) AS part, {planted('d.doc_id', 'c.chunk_index + 1', 'd.lang', 'd.source')} AS body
  FROM documents d JOIN q_chunks c ON c.k = d.doc_id),
part_p AS (SELECT * FROM {parsed('part_resp')}),
parsed_parts AS ({part_parse('part_p')})"""
SQL["parse_part"] = with_(PART_RESP, recursive=True) + \
    "SELECT doc_id, part, summary, array_to_string(topics, '|') AS topics, ok FROM parsed_parts"


def merge_summaries_sql(src: str, key: str) -> str:
    return f"""SELECT {key}, CAST(count(*) AS INTEGER) AS n_parts,
  string_agg('Section ' || CAST(part AS VARCHAR) || ': ' || summary, {NL2} ORDER BY part) AS merge_prompt,
  {strip("string_agg(summary, ' ' ORDER BY part)")} AS summary
FROM {src} GROUP BY {key}"""


def merge_topics_sql(src: str, key: str) -> str:
    return f"""SELECT {key}, string_agg(m.t, '|' ORDER BY m.p, m.i) AS topics FROM (
  SELECT {key}, min({{'p': part, 'i': x.pos, 't': x.topic}}) AS m
  FROM {src}, unnest(topics) WITH ORDINALITY AS x(topic, pos) GROUP BY {key}, lower(x.topic)) GROUP BY {key}"""


SQL["merge_summaries"] = with_(PART_RESP, recursive=True) + merge_summaries_sql("parsed_parts", "doc_id")
SQL["merge_topics"] = with_(PART_RESP, f"mt AS ({merge_topics_sql('parsed_parts', 'doc_id')})", recursive=True) + \
    "SELECT d.doc_id, coalesce(mt.topics, '') AS topics FROM documents d LEFT JOIN mt ON mt.doc_id = d.doc_id"

ENRICHED = f"""resp_p AS (SELECT * FROM {parsed('resp')}),
e_single AS ({single_parse("(SELECT * FROM resp_p WHERE route = 'single')")}),
e_parts AS ({part_parse("(SELECT * FROM resp_p WHERE route = 'parts')")}),
e_ms AS ({merge_summaries_sql('e_parts', 'request_id')}),
e_mt AS ({merge_topics_sql('e_parts', 'request_id')})"""
REPLY = planted('doc_id', 'part', 'lang', 'source')
ENRICH = f"""resp AS (SELECT request_id, part, route, {REPLY} AS body FROM requests),
{ENRICHED}"""
SQL["stream_enrich"] = with_(DOC_ARTICLES, ROUTED, REQUESTS, f"""resp AS (SELECT request_id, part, route, CASE WHEN doc_id % 29 <> 0 AND doc_id % 31 <> 0 THEN {REPLY} END AS body FROM requests),
{ENRICHED}""", recursive=True) + """SELECT request_id, summary, array_to_string(topics, '|') AS topics FROM e_single
UNION ALL
SELECT s.request_id, s.summary, coalesce(t.topics, '') FROM e_ms s LEFT JOIN e_mt t ON t.request_id = s.request_id"""
SQL["enrich_articles"] = with_(DOC_ARTICLES, ROUTED, REQUESTS, ENRICH, recursive=True) + """
SELECT request_id, 'single' AS route, summary, array_to_string(topics, '|') AS topics FROM e_single
UNION ALL
SELECT s.request_id, 'parts', CASE a.doc_id % 3 WHEN 0 THEN 'whole ' || a.doc_id WHEN 1 THEN 'Could not generate final summary.'
  ELSE s.summary END, coalesce(t.topics, '')
FROM e_ms s JOIN doc_articles a ON a.id = s.request_id LEFT JOIN e_mt t ON t.request_id = s.request_id"""

QV = "qv AS (SELECT vec_id AS qid, embedding AS qv FROM embeddings)"
SQL["knn_topk"] = with_(QV, "st AS (SELECT vec_id AS id, embedding AS emb FROM embeddings)", knn_sql("qv", "st", 10)) + \
    "SELECT qid, rank, id, round(distance, 6) AS distance FROM ranked"
SQL["knn_filtered"] = with_(QV, "st AS (SELECT vec_id AS id, embedding AS emb FROM embeddings WHERE label IN (1, 2) OR label >= 7)",
                            knn_sql("qv", "st", 10)) + "SELECT qid, rank, id, round(distance, 6) AS distance FROM ranked"

DOC_STORE = "dst AS (SELECT a.id, a.title, a.content AS document, e.embedding AS emb FROM doc_articles a JOIN embeddings e ON e.vec_id = a.doc_id)"


def hydrated(k: int) -> str:
    return with_(DOC_ARTICLES, QV, DOC_STORE, knn_sql("qv", "dst", k, ", s.title, s.document"))


SQL["knn_hydrated"] = hydrated(10) + "SELECT qid, rank, id, title, round(distance, 6) AS distance FROM ranked"
SQL["retrieval_report"] = hydrated(5) + \
    "SELECT qid, rank, coalesce(title, 'No Title') AS title, round(exp(-distance), 4) AS score FROM ranked"

QUESTIONS = f"""qs AS (SELECT c.conv_id * 65536 + c.turn AS qid, {strip('c.text')} AS question, e.embedding AS qv
  FROM conversations c JOIN embeddings e ON e.vec_id = c.conv_id
  WHERE c.role = 'user' AND {strip('c.text')} <> '')"""
SQL["batch_questions"] = with_(QUESTIONS, "st AS (SELECT vec_id AS id, embedding AS emb FROM embeddings)",
                               knn_sql("qs", "st", 5, ", q.question")) + \
    "SELECT qid, question, rank, id, round(distance, 6) AS distance FROM ranked"
SQL["stream_questions"] = SQL["batch_questions"]

SQL["context_pack"] = hydrated(10).replace("WITH ", "WITH RECURSIVE ", 1) + f""",
h AS (SELECT qid, rank, document, {tokens('document')} AS tok FROM ranked),
pw(qid, rank, pack, total) AS (
  SELECT qid, rank, 0, tok FROM h WHERE rank = 1
  UNION ALL
  SELECT h.qid, h.rank, pw.pack + CASE WHEN pw.total + h.tok > {C.PACK_BUDGET} THEN 1 ELSE 0 END,
         CASE WHEN pw.total + h.tok > {C.PACK_BUDGET} THEN h.tok ELSE pw.total + h.tok END
  FROM pw JOIN h ON h.qid = pw.qid AND h.rank = pw.rank + 1)
SELECT pw.qid, CAST(pw.pack AS INTEGER) AS pack_no, CAST(count(*) AS INTEGER) AS n_hits, CAST(sum(h.tok) AS INTEGER) AS tokens,
       string_agg(h.document, {NL2} ORDER BY h.rank) AS context
FROM pw JOIN h ON h.qid = pw.qid AND h.rank = pw.rank GROUP BY pw.qid, pw.pack"""

STORE = records("doc_articles", C.STORE_TEST_MAX_TOKENS)
SQL["article_metadata"] = with_(DOC_ARTICLES, STORE, recursive=True) + f"""SELECT id, CAST(chunk_index AS INTEGER) AS chunk_index,
  CAST(total_chunks AS INTEGER) AS total_chunks, url, title, source_domain, word_count, {ts_iso('scraped_at')} AS scraped_at,
  '[]' AS authors, '[]' AS meta_keywords, '[]' AS topics, CAST(NULL AS VARCHAR) AS publish_date,
  CAST(NULL AS VARCHAR) AS top_image, CAST(NULL AS VARCHAR) AS meta_description, CAST(NULL AS VARCHAR) AS summary
FROM r_records"""

DOC_ARTICLES_B = DOC_ARTICLES.replace("doc_articles AS", "doc_articles_b AS").replace(
    f"{strip('text')} AS content", f"{strip('text')} || ' Updated.' AS content")
SQL["store_append"] = with_(DOC_ARTICLES, DOC_ARTICLES_B, STORE, records("doc_articles_b", C.STORE_TEST_MAX_TOKENS, "b_"),
                            recursive=True) + """,
stored AS (SELECT id, article_id, chunk_index, document FROM r_records WHERE lang = 'en')
SELECT * FROM stored
UNION ALL
SELECT id, article_id, chunk_index, document FROM b_records WHERE article_id NOT IN (SELECT article_id FROM stored)"""
SQL["store_append"] = SQL["store_append"].replace(")\n,\nstored AS", "),\nstored AS")

SQL["store_outcome"] = f"""SELECT count(*) FILTER (WHERE length(coalesce(t, '')) > 0 AND length(coalesce(c, '')) > 0) AS success,
  count(*) FILTER (WHERE NOT (length(coalesce(t, '')) > 0 AND length(coalesce(c, '')) > 0)) AS failed
FROM (SELECT {strip("split_part(text, chr(10), 1)")} AS t, {strip('text')} AS c FROM documents)"""

SQL["store_get"] = with_(DOC_ARTICLES, STORE, recursive=True) + \
    "SELECT id, document FROM r_records WHERE id IN (SELECT id FROM doc_articles)"

SQL["store_exists"] = with_(DOC_ARTICLES, STORE, recursive=True) + """, req AS (
  SELECT id FROM doc_articles UNION SELECT id || '_chunk_0' FROM doc_articles)
SELECT req.id, req.id IN (SELECT id FROM r_records) AS exists FROM req"""

SQL["store_list"] = with_(DOC_ARTICLES, STORE, recursive=True) + "SELECT id, title FROM r_records"

SQL["store_delete"] = with_(DOC_ARTICLES, STORE, recursive=True) + """SELECT id, article_id FROM r_records
WHERE article_id NOT IN (SELECT id FROM doc_articles WHERE lang = 'de')
  AND id NOT IN (SELECT id || '_chunk_1' FROM doc_articles)"""

SQL["store_count"] = with_(DOC_ARTICLES, STORE, recursive=True) + \
    "SELECT count(*) AS records, count(DISTINCT article_id) AS articles FROM r_records"

SQL["store_reset"] = with_(DOC_ARTICLES, STORE, recursive=True) + \
    "SELECT count(*) AS before, CAST(0 AS BIGINT) AS after FROM r_records"

FIRST_COPY = "first_copy AS (SELECT * FROM page_articles QUALIFY row_number() OVER (PARTITION BY id ORDER BY page_id) = 1)"
SQL["stream_ingest"] = with_(PAGE_ARTICLES, FIRST_COPY, records("first_copy", C.STORE_TEST_MAX_TOKENS), recursive=True) + \
    "SELECT id, article_id, chunk_index, total_chunks, document FROM r_records"

for _k in list(SQL):
    # drop an accidental leading comma left by CTE concatenation
    SQL[_k] = SQL[_k].replace("\n, req AS", ",\nreq AS").replace("\n,\nstored", ",\nstored")
