"""HTML field extraction as column expressions.

Stated rule (the reference delegates boilerplate removal to a heuristic
library; we use a fixed, documented rule that is exact in both Spark and
DuckDB):

* title  = text of the first ``<title>`` element;
* body   = the ``<p>`` blocks inside the first ``<article>`` element (of the
  whole page if it has none), each one running to its ``</p>`` or to the next
  ``<p>`` (unclosed paragraphs occur), tags removed, entities unescaped,
  stripped, empty ones dropped, joined by a blank line;
* authors / keywords / description / top image = ``content`` of ``<meta>`` tags
  with the given ``name`` (or ``property``), attributes in any order;
* links  = ``href`` values of ``<a>`` tags, unescaped.

Tag and attribute names match in any case.  Attribute values may stand in
double quotes, in single quotes or bare; of repeated attributes the first counts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio.functions.text import lit_re, py_strip

# --- fixed values -----------------------------------------------------------
# Entities decoded by the extractor; '&amp;' is decoded last.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))
# ---------------------------------------------------------------------------

P_OPEN = r"(?i)<p(?:\s[^>]*)?>"
ARTICLE = r"(?is)<article(?:\s[^>]*)?>(.*?)</article>"
TITLE = r"(?is)<title(?:\s[^>]*)?>(.*?)</title>"
TAG = r"<[^>]*>"
P_CLOSE = r"(?i)</p\s*>"
VALUE = r"""(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
ATTRIBUTE = r"""\s[^\s=>"'/]+\s*=\s*""" + VALUE


def opening(tag: str) -> str:
    """Pattern of an opening tag with attributes; a quoted value may hold ``>``."""
    return rf"""(?i)<{tag}\s(?:"[^"]*"|'[^']*'|[^>"']+)*+>"""


def unescape(col: Column) -> Column:
    out = col
    for ent, ch in ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    return out


def strip_tags(col: Column) -> Column:
    return F.regexp_replace(col, TAG, "")


def title(html: Column) -> Column:
    """Raw title (not stripped; A4 tests emptiness before A5 strips)."""
    return unescape(strip_tags(F.regexp_extract(html, TITLE, 1)))


def paragraphs(html: Column) -> Column:
    """Array of cleaned paragraph texts inside the first ``<article>``, or of a page without one."""
    def of(inner: Column) -> Column:
        segs = F.split(inner, P_OPEN)
        segs = F.slice(segs, 2, F.size(segs))  # text before the first <p> is not a paragraph
        cleaned = F.transform(segs, lambda s: py_strip(unescape(strip_tags(F.split(s, P_CLOSE, 2)[0]))))
        return F.filter(cleaned, lambda s: s != "")
    inner = F.when(html.rlike(ARTICLE), F.regexp_extract(html, ARTICLE, 1)).otherwise(html)
    return F.transform(F.array(inner), of)[0]


def body_text(html: Column) -> Column:
    return F.array_join(paragraphs(html), "\n\n")


def _attribute(tag: Column, name: str) -> Column:
    """Raw value of the first attribute ``name`` of an opening tag; NULL without one."""
    found = F.filter(F.regexp_extract_all(tag, lit_re(ATTRIBUTE), 0), lambda a: a.rlike(rf"(?i)^\s{name}\s*="))
    parts = lambda a: F.concat(*[F.regexp_extract(a, r"=\s*" + VALUE, i) for i in (1, 2, 3)])
    return F.get(F.transform(found, parts), F.lit(0))


def _meta(html: Column, attr: str, name: str) -> Column:
    """``content`` of the ``<meta>`` tags whose ``attr`` is ``name``."""
    tags = F.filter(F.regexp_extract_all(html, lit_re(opening("meta")), 0), lambda t: F.lower(_attribute(t, attr)) == name)
    return F.filter(F.transform(tags, lambda t: _attribute(t, "content")), lambda c: c.isNotNull())


def authors(html: Column) -> Column:
    return F.filter(F.transform(_meta(html, "name", "author"), lambda s: py_strip(unescape(s))), lambda s: s != "")


def meta_keywords(html: Column) -> Column:
    first = F.try_element_at(_meta(html, "name", "keywords"), F.lit(1))
    parts = F.transform(F.split(F.coalesce(first, F.lit("")), ","), lambda s: py_strip(unescape(s)))
    return F.filter(parts, lambda s: s != "")


def meta_description(html: Column) -> Column:
    return F.coalesce(py_strip(unescape(F.try_element_at(_meta(html, "name", "description"), F.lit(1)))), F.lit(""))


def top_image(html: Column) -> Column:
    img = F.try_element_at(_meta(html, "property", "og:image"), F.lit(1))
    return F.nullif(F.coalesce(unescape(img), F.lit("")), F.lit(""))


def hrefs(html: Column) -> Column:
    tags = F.regexp_extract_all(html, lit_re(opening("a")), 0)
    return F.transform(F.filter(F.transform(tags, lambda t: _attribute(t, "href")), lambda h: h.isNotNull()), unescape)
