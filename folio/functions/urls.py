"""URL column functions.

A URL is split with one regular expression that follows the generic
``scheme://netloc/path;params?query#fragment`` layout: the scheme is
lower-cased, the network location keeps port, user-info and case.  All
functions are built-in expressions (no Python UDF), so they run inside
codegen on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio.functions.text import py_strip

# --- fixed values -----------------------------------------------------------
# Query keys removed by URL normalisation (compared lower-cased).
TRACKING_PARAMS = (
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content",
    "fbclid", "gclid", "msclkid", "_ga", "_gl", "ref", "source",
)
# Path fragments of the article-link classifier.
ARTICLE_EXCLUDE = ("/category/", "/tag/", "/author/")
ARTICLE_PATTERNS = (r"/[0-9]{4}/[0-9]{2}/", "/story/", "/article/", "/news/")
# ---------------------------------------------------------------------------

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"
_DOT_SEGMENT = r"(^|/)\.\.?(/|$)"   # a '.' or '..' path segment
_SPLIT = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?$"


def prep(url: Column) -> Column:
    """What the generic parser does first: drop leading C0/space, remove tab/CR/LF."""
    return F.regexp_replace(F.regexp_replace(url, r"[\t\r\n]", ""), r"^[\x00-\x20]+", "")


def parse(url: Column) -> Column:
    """All parts of a URL in one struct (the split regex runs once per part on one bound value)."""
    def body(u: Column) -> Column:
        g = lambda i: F.regexp_extract(u, _SPLIT, i)
        return F.struct(
            F.lower(g(1)).alias("scheme"), (g(2) != "").alias("has_netloc"), g(3).alias("netloc"),
            g(4).alias("path"), (g(5) != "").alias("has_query"), g(6).alias("query"),
            (g(7) != "").alias("has_fragment"), g(8).alias("fragment"),
        )
    return F.transform(F.array(prep(url)), body)[0]


def _part(url: Column, idx: int) -> Column:
    return F.regexp_extract(prep(url), _SPLIT, idx)


def scheme(url: Column) -> Column:
    return F.lower(_part(url, 1))


def netloc(url: Column) -> Column:
    """The network location (host with port and user-info, case kept)."""
    return _part(url, 3)


def has_netloc(url: Column) -> Column:
    return _part(url, 2) != ""


def path(url: Column) -> Column:
    return _part(url, 4)


def query(url: Column) -> Column:
    return _part(url, 6)


def has_query(url: Column) -> Column:
    return _part(url, 5) != ""


def fragment(url: Column) -> Column:
    return _part(url, 8)


def has_fragment(url: Column) -> Column:
    return _part(url, 7) != ""


def strict_valid(url: Column) -> Column:
    """B1: scheme is http/https (any case) and a network location is present."""
    return F.coalesce(prep(url).rlike(r"^[Hh][Tt][Tt][Pp][Ss]?://[^/?#]"), F.lit(False))


def prefix_valid(url: Column) -> Column:
    """B2: starts with ``http://`` or ``https://`` exactly (case-sensitive)."""
    return F.coalesce(url.startswith("http://") | url.startswith("https://"), F.lit(False))


def trim_url(url: Column) -> Column:
    """Surrounding whitespace removed."""
    return py_strip(url)


def _drop_params(p: Column) -> Column:
    """Drop ``;params`` of the last path segment (as the generic parser does)."""
    return F.regexp_replace(p, r";[^/]*$", "")


def normalize(url: Column, tracking: tuple[str, ...] = TRACKING_PARAMS) -> Column:
    """Scheme://netloc/path plus the kept query; fragment and tracking keys dropped.

    Parameters without ``=`` are dropped too; order is kept; no ``?`` when
    nothing is left.
    """
    track = F.array(*[F.lit(t) for t in tracking])

    def body(p: Column) -> Column:
        kept = F.filter(
            F.split(p["query"], "&"),
            lambda x: (F.instr(x, "=") > 0) & ~F.array_contains(track, F.lower(F.substring_index(x, "=", 1))),
        )
        q = F.array_join(kept, "&")
        base = F.concat(p["scheme"], F.lit("://"), p["netloc"], _drop_params(p["path"]))
        return F.when(p["has_query"] & (q != ""), F.concat(base, F.lit("?"), q)).otherwise(base)

    return F.when(url.isNull(), F.lit(None)).otherwise(F.transform(F.array(parse(url)), body)[0])


def _remove_dot_segments(segments: Column) -> Column:
    """Resolve '.' and '..' over an array of path segments."""
    empty = F.array().cast("array<string>")
    return F.aggregate(
        segments,
        empty,
        lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == ".", acc)
        .otherwise(F.concat(acc, F.array(s))),
    )


def resolve(base: Column, href: Column) -> Column:
    """Resolve ``href`` against ``base`` the way ``urljoin`` does for web URLs.

    Cases: empty href; other scheme (kept as is); network location present
    (``//host`` or same scheme); empty path (``?q`` / ``#f``); absolute path
    ``/p``; relative path with ``.`` and ``..`` segments removed.  Empty query
    and fragment markers are dropped on rebuild.  Each URL is parsed once.
    """
    def q(x: Column) -> Column:
        return F.when(x != "", F.concat(F.lit("?"), x)).otherwise(F.lit(""))

    def f(x: Column) -> Column:
        return F.when(x != "", F.concat(F.lit("#"), x)).otherwise(F.lit(""))

    def _join(segs: Column) -> Column:
        resolved = _remove_dot_segments(segs)
        tail_dot = F.try_element_at(segs, F.lit(-1)).isin(".", "..")
        resolved = F.when(tail_dot, F.concat(resolved, F.array(F.lit("")))).otherwise(resolved)
        joined = F.array_join(resolved, "/")
        joined = F.when(joined == "", F.lit("/")).otherwise(joined)
        return F.when(F.substring(joined, 1, 1) != "/", F.concat(F.lit("/"), joined)).otherwise(joined)

    def body(b: Column, h: Column) -> Column:
        prefix = F.concat(b["scheme"], F.lit("://"), b["netloc"])
        h_path = h["path"]
        b_segs = F.split(b["path"], "/")
        b_dir = F.when(F.try_element_at(b_segs, F.lit(-1)) != "", F.slice(b_segs, 1, F.size(b_segs) - 1)).otherwise(b_segs)
        rel_all = F.concat(b_dir, F.split(h_path, "/"))
        n = F.size(rel_all)
        rel_segs = F.when(
            n > 2,
            F.concat(
                F.slice(rel_all, 1, 1),
                F.filter(F.slice(rel_all, 2, F.greatest(n - 2, F.lit(1))), lambda s: s != ""),
                F.slice(rel_all, -1, 1),
            ),
        ).otherwise(rel_all)
        eff_scheme = F.when(h["scheme"] != "", h["scheme"]).otherwise(b["scheme"])
        empty_path_q = F.when(h["query"] != "", h["query"]).otherwise(b["query"])
        empty_path_f = F.when((h["query"] != "") | (h["fragment"] != ""), h["fragment"]).otherwise(b["fragment"])
        return (
            F.when((h["scheme"] != "") & (h["scheme"] != b["scheme"]), href)
            .when(h["has_netloc"], F.concat(eff_scheme, F.lit("://"), h["netloc"], h_path, q(h["query"]), f(h["fragment"])))
            .when(h_path == "", F.concat(prefix, b["path"], q(empty_path_q), f(empty_path_f)))
            .when(h_path.startswith("/") & ~h_path.rlike(_DOT_SEGMENT), F.concat(prefix, h_path, q(h["query"]), f(h["fragment"])))
            .when(h_path.startswith("/"), F.concat(prefix, _join(F.split(h_path, "/")), q(h["query"]), f(h["fragment"])))
            .otherwise(F.concat(prefix, _join(rel_segs), q(h["query"]), f(h["fragment"])))
        )

    resolved = F.zip_with(F.array(parse(base)), F.array(parse(href)), body)[0]
    return F.when(href.isNull() | (href == ""), base).otherwise(resolved)


def is_article_url(url: Column) -> Column:
    """Lower-cased path: excluded sections first, then an article shape."""
    return is_article_path(parse(url)["path"])


def is_article_path(path_col: Column) -> Column:
    """B9 on an already parsed path."""
    p = F.lower(path_col)
    excluded = None
    for e in ARTICLE_EXCLUDE:
        c = F.instr(p, e) > 0
        excluded = c if excluded is None else excluded | c
    article = None
    for a in ARTICLE_PATTERNS:
        c = p.rlike(a)
        article = c if article is None else article | c
    return ~excluded & article


__all__ = [
    "TRACKING_PARAMS", "scheme", "netloc", "path", "query", "fragment", "strict_valid",
    "prefix_valid", "trim_url", "normalize", "resolve", "is_article_url", "is_article_path", "parse",
]
