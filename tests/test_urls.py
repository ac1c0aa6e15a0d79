from urllib.parse import urljoin, urlparse

from pyspark.sql import functions as F

from folio.functions import urls as U
from folio.operators.pages import url_list_scan

URLS = [
    "https://example.com/a/b?x=1&utm_source=feed&y=2#frag",
    "HTTP://Example.COM:8080/path;params?ref=abc",
    "http://user:pw@host.org/p/q/?a&b=1&source=x",
    "https://host/dir/file.html?UTM_MEDIUM=z&k=v",
    "ftp://files.example.com/x",
    "http:///nohost",
    "//cdn.example.com/lib.js",
    "example.com/no-scheme",
    "https://x.org",
    "https://x.org/a;b/c;d?q=1",
    "mailto:someone@example.com",
    "",
]


#: normalised form and strict validity of URLS, in order
EXPECTED = [
    ("https://example.com/a/b?x=1&y=2", True),
    ("http://Example.COM:8080/path", True),
    ("http://user:pw@host.org/p/q/?b=1", True),
    ("https://host/dir/file.html?k=v", True),
    ("ftp://files.example.com/x", False),
    ("http:///nohost", False),
    ("://cdn.example.com/lib.js", False),
    ("://example.com/no-scheme", False),
    ("https://x.org", True),
    ("https://x.org/a;b/c?q=1", True),
    ("mailto://someone@example.com", False),
    ("://", False),
]


def test_url_functions_match_stdlib(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "u string")
    rows = df.select("u", U.normalize(F.col("u")).alias("n"), U.netloc(F.col("u")).alias("d"),
                     U.strict_valid(F.col("u")).alias("v"), U.prefix_valid(F.col("u")).alias("pv")).collect()
    want = dict(zip(URLS, EXPECTED))
    for r in rows:
        assert (r.n, r.v) == want[r.u], r.u
        assert r.d == urlparse(r.u).netloc, r.u
        assert r.pv == r.u.startswith(("http://", "https://")), r.u


def test_normalize_is_idempotent(spark):
    df = spark.createDataFrame([(u,) for u in URLS if u.startswith("http")], "u string")
    once = df.select(U.normalize(F.col("u")).alias("n"))
    twice = once.select(U.normalize(F.col("n")).alias("n2"), "n").collect()
    assert all(r.n == r.n2 for r in twice)


BASES = ["http://a.com/b/c/d;p?q#f", "https://host:81/dir/", "https://host", "http://h.org/a/b/c"]
HREFS = ["g", "./g", "g/", "/g", "//g.org/x", "?y", "g?y", "#s", "g#s", "..", "../g", "../..", "../../../g",
         "/./g", "/../g", "g.", ".g", "g..", "./../g", "g/./h", "g/../h", "", "https://other.com/x",
         "mailto:a@b.c", "/a?", "g;x=1/../y", "a//b"]


def test_resolve_matches_urljoin(spark):
    pairs = [(b, h) for b in BASES for h in HREFS]
    df = spark.createDataFrame(pairs, "b string, h string")
    got = df.select("b", "h", U.resolve(F.col("b"), F.col("h")).alias("r")).collect()
    bad = [(r.b, r.h, r.r, urljoin(r.b, r.h)) for r in got if r.r != urljoin(r.b, r.h)]
    assert not bad, bad[:5]


def test_article_classifier(spark):
    cases = {
        "https://n.example.com/2024/05/slug": True,
        "https://n.example.com/Story/x": True,
        "https://n.example.com/category/2024/05/x": False,
        "https://n.example.com/tag/news/x": False,
        "https://n.example.com/about": False,
        "https://n.example.com/world/news/x": True,
    }
    df = spark.createDataFrame(list(cases.items()), "u string, want boolean")
    assert all(r.got == r.want for r in df.select("want", U.is_article_url(F.col("u")).alias("got")).collect())


def test_url_list_scan_sample_shape(spark):
    lines = [
        "# a comment",
        "# another, with http://in.it",
        "",
        "https://example.org/one",
        "https://example.org/two",
        "https://example.org/three",
        "https://example.org/four",
        "https://example.org/five",
        "https://example.org/six",
        "",
        "",
        "*** last line ***",
        "  https://example.org/indented",
        "HTTP://example.org/upper",
        "http:///no-host",
    ]
    df = spark.createDataFrame(list(enumerate(lines)), "line_no long, value string")
    out = url_list_scan(df).orderBy("line_no").collect()
    assert [r.url for r in out] == [f"https://example.org/{w}" for w in ("one", "two", "three", "four", "five", "six")]
