import duckdb
from pyspark.sql import functions as F

from folio.functions import html as H
from folio.plans import oracle as O

#: page, links, body, description, authors
CASES = [
    ("""<a href="one">x</a><a href='two'>x</a><A HREF=three>x</A><a data-href="bad" href="good">x</a><a name="n">x</a>""",
     ["one", "two", "three", "good"], "", "", []),
    ("""<ARTICLE><P>first</P> tail<p>second<p class="x">third</p ></ARTICLE><p>outside</p>""",
     [], "first\n\nsecond\n\nthird", "", []),
    ("<body><p>no article</p> rest <p>at all</p></body>", [], "no article\n\nat all", "", []),
    ("""<meta content="about > this" name="description"><META NAME='author' CONTENT='O"Neil'><meta name=author content=Bo>""",
     [], "", "about > this", ['O"Neil', "Bo"]),
    ("""<a title="x href=no" href="yes?a=1&amp;b=2">x</a><article></article><p>not in the article</p>""",
     ["yes?a=1&b=2"], "", "", []),
]


def test_pages_as_they_are_found(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, html string").coalesce(1)
    h = F.col("html")
    got = df.select("i", H.hrefs(h), H.body_text(h), H.meta_description(h), H.authors(h)).orderBy("i").collect()
    assert [tuple(r)[1:] for r in got] == [c[1:] for c in CASES]


def test_oracle_reads_them_alike():
    con = duckdb.connect()
    for page, links, body, description, authors in CASES:
        got = con.execute(f"SELECT list_transform({O.hrefs('h')}, lambda x: {O.unescape('x')}), {O.html_text('h')}, "
                          f"{O.html_description('h')}, {O.html_authors('h')} FROM (SELECT ? AS h)", [page]).fetchone()
        assert got == (links, body, description, authors)
