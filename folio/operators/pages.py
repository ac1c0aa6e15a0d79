"""Pages to articles, and link discovery.

Everything here is a projection, filter or ``posexplode`` over the page rows:
no shuffle except the ordered distinct of B10 (a partial-then-final
aggregate, safe for hot keys because ``min``/``count`` combine map-side) and the
join and final order of a run's results (A17).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions import html as H
from folio.functions import urls as U
from folio.functions.text import py_strip, word_count
from folio.operators.common import computed



def url_list_scan(lines: DataFrame, value: str = "value", line_no: str = "line_no") -> DataFrame:
    """A1: keep lines that start with ``http`` (as read) and are valid once stripped."""
    trimmed = U.trim_url(F.col(value))
    return (
        lines.where(F.col(value).startswith("http") & U.strict_valid(trimmed))
        .select(F.col(line_no), trimmed.alias("url"))
    )


def page_fields(pages: DataFrame) -> DataFrame:
    """A2 + A3: extracted, not yet stripped article fields of every page."""
    html = F.col("html")
    # computed(): the later emptiness filter must not re-run the extraction
    return computed(
        pages.select("page_id", "url", "html"),
        raw_title=H.title(html),
        raw_text=H.body_text(html),
        authors=H.authors(html),
        top_image=H.top_image(html),
        meta_description=H.meta_description(html),
        meta_keywords=H.meta_keywords(html),
    ).drop("html")


def fetchable(pages: DataFrame) -> DataFrame:
    """Scraper-side URL check (B2) and trim (B3) before a page is read."""
    return pages.where(U.prefix_valid(F.col("url"))).withColumn("url", U.trim_url(F.col("url")))


def drop_incomplete(fields: DataFrame) -> DataFrame:
    """A4: no article when title or text is empty (tested before stripping)."""
    return fields.where((F.col("raw_title") != "") & (F.col("raw_text") != ""))


def article_id(url: Column) -> Column:
    """Deterministic article key: SHA-256 of the trimmed URL (re-runs are idempotent).

    Parameters are kept: pages that differ in their query are different pages.
    """
    return F.sha2(U.trim_url(url), 256)


def assemble(fields: DataFrame, scraped_at: Column, summary: Column | None = None,
             topics: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """A5: the article record: stripped title/content, defaults, domain, word count."""
    content = py_strip(F.col("raw_text"))
    return fields.select(
        article_id(F.col("url")).alias("id"),
        F.col("url"),
        py_strip(F.col("raw_title")).alias("title"),
        content.alias("content"),
        F.coalesce(F.col("authors"), F.array().cast("array<string>")).alias("authors"),
        F.lit(None).cast("timestamp_ntz").alias("publish_date"),
        scraped_at.alias("scraped_at"),
        F.col("top_image"),
        F.coalesce(F.col("meta_description"), F.lit("")).alias("meta_description"),
        F.coalesce(F.col("meta_keywords"), F.array().cast("array<string>")).alias("meta_keywords"),
        U.netloc(F.col("url")).alias("source_domain"),
        word_count(content).alias("word_count"),
        (summary if summary is not None else F.lit(None).cast("string")).alias("summary"),
        (topics if topics is not None else F.array().cast("array<string>")).alias("topics"),
        *[F.col(k) for k in keep],
    )


def one_per_id(arts: DataFrame, order: str = "page_id") -> DataFrame:
    """One article per id (= trimmed URL): the copy with the smallest ``order`` wins.

    ``min_by`` is combined map-side, so a URL crawled very many times costs one
    row per map task in the shuffle, not all of its copies in one task.
    """
    cols = [c for c in arts.columns if c != "id"]
    return arts.groupBy("id").agg(F.min_by(F.struct(*cols), F.col(order)).alias("_a")).select("id", "_a.*")


def ingest_outcome(pages: DataFrame) -> DataFrame:
    """Attempted vs kept pages of a run (one row, partial aggregates only)."""
    html = F.col("html")
    kept = U.prefix_valid(F.col("url")) & (H.title(html) != "") & (H.body_text(html) != "")
    return pages.agg(
        F.count(F.lit(1)).cast("bigint").alias("attempted"),
        F.count_if(kept).cast("bigint").alias("kept"),
    ).withColumn("dropped", F.col("attempted") - F.col("kept"))


def ordered_outcome(listed: DataFrame, arts: DataFrame) -> DataFrame:
    """Each listed URL ``(pos, url)`` with its article, in input order; a dropped URL has none.

    ``arts`` has one article per id (see :func:`one_per_id`).  A URL that is listed
    twice is reported twice.
    """
    found = arts.select(F.col("id").alias("article_id"), "title")
    out = listed.withColumn("article_id", article_id(F.col("url"))).join(found, "article_id", "left")
    kept = F.col("title").isNotNull()
    return out.select("pos", "url", F.when(kept, F.col("article_id")).alias("article_id"), "title", kept.alias("kept")).orderBy("pos")


def page_links(pages: DataFrame) -> DataFrame:
    """Every ``<a href>`` of every page, with its position on the page."""
    return pages.select("page_id", "url", F.posexplode(H.hrefs(F.col("html"))).alias("pos", "href"))


def resolve_links(links: DataFrame) -> DataFrame:
    """Absolute link of each href against its page URL."""
    return links.withColumn("link", U.resolve(F.col("url"), F.col("href")))


def same_domain_links(links: DataFrame) -> DataFrame:
    """Keep links whose network location equals the page's."""
    return links.where(U.netloc(F.col("link")) == U.netloc(F.col("url")))


def article_links(links: DataFrame, key: str = "page_id", same_domain_only: bool = True) -> DataFrame:
    """Resolved, optionally same-domain, article-shaped, distinct per page.

    Distinct keeps the first position of each link (partial ``min`` per
    (page, link) before the shuffle, so a page with a huge link list only
    ships its distinct links).
    """
    resolved = computed(links, link=U.resolve(F.col("url"), F.col("href")))
    resolved = computed(resolved, _lp=U.parse(F.col("link")), _page_host=U.netloc(F.col("url")))
    if same_domain_only:
        resolved = resolved.where(F.col("_lp.netloc") == F.col("_page_host"))
    return (
        resolved.where(U.is_article_path(F.col("_lp.path")))
        .groupBy(key, "link")
        .agg(F.min("pos").alias("first_pos"), F.count(F.lit(1)).alias("n_refs"))
    )
