"""Inputs that Spark derives from the given tables for the registered queries.

The driver's tables hold crawl pages, documents, conversations, vectors and
orders.  Some operators need shapes the tables do not carry directly (URL
list lines with bad entries, article-style links, model replies); they are
derived here with plain column expressions, so their size grows with the
tables.  Every derivation has a twin in :mod:`folio.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions.text import first_line
from folio.operators import pages as P

RUN_START = "2025-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def url_lines(pages: DataFrame) -> DataFrame:
    """A URL-list file made from the page URLs: each URL as is, indented,
    with trailing blanks, with an upper-case scheme, a location-less variant
    and a commented-out copy (six lines per page, numbered in order)."""
    v = F.col("v")
    url = F.col("url")
    value = (
        F.when(v == 0, url)
        .when(v == 1, F.concat(F.lit("  "), url))
        .when(v == 2, F.concat(url, F.lit(" \t")))
        .when(v == 3, F.concat(F.lit("HTTP"), F.substring(url, 5, 1 << 20)))
        .when(v == 4, F.concat(F.lit("http:///p"), F.col("page_id").cast("string")))
        .otherwise(F.concat(F.lit("# "), url))
    )
    return pages.select("page_id", "url", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("v")).select(
        (F.col("page_id") * 6 + v).alias("line_no"), value.alias("value")
    )


def url_files(pages: DataFrame, path: str, files: int = 8) -> str:
    """The URL-list lines written as text files under ``path``, their order that of ``line_no``."""
    lines = url_lines(pages).repartitionByRange(files, "line_no").sortWithinPartitions("line_no")
    lines.select("value").write.text(path)
    return path


def hub_links(orders: DataFrame) -> DataFrame:
    """Link lists of customer hub pages, one link per order, position = order key."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    host = F.concat(F.lit("n"), (c % 25).cast("string"), F.lit(".example.com"))
    section = F.when(k % 5 == 0, F.lit("/category")).when(k % 7 == 0, F.lit("/Story")).otherwise(F.lit(""))
    path = F.concat(
        section, F.lit("/"), F.date_format("o_orderdate", "yyyy/MM"), F.lit("/"),
        F.lower("o_orderstatus"), F.lit("-"), (k % 4).cast("string"),
    )
    href = F.concat(
        F.when(k % 3 == 0, F.concat(F.lit("https://www."), host, path)).otherwise(path),
        F.when(k % 2 == 0, F.lit("#top")).otherwise(F.lit("")),
    )
    return orders.select(
        F.concat(F.lit("https://"), host, F.lit("/")).alias("url"),
        k.alias("pos"),
        href.alias("href"),
    )


def doc_fields(documents: DataFrame) -> DataFrame:
    """Documents as page fields: title = first line, text = whole text."""
    url = F.concat(
        F.lit("https://"), F.col("source"), F.lit(".example.com/"), F.col("lang"), F.lit("/news/"),
        F.col("doc_id").cast("string"),
    )
    return documents.select(
        "doc_id", "lang", "source",
        url.alias("url"),
        first_line(F.col("text")).alias("raw_title"),
        F.col("text").alias("raw_text"),
        F.array().cast("array<string>").alias("authors"),
        F.lit(None).cast("string").alias("top_image"),
        F.lit("").alias("meta_description"),
        F.array().cast("array<string>").alias("meta_keywords"),
    )


def scraped_at(doc_id: Column) -> Column:
    """Run time of each derived article: run start + 1.5 s per document id."""
    return F.lit(RUN_START).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (doc_id * F.lit(1.5)).cast("decimal(18,6)")
    )


def doc_articles(documents: DataFrame) -> DataFrame:
    """Articles from documents (A4 + A5), keeping ``doc_id``, ``lang`` and ``source``."""
    fields = P.drop_incomplete(doc_fields(documents)).withColumn("_sa", scraped_at(F.col("doc_id")))
    return P.assemble(fields, F.col("_sa"), keep=("doc_id", "lang", "source"))


def planted_body(doc_id: Column, part: Column, lang: Column, source: Column) -> Column:
    """A model reply per (document, part) with every parse case represented."""
    pid = F.concat(doc_id.cast("string"), F.lit("."), part.cast("string"))
    return (
        F.when(doc_id % 11 == 0, F.lit("not json"))
        .when(doc_id % 7 == 0, F.concat(F.lit('{"topics":["'), source, F.lit('"," x "]}')))
        .when(doc_id % 5 == 0, F.lit('{"summary":""}'))
        .when(doc_id % 13 == 0, F.concat(F.lit('{"summary":"s'), pid, F.lit('","topics":["'), lang, F.lit('",7]}')))
        .when(doc_id % 17 == 0, F.lit('{"summary":null,"topics":null}'))
        .when(doc_id % 19 == 0, F.concat(F.lit('{"summary":0,"topics":{"'), lang, F.lit('":1," k ":2}}')))
        .when(doc_id % 23 == 0, F.concat(F.lit('{"summary":"s'), pid, F.lit('","topics":"'), lang, F.lit(' x"}')))
        .otherwise(F.concat(
            F.lit('{"summary":"s'), pid, F.lit('","topics":[" '), lang, F.lit(' ","'), F.upper(lang),
            F.lit('","'), source, F.lit('","t'), (part % 3).cast("string"), F.lit('",""]}'),
        ))
    )


def merge_replies(articles: DataFrame) -> DataFrame:
    """Replies to merge requests: a text, an empty one, or none, in turn by document."""
    d = F.col("doc_id")
    body = F.when(d % 3 == 0, F.concat(F.lit(" whole "), d.cast("string"), F.lit("\n"))).otherwise(F.lit(""))
    return articles.where(d % 3 != 2).select(F.col("id").alias("request_id"), body.alias("body"))


def request_files(requests: DataFrame, path: str) -> str:
    """Model requests as files of a stream, all asked at the run's start; one more, hours later, moves the watermark."""
    at = F.lit(RUN_START).cast("timestamp")
    rows = requests.select("request_id", "part", "parts", "route", at.alias("requested_at"))
    last = requests.sparkSession.range(1).select(F.lit("last").alias("request_id"), F.lit(1).alias("part"), F.lit(1).alias("parts"), F.lit("single").alias("route"),
                                                 (at + F.expr("interval 3 hours")).alias("requested_at"))
    rows.unionByName(last).write.parquet(path)
    return path


def reply_files(replies: DataFrame, path: str) -> str:
    """Replies ``(request_id, part, doc_id, body)`` as files of a stream: some never come, some come too late."""
    at, d = F.lit(RUN_START).cast("timestamp"), F.col("doc_id")
    minutes = F.when(d % 31 == 0, F.expr("interval 40 minutes")).otherwise(F.expr("interval 2 minutes"))
    rows = replies.where(d % 29 != 0).select("request_id", "part", "body", (at + minutes).alias("replied_at"))
    last = replies.sparkSession.range(1).select(F.lit("last").alias("request_id"), F.lit(1).alias("part"), F.lit("{}").alias("body"),
                                                (at + F.expr("interval 3 hours")).alias("replied_at"))
    rows.unionByName(last).write.parquet(path)
    return path


def long_texts(conversations: DataFrame) -> DataFrame:
    """Conversation texts in turn order joined by a blank line, one row per conversation.

    A conversation is one text; its turns are sorted inside the group.
    """
    return conversations.groupBy("conv_id").agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), "\n\n"
        ).alias("content")
    )
