"""The flagship slice: pages -> articles -> top keywords per article."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators import pages as P
from folio.operators.keywords import top_keywords
from folio.plans import derived as D


def article_keywords(spark: SparkSession, sf_dir: str, k: int = 5) -> DataFrame:
    pages = D.table(spark, sf_dir, "pages")
    fields = P.drop_incomplete(P.page_fields(P.fetchable(pages))).withColumn("_sa", D.scraped_at(F.col("page_id")))
    arts = P.assemble(fields, F.col("_sa"), keep=("page_id",))
    top = F.posexplode(top_keywords(F.col("content"), k)).alias("_r", "_kw")
    return arts.select("id", "page_id", "url", "title", "source_domain", "word_count", top).select(
        "id", "page_id", "url", "title", "source_domain", "word_count",
        (F.col("_r") + 1).cast("int").alias("rank"), F.col("_kw.word").alias("word"), F.col("_kw.freq").alias("freq"))
