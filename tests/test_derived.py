from pyspark.sql import functions as F

from folio.operators import enrich as E
from folio.plans import derived as D

SMALL = "/root/testdata/sf0.001"


def test_derived_inputs_grow_with_tables(spark):
    pages = D.table(spark, SMALL, "pages")
    orders = D.table(spark, SMALL, "orders")
    assert D.url_lines(pages).count() == 6 * pages.count()
    assert D.hub_links(orders).count() == orders.count()
    docs = D.table(spark, SMALL, "documents")
    assert D.doc_articles(docs).count() <= docs.count()


def test_planted_replies_cover_every_parse_branch(spark):
    docs = spark.range(0, 2000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.lit("src1").alias("source"))
    bodies = docs.select("doc_id", D.planted_body(F.col("doc_id"), F.lit(1), F.col("lang"), F.col("source")).alias("body"))
    single = E.parse_single(bodies).select("ok", "summary").distinct().collect()
    part = E.parse_part(bodies.withColumn("part", F.lit(1))).select("ok").distinct().collect()
    assert {r.ok for r in single} == {True, False}
    assert {r.ok for r in part} == {True, False}
    assert E.NO_SUMMARY in {r.summary for r in single}
