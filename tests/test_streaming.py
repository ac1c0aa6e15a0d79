import os

import pytest
from pyspark.sql import functions as F

from folio.operators import pages as P
from folio.operators.chunking import store_records
from folio.session import work_dir
from folio.streaming.ingest import RECORD_COLUMNS, run_ingest

SMALL = "/root/testdata/sf0.001"


def test_stream_equals_batch_over_several_files(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    folder = work_dir(spark, "test-pages")
    # three files arrive one after another, the second one twice (a re-crawl)
    for i, part in enumerate([pages.where("page_id % 3 = 0"), pages.where("page_id % 3 = 1"), pages.where("page_id % 3 = 2")]):
        part.coalesce(1).write.mode("append").parquet(folder)
    store_root = work_dir(spark, "test-stream-store")
    store = run_ingest(spark, folder, store_root, max_tokens=60, files_per_trigger=1)   # three micro-batches
    first = store.df().select(*RECORD_COLUMNS)
    first_count = first.count()
    pages.where("page_id % 3 = 1").coalesce(1).write.mode("append").parquet(folder)
    store = run_ingest(spark, folder, store_root, max_tokens=60, files_per_trigger=1)
    streamed = store.df().select(*RECORD_COLUMNS)
    fields = P.drop_incomplete(P.page_fields(P.fetchable(pages)))
    arts = P.one_per_id(P.assemble(fields, F.current_timestamp().cast("timestamp_ntz"), keep=("page_id",)))
    batch = store_records(arts, max_tokens=60)
    key = ["id", "document"]
    assert sorted(map(tuple, streamed.select(*key).collect())) == sorted(map(tuple, batch.select(*key).collect()))
    assert streamed.count() == first_count      # the re-crawled file added nothing
    assert os.path.basename(store_root)


def test_least_page_wins_whatever_the_batches(spark):
    """Each URL is crawled three times; the files arrive in two different orders."""
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").limit(20)
    n = F.lit(1000)
    crawls = [pages.withColumn("page_id", F.col("page_id") + k * n).withColumn("html", F.regexp_replace("html", "</title>", f" crawl {k}</title>")) for k in range(3)]
    results = []
    for order in ((2, 0, 1), (1, 2, 0)):
        folder = work_dir(spark, "test-orders")
        for k in order:
            crawls[k].coalesce(1).write.mode("append").parquet(folder)
        store = run_ingest(spark, folder, work_dir(spark, "test-order-store"), max_tokens=60, files_per_trigger=1)
        results.append(sorted((r.id, r.page_id, r.title, r.document) for r in store.df().collect()))
    fields = P.drop_incomplete(P.page_fields(P.fetchable(crawls[0].unionByName(crawls[1]).unionByName(crawls[2]))))
    batch = store_records(P.one_per_id(P.assemble(fields, F.lit(None).cast("timestamp_ntz"), keep=("page_id",))), max_tokens=60)
    want = sorted((r.id, r.page_id, r.title, r.document) for r in batch.collect())
    assert results == [want, want] and len(want) >= 20


def test_replies_arrive_late_or_never(spark):
    """Replies in time, in the wrong order, twice, too late and not at all; over several runs of one stream."""
    from datetime import datetime, timedelta

    from folio.operators.enrich import FAILED, FAILED_PART
    from folio.sources.store import open_store
    from folio.streaming.replies import REPLY_SCHEMA, REQUEST_SCHEMA, run_replies

    at = lambda m: datetime(2025, 1, 1) + timedelta(minutes=m)
    root = work_dir(spark, "test-replies")
    store = open_store(spark, f"{root}/store")
    store.append(spark.createDataFrame([(f"{a}_chunk_{c}", a, c, "text", None, []) for a in "abcde" for c in range(2)],
                                       "id string, article_id string, chunk_index int, document string, summary string, topics array<string>"))
    body = lambda s, *t: '{"summary": "%s", "topics": [%s]}' % (s, ", ".join(f'"{x}"' for x in t))

    def arrive(requests, replies):
        for name, rows, schema in (("requests", requests, REQUEST_SCHEMA), ("replies", replies, REPLY_SCHEMA)):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/{name}")
        run_replies(store, f"{root}/requests", f"{root}/replies", f"{root}/run", "10 minutes", "1 minute", files_per_trigger=1)
        return {r.article_id: (r.summary, r.topics) for r in store.df().where("chunk_index = 0").collect()}

    first = arrive([("a", 1, 1, "single", at(0)), ("b", 1, 2, "parts", at(0)), ("b", 2, 2, "parts", at(0)), ("c", 1, 1, "single", at(1)), ("gone", 1, 1, "single", at(1))],
                   [("a", 1, body("sum a", "x"), at(2)), ("b", 2, body("two", "Y", "z"), at(2)), ("gone", 1, body("g"), at(2))])
    assert first["a"] == ("sum a", ["x"]) and first["b"] == (None, []) and first["c"] == (None, [])
    second = arrive([("d", 1, 2, "parts", at(5)), ("d", 2, 2, "parts", at(5))],
                    [("b", 1, body("one", "y"), at(6)), ("a", 1, body("again", "q"), at(7)), ("d", 1, body("d1", "t"), at(6))])
    assert second["a"] == ("sum a", ["x"]) and second["b"] == ("one two", ["y", "z"]) and second["d"] == (None, [])
    arrive([("e", 1, 1, "single", at(60))], [("e", 1, body("sum e"), at(61)), ("c", 1, body("too late"), at(59))])
    last = arrive([("f", 1, 1, "single", at(120))], [("f", 1, body("f"), at(121))])   # moves the watermarks
    assert last["c"] == (FAILED, []) and last["e"] == ("sum e", [])
    assert last["d"] == ("d1 " + FAILED_PART.replace("{}", "2"), ["t"])
    assert store.df().where("summary is null").count() == 0 and store.df().count() == 10
    assert sorted({r.epoch for r in spark.read.parquet(f"{root}/run/settled").collect()})[0] == 0


@pytest.mark.parametrize("files", [1, 3])
def test_streams_read_tables_of_one_or_many_files(spark, tmp_path, files):
    """A table may be a folder of part files or one file; a stream reads it whole either way."""
    from folio.plans import catalog
    spark.read.parquet(f"{SMALL}/pages.parquet").limit(9).repartition(files).write.parquet(f"{tmp_path}/pages.parquet")
    spark.read.parquet(f"{SMALL}/conversations.parquet").where("conv_id < 6").repartition(files).write.parquet(f"{tmp_path}/conversations.parquet")
    spark.read.parquet(f"{SMALL}/embeddings.parquet").limit(50).write.parquet(f"{tmp_path}/embeddings.parquet")
    if files == 1:
        for t in ("pages", "conversations"):
            (part,) = (tmp_path / f"{t}.parquet").glob("part-*.parquet")
            (tmp_path / f"{t}.parquet").rename(tmp_path / f"{t}-folder")
            (tmp_path / f"{t}-folder" / part.name).rename(tmp_path / f"{t}.parquet")
    pages = spark.read.parquet(f"{tmp_path}/pages.parquet")
    fields = P.drop_incomplete(P.page_fields(P.fetchable(pages)))
    arts = P.one_per_id(P.assemble(fields, F.current_timestamp().cast("timestamp_ntz"), keep=("page_id",)))
    want = store_records(arts, max_tokens=catalog.STORE_TEST_MAX_TOKENS).select("id").collect()
    assert want and sorted(r.id for r in catalog.stream_ingest(spark, str(tmp_path)).collect()) == sorted(r.id for r in want)
    asked = {(r.qid, r.rank, r.id) for r in catalog.batch_questions(spark, str(tmp_path)).collect()}
    assert asked and {(r.qid, r.rank, r.id) for r in catalog.stream_questions(spark, str(tmp_path)).collect()} == asked
