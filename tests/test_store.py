"""The written store: versions, concurrent writers, touched files, lookups, counts of writes."""

import pytest
from pyspark.sql import functions as F

from folio.operators.chunking import store_records
from folio.session import work_dir
from folio.sources.store import ChunkStore, LostRace, open_store

SCHEMA = "id string, article_id string, chunk_index int, document string"


def _articles(spark, numbers, text="x"):
    return spark.createDataFrame([(f"a{i}_chunk_{c}", f"a{i}", c, f"{text}{i}.{c}") for i in numbers for c in range(2)], SCHEMA)


def _ids(store):
    return sorted(r.id for r in store.df().collect())


@pytest.fixture()
def store(spark):
    st = open_store(spark, work_dir(spark, "test-store"), buckets=16)
    assert st.append(_articles(spark, range(100))) == 200
    return st


def test_delete_touches_only_files_with_a_match(spark, store):
    before = set(store.files())
    store.delete(spark.createDataFrame([("a7_chunk_1",), ("none_chunk_0",)], "id string"))
    after = set(store.files())
    assert len(before) >= 10 and len(before - after) == 1 and len(after - before) == 1
    assert (before - after).pop().split("/")[2] == (after - before).pop().split("/")[2]          # the bucket
    assert _ids(store) == sorted(f"a{i}_chunk_{c}" for i in range(100) for c in range(2) if (i, c) != (7, 1))
    n = store.current_snapshot()
    store.delete(spark.createDataFrame([("absent",)], "article_id string"), by="article_id")
    assert store.current_snapshot() == n and set(store.files()) == after                           # nothing to do, no version


def test_upsert_replaces_whole_articles(spark, store):
    before = set(store.files())
    assert store.upsert(_articles(spark, [3, 200], "new")) == 4
    docs = {r.id: r.document for r in store.df().collect()}
    assert len(docs) == 202 and docs["a3_chunk_0"] == "new3.0" and docs["a200_chunk_1"] == "new200.1" and docs["a4_chunk_0"] == "x4.0"
    assert len(before - set(store.files())) == 1


def test_least_version_wins_in_any_order(spark):
    versions = [(5, "e"), (2, "b"), (9, "i"), (2, "b"), (3, "c")]
    st = open_store(spark, work_dir(spark, "test-least"))
    for n, text in versions:
        st.upsert(spark.createDataFrame([("a", "a", 0, text, n)], SCHEMA + ", page_id int"), least="page_id")
    assert [(r.document, r.page_id) for r in st.df().collect()] == [("b", 2)]


def test_two_writers_never_both_win(spark, store):
    """The second writer claims the version that the first one is about to claim."""
    other = open_store(spark, store.root)
    claim, raced = store._claim, []

    def slow_claim(n, manifest):
        if not raced:
            raced.append(n)
            other.append(_articles(spark, [500]))
        return claim(n, manifest)

    store._claim = slow_claim
    start = store.current_snapshot()
    store.append(_articles(spark, [500, 501]))
    assert store.current_snapshot() == start + 2
    assert len(_ids(store)) == len(set(_ids(store))) == 204                                       # a500 is there once
    store._claim = lambda n, manifest: False
    with pytest.raises(LostRace):
        store.delete(spark.createDataFrame([("a1_chunk_0",)], "id string"))
    assert len(_ids(other)) == 204


def test_old_readers_keep_their_version(spark, store):
    old = store.df()
    store.delete(spark.createDataFrame([(f"a{i}",) for i in range(50)], "article_id string"), by="article_id")
    store.reset()
    assert old.count() == 200 and store.df().count() == 0 and "document" in store.df().columns
    assert store.append(_articles(spark, [1])) == 2


def test_lookups_read_the_files_of_their_buckets(spark, store):
    ids = spark.createDataFrame([("a7_chunk_0",), ("zzz",), (None,)], "id string")
    got = store.get(ids)
    assert [r.document for r in got.collect()] == ["x7.0"]
    assert len(got.inputFiles()) <= 2 < len(store.files())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "In(id" in plan.replace("EqualTo(id", "In(id")             # reaches Parquet
    assert {r.id: r.exists for r in store.exists(ids).collect()} == {"a7_chunk_0": True, "zzz": False, None: False}
    many = spark.range(3000).select(F.concat(F.lit("a"), F.col("id"), F.lit("_chunk_1")).alias("id"))
    assert store.get(many).count() == 100 and store.exists(many).where("exists").count() == 100


def test_compact_joins_small_files(spark):
    st = open_store(spark, work_dir(spark, "test-compact"), buckets=2)
    for i in range(5):
        st.append(_articles(spark, range(10 * i, 10 * i + 10)))
    before = _ids(st)
    assert len(st.files()) >= 10 and st.compact(5) == 2
    assert len(st.files()) <= 4 and _ids(st) == before and st.compact(5) == 0


def test_counts_come_from_the_write(spark):
    cols = "id string, url string, title string, content string, authors array<string>, publish_date timestamp_ntz, scraped_at timestamp_ntz, top_image string, " \
           "meta_description string, meta_keywords array<string>, source_domain string, word_count int, summary string, topics array<string>"
    row = lambda i, title, content: (i, f"https://x.org/{i}", title, content, [], None, None, None, "", [], "x.org", 1, None, [])
    arts = spark.createDataFrame([row("a", "t", "some words here. " * 30), row("b", "t", "more"), row("c", "", "no title"), row("d", "t", None)], cols)
    st = open_store(spark, work_dir(spark, "test-counts"))
    assert tuple(st.store_articles(arts, 20).first()) == (2, 2)
    assert sorted(r.id for r in st.failed_articles().collect()) == ["c", "d"]
    assert st.df().select("article_id").distinct().count() == 2 < st.df().count()
    assert tuple(st.store_articles(arts.where("id in ('a', 'c')"), 20).first()) == (1, 1)         # a is stored already
    assert tuple(st.store_articles(arts.limit(0), 20).first()) == (0, 0)
    assert st.df().select("article_id").distinct().count() == 2


def test_buckets_are_fixed_by_the_first_version(spark, store):
    again = ChunkStore(spark, store.root, buckets=3)
    assert again.append(_articles(spark, range(100))) == 0 and again.buckets == 16


def test_store_holds_each_text_once_and_does_not_shuffle_records(spark):
    """Records of a long article hold its parts, not the whole text in each; appended in another order of buckets than before."""
    cols = "id string, title string, content string, lang string"
    text = lambda i, n: " ".join(f"word{i}x{j}." for j in range(n))
    arts = spark.createDataFrame([(f"k{i}", "title", text(i, 300), "en") for i in range(40)] + [(None, "title", "no id", "en")], cols)
    st = open_store(spark, work_dir(spark, "test-whole-texts"), buckets=8)
    first = st.append_articles(arts.where("id < 'k2' or id is null"), 40)
    assert "content" not in st.df().columns and first == st.df().count()
    assert st.append_articles(arts.where("id is not null"), 40) == st.df().count() - first > 0
    assert st.append_articles(arts.where("id is not null"), 40) == 0
    want = {(r.id, r.document) for r in store_records(arts, max_tokens=40).collect()}
    assert {(r.id, r.document) for r in st.df().collect()} == want and st.df().count() == len(want)
    assert {r.bucket for r in st.df().select("article_id", "bucket").distinct().collect()} == set(range(8))
    assert st.df().where(st._bucket(F.col("article_id")) != F.col("bucket")).count() == 0


def test_rewrites_meet_their_keys_in_portions(spark, store, monkeypatch):
    """As many keys at a time as fit; a bucket with more than that by a join of Spark's choice."""
    for most in (1, 1200):
        monkeypatch.setattr("folio.sources.store.KEY_BYTES", most)
        st = open_store(spark, work_dir(spark, "test-portions"), buckets=16)
        st.append(_articles(spark, range(100)))
        gone = spark.range(0, 100, 3).select(F.concat(F.lit("a"), F.col("id").cast("string")).alias("article_id"))
        before = {(r.id, r.article_id) for r in st.df().collect()}
        drop = {r.article_id for r in gone.collect()}
        st.delete(gone, by="article_id")
        assert {(r.id, r.article_id) for r in st.df().collect()} == {x for x in before if x[1] not in drop}
        assert st.df().where(st._bucket(F.col("article_id")) != F.col("bucket")).count() == 0
        asked = st.df().select("id")
        assert st.get(asked).count() == st.df().count()


def test_vacuum_removes_what_only_earlier_versions_name(spark, store):
    store.append(_articles(spark, range(200, 230)))
    before = set(store.files())
    store.delete(spark.createDataFrame([("a200",)], "article_id string"), by="article_id")
    rows, gone = _ids(store), len(before - set(store.files()))
    assert gone and store.vacuum() == gone and _ids(store) == rows
    store.append(_articles(spark, range(300, 303)))
    assert len(_ids(store)) > len(rows)


ARTICLES = "id string, title string, content string"


def _long_titled(n, title="a long title. " * 200):
    return [(i, title, " ".join(f"w{i}x{j}" for j in range(n)) + ".") for i in ("p", "q", None)] + [("short", "t", "few words"), ("none", "t", None)]


def test_chunks_of_an_article_are_one_row_of_a_file(spark):
    """A title of any length is stored once an article, not once a chunk; the records are the same."""
    arts = spark.createDataFrame(_long_titled(120), ARTICLES)
    st = open_store(spark, work_dir(spark, "test-packed"), buckets=4)
    want = sorted((r.id or "", r.article_id or "", r.chunk_index, r.total_chunks, r.title, r.document) for r in store_records(arts, max_tokens=60).collect())
    assert len(want) > 300 and st.append_articles(arts, 60) == len(want)
    files = [f"{st.root}/{f}" for f in st.files()]
    assert spark.read.parquet(*files).count() == 5                                                # one row an article with records
    assert sorted((r.id or "", r.article_id or "", r.chunk_index, r.total_chunks, r.title, r.document) for r in st.df().collect()) == want
    assert tuple(st.count().first()) == (len(want), 4)                                            # a null id is no article
    assert st.append_articles(arts.where("id is not null"), 60) == 0


def test_list_is_in_order_whatever_the_ids(spark):
    """Chunk ids in the order of text, articles that lie between the chunks of others, and repeated ones."""
    rows = [r for r in _long_titled(30, "t") if r[2]]
    rows += [(i, "t", " ".join(f"z{j}" for j in range(30)) + ".") for i in ("p", "p_chunk_1a", "p_chunk_1", "p_b", "p_chunk", "pa")]
    st = open_store(spark, work_dir(spark, "test-list"), buckets=4)
    st.append_articles(spark.createDataFrame(rows, ARTICLES), 13)
    st.append(st.df().limit(1).drop("bucket").withColumn("article_id", F.lit("p_c")).withColumn("id", F.lit("p_chunk_15")))
    key = lambda x: (x is not None, (x or "").encode())
    ids = [r.id for r in st.list().collect()]
    assert len(ids) == st.df().count() > 100 and ids == sorted((r.id for r in st.df().collect()), key=key)
    assert [(r.id, r.title) for r in st.list(columns=["id", "title"]).collect()] == [(i, "t") for i in ids]
    assert [r.id for r in st.list(limit=40).collect()] == ids[:40]
    plan = st.list(columns=["id", "title"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Exchange rangepartitioning")                     # records are made after the shuffle


def test_chunks_of_packed_rows_are_found_and_deleted(spark, monkeypatch):
    arts = spark.createDataFrame([r for r in _long_titled(30, "t")], ARTICLES)
    st = open_store(spark, work_dir(spark, "test-parts"), buckets=4)
    st.append_articles(arts, 13)
    every = {r.id: r.document for r in st.df().where("id is not null").collect()}
    ids = lambda names: spark.createDataFrame([(n,) for n in names], "id string")
    asked = ["p_chunk_1", "p_chunk_10", "p_chunk_10", "p_chunk_01", "p", "q_chunk_9999999999", "short", None]
    for most in (1 << 23, 1):
        monkeypatch.setattr("folio.sources.store.KEY_BYTES", most)
        for few in (1000, 2):
            monkeypatch.setattr("folio.sources.store.LOOKUP_IDS", few)
            assert sorted((r.id, r.document) for r in st.get(ids(asked)).collect()) == [(i, every[i]) for i in ("p_chunk_1", "p_chunk_10", "short")]
            assert {r.id for r in st.exists(ids(asked)).where("exists").collect()} == {"p_chunk_1", "p_chunk_10", "short"}
    gone = {"short", *(i for i in every if i.startswith("q_chunk_")), "p_chunk_1"}
    nulls = st.df().where("id is null").count()
    st.delete(ids([*gone, "p_chunk_01", None]))
    assert {r.id: r.document for r in st.df().where("id is not null").collect()} == {i: d for i, d in every.items() if i not in gone}
    assert st.df().where("id is null").count() == nulls > 0
    st.annotate(spark.createDataFrame([("p", "other")], "article_id string, title string"))
    assert {r.title for r in st.df().where("article_id = 'p'").collect()} == {"other"}
    assert {r.id: r.document for r in st.df().where("article_id = 'p'").collect()} == {i: d for i, d in every.items() if i[0] == "p" and i not in gone}
    st.delete(spark.createDataFrame([("p",)], "article_id string"), by="article_id")
    assert [r.id for r in st.df().where("id is not null").collect()] == ["none"] and st.count().first().records == nulls + 1
