import numpy as np
import pytest
from pyspark.sql import functions as F

from folio.operators import pages as P
from folio.operators import retrieval as Q
from folio.operators import store as S
from folio.operators.reports import email_audit
from folio.operators.numbering import group_row_number
from folio.session import work_dir
from folio.sources.store import ChunkStore

SCHEMA = "id string, article_id string, chunk_index int, document string"


def test_store_snapshots(spark):
    root = work_dir(spark, "test-store")
    st = ChunkStore(spark, root)
    batch = spark.createDataFrame([("a", "a", 0, "x"), ("b_chunk_0", "b", 0, "y"), ("b_chunk_1", "b", 1, "z")], SCHEMA)
    assert st.append(batch) == 3
    changed = spark.createDataFrame([("a", "a", 0, "NEW"), ("c", "c", 0, "w")], SCHEMA)
    assert st.append(changed) == 1
    assert st.append(changed) == 0          # replay adds nothing
    assert st.df().count() == 4
    docs = {r.id: r.document for r in st.df().collect()}
    assert docs["a"] == "x"                 # existing id ignored, not replaced
    st.delete(spark.createDataFrame([("b",)], "article_id string"), by="article_id")
    assert sorted(r.id for r in st.df().collect()) == ["a", "c"]
    ex = {r.id: r.exists for r in S.exists(spark.createDataFrame([("a",), ("b_chunk_0",)], "id string"), st.df()).collect()}
    assert ex == {"a": True, "b_chunk_0": False}
    st.reset()
    assert st.df().count() == 0 and "document" in st.df().columns


def test_store_keeps_articles_whole(spark):
    st = ChunkStore(spark, work_dir(spark, "test-versions"))
    chunks = lambda n, text: spark.createDataFrame([(f"a_chunk_{i}", "a", i, text) for i in range(n)], SCHEMA)
    assert st.append(chunks(2, "old")) == 2
    assert st.append(chunks(4, "longer")) == 0      # a re-crawl with a longer text
    assert st.append(chunks(1, "shorter")) == 0
    assert sorted((r.id, r.document) for r in st.df().collect()) == [("a_chunk_0", "old"), ("a_chunk_1", "old")]


def test_store_lookups_read_few_folders(spark):
    st = ChunkStore(spark, work_dir(spark, "test-lookups"))
    st.append(spark.createDataFrame([(f"k{i}", f"k{i}", 0, str(i)) for i in range(200)], SCHEMA))
    ids = spark.createDataFrame([("k7",), ("k7_chunk_0",), ("none",)], "id string")
    assert [r.document for r in st.get(ids).collect()] == ["7"]
    assert {r.id: r.exists for r in st.exists(ids).collect()} == {"k7": True, "k7_chunk_0": False, "none": False}
    assert tuple(st.count().first()) == (200, 200) and len(st.list(5).collect()) == 5
    plan = st.get(ids)._jdf.queryExecution().toString()
    assert "PartitionFilters: [bucket" in plan or "PartitionFilters: [isnotnull(bucket" in plan


def test_store_without_versions_is_an_error(spark):
    root = work_dir(spark, "test-pointer")
    st = ChunkStore(spark, root, spark.createDataFrame([], SCHEMA).schema)
    assert not st.is_open() and st.df().count() == 0
    spark.createDataFrame([("a", "a", 0, "x")], SCHEMA).write.parquet(f"{root}/snapshots/0")
    with pytest.raises(ValueError):
        st.append(spark.createDataFrame([("b", "b", 0, "y")], SCHEMA))


def test_article_ids_keep_parameters(spark):
    urls = ["/story?123", "/story?456", "/story?source=a", "/story?ref=b", "/s;1", "/s;2"]
    df = spark.createDataFrame([("https://x.example.com" + u,) for u in urls] + [("  https://x.example.com/s;2 ",)], "url string")
    assert df.select(P.article_id(F.col("url"))).distinct().count() == 6


def test_email_audit_has_zero_rows(spark):
    docs = spark.createDataFrame([("a", "x@y.org and @ here"), ("b", "nothing"), ("b", None)], "source string, text string")
    assert sorted(map(tuple, email_audit(docs).collect())) == [("a", 2, 1, 1), ("b", 0, 0, 0)]


def test_knn_matches_numpy(spark):
    rng = np.random.default_rng(0)
    vecs = rng.normal(size=(300, 16)).astype(np.float32)
    vecs[10] = vecs[11]                     # an exact tie broken by id
    qv = rng.normal(size=(7, 16)).astype(np.float32)
    qv[0] = vecs[10]
    store = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(vecs)], "id long, embedding array<float>, label int")
    queries = spark.createDataFrame([(100 + j, q.tolist()) for j, q in enumerate(qv)], "qid long, embedding array<float>")
    for where, block in ((None, Q.MAX_QUERY_BYTES), ({"label": {"$in": [0, 2]}}, 200)):
        got = Q.knn(store, queries, k=5, where=where, max_query_bytes=block).collect()
        keep = np.array([True if where is None else (i % 3) in (0, 2) for i in range(len(vecs))])
        for j, q in enumerate(qv):
            d = ((vecs.astype(np.float64) - q.astype(np.float64)) ** 2).sum(axis=1)
            ids = [i for i in np.lexsort((np.arange(len(vecs)), d)) if keep[i]][:5]
            mine = sorted((r for r in got if r.qid == 100 + j), key=lambda r: r.rank)
            assert [r.id for r in mine] == ids
            assert np.allclose([r.distance for r in mine], d[ids])


def test_where_to_column(spark):
    df = spark.createDataFrame([(i, f"l{i % 4}") for i in range(20)], "n int, lang string")
    w = {"$and": [{"n": {"$gte": 5}}, {"$or": [{"lang": "l1"}, {"lang": {"$in": ["l2"]}}]}], "n": {"$ne": 9}}
    got = sorted(r.n for r in df.where(Q.where_to_column(w)).collect())
    assert got == [n for n in range(20) if n >= 5 and f"l{n % 4}" in ("l1", "l2") and n != 9]


def test_group_row_number_skewed(spark):
    rows = [("hot", i) for i in range(5000)] + [(f"g{i % 37}", i) for i in range(800)]
    df = spark.createDataFrame(rows, "g string, o long")
    got = group_row_number(df, "g", "o", out="rn", num_partitions=8)
    assert got.rdd.getNumPartitions() >= 1
    res = {(r.g, r.o): r.rn for r in got.collect()}
    want = {}
    for g in {g for g, _ in rows}:
        for n, o in enumerate(sorted(o for gg, o in rows if gg == g), start=1):
            want[(g, o)] = n
    assert res == want


def test_one_per_id_hot_key(spark):
    from folio.operators.pages import one_per_id
    rows = [("hot", 1000 - i, f"copy{i}") for i in range(3000)] + [(f"k{i}", i, "solo") for i in range(50)]
    df = spark.createDataFrame(rows, "id string, page_id long, content string").repartition(8)
    out = {r.id: (r.page_id, r.content) for r in one_per_id(df).collect()}
    assert len(out) == 51
    assert out["hot"] == (-1999, "copy2999")
    assert out["k7"] == (7, "solo")


def test_knn_blocks_with_repeated_query_ids(spark):
    rng = np.random.default_rng(1)
    vecs = rng.normal(size=(50, 4)).astype(np.float32)
    store = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "id long, embedding array<float>")
    qs = [(7, vecs[3].tolist()), (7, vecs[3].tolist()), (8, vecs[9].tolist())]
    queries = spark.createDataFrame(qs, "qid long, embedding array<float>")
    got = Q.knn(store, queries, k=3, max_query_bytes=8).collect()   # one query per block at most
    by_q = {}
    for r in got:
        by_q.setdefault(r.qid, []).append(r)
    assert sorted(by_q) == [7, 8]
    assert all(len(v) == 3 for v in by_q.values())
    assert min(by_q[7], key=lambda r: r.rank).id == 3 and min(by_q[8], key=lambda r: r.rank).id == 9


def test_knn_zero_and_null_vectors(spark):
    store = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(3)] + [(10 + i, [0.0, 0.0]) for i in range(8)], "id long, embedding array<double>")
    qs = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "qid long, embedding array<double>")
    hits = Q.knn(store, qs, k=10, metric="cosine").orderBy("rank").collect()
    assert [(r.qid, r.id) for r in hits] == [(1, 0), (1, 1), (1, 2)]
    assert Q.knn(store, qs.where("qid = 2"), k=3).count() == 0


def test_filters_keep_missing_values(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "lang string")
    assert df.where(Q.where_to_column({"lang": {"$ne": "a"}})).count() == 2
    assert df.where(Q.where_to_column({"lang": {"$nin": ["a"]}})).count() == 2
    assert df.where(Q.where_to_column({})).count() == 3


def test_row_numbers_with_payload_and_a_large_group(spark):
    from folio.operators.numbering import group_row_number
    df = spark.range(300_000).selectExpr("id", "if(id % 3 = 0, 'hot', concat('g', id % 97)) g", "sha2(cast(id as string), 256) payload")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        out = group_row_number(df, "g", "id")
        bad = out.selectExpr("rn", "row_number() over (partition by g order by id) want").where("rn != want").count()
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")
    assert bad == 0 and out.count() == 300_000
