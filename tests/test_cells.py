"""Approximate search against the exact one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from folio.operators import cells, retrieval as Q
from folio.session import work_dir

MIDDLE = "/root/testdata/sf0.01"


def _hits(df):
    return {(r.qid, r.id) for r in df.select("qid", "id").collect()}


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.read.parquet(f"{MIDDLE}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding", "label")


@pytest.fixture(scope="module")
def index(spark, vectors):
    return cells.build_cells(vectors, work_dir(spark, "test-cells"))


def test_recall_on_all_vectors(vectors, index):
    queries = vectors.select(F.col("id").alias("qid"), "embedding")
    exact = _hits(Q.knn(vectors, queries, k=10))
    probes = index.probes_for(queries, 10, 0.95)
    got = _hits(index.search(queries, 10, probes))
    assert 1 < index.cells and probes < index.cells
    assert len(got & exact) >= 0.9 * len(exact)


@pytest.mark.parametrize("where", [None, {"label": {"$in": [1, 2]}}])
def test_all_cells_give_the_exact_result(vectors, index, where):
    queries = vectors.where("id % 7 = 0").select(F.col("id").alias("qid"), "embedding")
    got = sorted(map(tuple, index.search(queries, 6, None, where).collect()))
    assert got == sorted(map(tuple, Q.knn(vectors, queries, 6, where=where).collect()))


def test_clusters_need_few_probes(spark):
    """A cell with a third of all rows, split into parts; equal vectors; null and odd vectors."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(20, 8)) * 5
    rows = [(f"r{i}", (centres[0] if i < 900 else centres[i % 20] + 0.1 * rng.normal(size=8)).tolist()) for i in range(2700)]
    rows += [("same", rows[5][1]), ("null", None), ("nan", [float("nan")] * 8)]
    store = spark.createDataFrame(rows, "id string, embedding array<double>")
    queries = spark.createDataFrame([(i, rows[37 * i][1]) for i in range(70)] + [(900, None)], "qid long, embedding array<double>")
    cells.PART_ROWS, before = 200, cells.PART_ROWS
    try:
        index = cells.build_cells(store, work_dir(spark, "test-cells"), cells=20)
        assert index.parts.agg(F.max("parts")).first()[0] >= 4
        exact = _hits(Q.knn(store, queries, k=5))
        probes = index.probes_for(queries, 5, 0.95)
        got = _hits(index.search(queries, 5, probes))
    finally:
        cells.PART_ROWS = before
    assert probes <= 4 and len(got & exact) >= 0.9 * len(exact)
    assert not any(i in ("null", "nan") for _, i in got)
    again = cells.CellIndex(spark, index.path)
    assert _hits(again.search(queries, 5, 20)) == exact


def test_cosine_cells_and_an_empty_store(spark):
    rng = np.random.default_rng(9)
    rows = [(i, (rng.normal(size=4) * (1 + i % 9)).tolist()) for i in range(300)] + [(300, [0.0] * 4)]
    store = spark.createDataFrame(rows, "id long, embedding array<double>")
    queries = spark.createDataFrame([(i, rows[i][1]) for i in range(9)], "qid long, embedding array<double>")
    index = cells.build_cells(store, work_dir(spark, "test-cells"), metric="cosine")
    assert _hits(index.search(queries, 4)) == _hits(Q.knn(store, queries, 4, "cosine"))
    empty = cells.build_cells(store.limit(0), work_dir(spark, "test-cells"))
    assert empty.search(queries, 3).count() == 0
    with pytest.raises(ValueError):
        cells.build_cells(store, work_dir(spark, "test-cells"), metric="ip")


def test_large_query_sets_stay_off_the_driver(spark, vectors):
    """Beyond the broadcast bound, tiles meet by a shuffle; the result is the same."""
    queries = vectors.select(F.col("id").alias("qid"), "embedding")
    small = sorted(map(tuple, Q.knn(vectors, queries, 7).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        df = Q.knn(vectors, queries, 7, max_query_bytes=20_000)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan and "Cartesian" not in plan
        assert sorted(map(tuple, df.collect())) == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pairs_of_groups_follow_the_cores(spark, vectors, monkeypatch):
    """Copies of tiles do not grow with the shuffle partitions, and a large store only gets more groups of its own."""
    from folio.operators import retrieval as R
    queries = vectors.select(F.col("id").alias("qid"), "embedding")
    cores = spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.shuffle.partitions", "1000")
    try:
        a, b = R._groups(spark, 1000)
        assert a * b <= 2 * R.TASKS_PER_CORE * cores + 4 and max(a, b) <= (R.TASKS_PER_CORE * cores) ** 0.5 + 1
        assert R._groups(spark, 100 * R.STORE_GROUP_BYTES)[0] == 100
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    want = sorted(map(tuple, Q.knn(vectors, queries, 7).collect()))
    monkeypatch.setattr(R, "STORE_GROUP_BYTES", 20_000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        assert sorted(map(tuple, Q.knn(vectors, queries, 7, max_query_bytes=20_000).collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_kept_hits_hold_no_batches():
    """The hits of a query tile are handed on when its pairs are over, and do not keep the tile's batch in memory."""

    import pyarrow as pa

    from folio.operators import tiles
    rng, seen = np.random.default_rng(3), []

    def batches():
        for t in range(6):
            for s in range(2):
                q, v = rng.normal(size=(4, 3)), rng.normal(size=(5, 3))
                lists = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x))
                yield pa.RecordBatch.from_arrays([pa.array([t]), lists(np.arange(4) + 4 * t), pa.array([q.tobytes()]), lists(np.arange(5) + 5 * s), pa.array([v.tobytes()])],
                                                 names=["q_tile", "q_ids", "q_vecs", "ids", "vecs"])
            seen.append(t)
    got = []
    for b in tiles._search(2, "l2sq", False, True)(batches()):
        got.append((len(seen), sorted(set(b.column(0).to_pylist()))))
    assert [g[1] for g in got] == [list(range(4 * t, 4 * t + 4)) for t in range(6)]
    assert [g[0] for g in got] == [1, 2, 3, 4, 5, 6]      # each before the tile after the next is read


def test_tiles_of_floats_take_half_the_bytes_of_doubles(spark):
    """What goes through the shuffle is as wide as the given components; distances are the same."""
    from folio.operators import tiles
    rng = np.random.default_rng(5)
    rows = [(0, i, v.tolist()) for i, v in enumerate(rng.normal(size=(40, 16)).astype(np.float32))] + [(0, 99, [float("nan")] * 16)]
    got = {}
    for kind, size in (("float", 4), ("double", 8)):
        made = tiles.packed(spark.createDataFrame(rows, f"cell long, id long, vec array<{kind}>").coalesce(1), 1 << 20).collect()
        assert sum(len(r.vecs) for r in made) <= size * 16 * 41 + len(made)
        got[kind] = np.concatenate([tiles.to_matrix(bytes(r.vecs), len(r.ids)) for r in made])
    assert np.array_equal(got["float"], got["double"], equal_nan=True) and got["float"].dtype == np.float64


def test_pairs_of_groups_do_not_follow_the_shuffle_partitions(spark):
    """A session that raises its partitions with the input does not get more copies of each tile."""
    from folio.operators import retrieval as R
    found = set()
    try:
        for partitions in ("2", "8", "1000"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            found.add(R._groups(spark, 1000))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(found) == 1
