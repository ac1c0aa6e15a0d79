"""Approximate nearest neighbours by an inverted index of cells.

Centres are fitted by k-means on a bounded sample of the vectors (``SAMPLE``
rows, by the least hashes of their ids); their number grows with the square
root of the rows, up to ``MAX_CELLS``.  Every vector is assigned to its nearest
centre and the index is written sorted by cell, so a search reads the row groups
of the cells it needs and a cell of very many rows lies in many files.

A search sends every query to its ``probes`` nearest cells.  The rows of a cell
and its queries become tiles, which meet by cell; a large cell is cut into
parts, and its queries go to each part.  What follows is the exact search of
:mod:`folio.operators.tiles`, so with all cells probed the result is that of
:func:`folio.operators.retrieval.knn`.  Metadata filters reach the index scan, and
only rows that pass are ranked.

How many probes a wished recall takes depends on the data:
:meth:`CellIndex.probes_for` measures it against the exact search on a bounded
sample of queries.
"""

from __future__ import annotations

import json
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators import retrieval, tiles

# executors need not have this package installed: ship its task code by value
cloudpickle.register_pickle_by_value(__import__(__name__, fromlist=["_"]))

# --- fixed values -----------------------------------------------------------
SAMPLE = 1 << 16          # rows that the centres are fitted on, at most
MAX_CELLS = 1 << 14       # bounds the centres that every task holds
ROUNDS = 10               # k-means iterations
PART_ROWS = 1 << 16       # rows of a cell that meet its queries in one place
FILTERED_CELLS = 1 << 10  # up to so many probed cells, the scan of the index is filtered by them
AUDIT = 256               # queries of the sample that the probes are measured on, at most
RECALL = 0.95
# ---------------------------------------------------------------------------


def _directions(v: np.ndarray, metric: str) -> np.ndarray:
    if metric != "cosine":
        return v
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(norm == 0, 1.0, norm)


def cell_order(vectors: np.ndarray, centres: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` nearest cells of each vector, nearest first (ties to the lower number)."""
    far = np.einsum("ij,ij->i", centres, centres)[None, :] - 2.0 * (vectors @ centres.T)
    far = np.where(np.isnan(far), np.inf, far)
    if most == 1:
        return far.argmin(axis=1)[:, None]
    return np.argsort(far, axis=1, kind="stable")[:, :most]


def _routed(centres: np.ndarray, metric: str, most: int):
    """``(id, vec)`` -> ``(cell, place, id, vec)``, one row for each of the ``most`` nearest cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            step = max(1, (1 << 22) // max(most, len(centres)))
            for lo in range(0, b.num_rows, step):
                part = b.slice(lo, step)
                cells = cell_order(_directions(tiles.vectors_of(part.column(1)), metric), centres, most)
                rows = pa.array(np.repeat(np.arange(part.num_rows), cells.shape[1]))
                places = np.tile(np.arange(cells.shape[1], dtype=np.int32), part.num_rows)
                yield pa.RecordBatch.from_arrays([pa.array(cells.ravel().astype(np.int32)), pa.array(places), part.column(0).take(rows), part.column(1).take(rows)],
                                                 names=["cell", "place", "id", "vec"])
    return run


def _route(rows: DataFrame, centres: np.ndarray, metric: str, most: int) -> DataFrame:
    id_type, vec_type = (rows.schema[c].dataType.simpleString() for c in ("id", "vec"))
    return rows.select("id", "vec").mapInArrow(_routed(centres, metric, min(most, len(centres))), f"cell int, place int, id {id_type}, vec {vec_type}")


def fit_centres(vectors: DataFrame, id_col: str, vec_col: str, metric: str, cells: int | None = None) -> np.ndarray:
    """Centres of cells from a bounded sample; as many as the square root of the rows, unless ``cells`` is given."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec")).where("vec is not null")
    rows = rows.where(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    number = rows.count()
    wanted = max(1, min(cells or round(number ** 0.5), MAX_CELLS, number))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE)
    if metric == "cosine":
        norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
        sample = sample.withColumn("norm", norm).where("norm > 0").withColumn("vec", F.transform("vec", lambda x: x / F.col("norm")))
    if wanted == 1:
        first = sample.select("vec").head()
        return np.array([first["vec"]]) if first else np.zeros((0, 0))
    fitted = KMeans(k=wanted, maxIter=ROUNDS, seed=1, initMode="random").fit(sample.select(array_to_vector("vec").alias("features")))
    return np.array(fitted.clusterCenters())


class CellIndex:
    """An index written under a folder; ``rows`` holds the columns of the store and the cell."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        about = json.loads(spark.read.text(f"{self.path}/about").first()["value"])
        self.id_col, self.vec_col, self.metric = (about[k] for k in ("id", "vec", "metric"))
        found = spark.read.parquet(f"{self.path}/centres").orderBy("cell").collect()   # at most MAX_CELLS
        self.centres = np.array([r["centre"] for r in found], np.float64) if found else np.zeros((0, 0))
        self.rows = spark.read.parquet(f"{self.path}/rows")
        self.parts = spark.read.parquet(f"{self.path}/cells")

    @property
    def cells(self) -> int:
        return len(self.centres)

    def search(self, queries: DataFrame, k: int = retrieval.DEFAULT_K, probes: int | None = None, where: dict | Column | None = None,
               qid_col: str = "qid", qvec_col: str = "embedding") -> DataFrame:
        """``(qid, rank, id, distance)``: the ``k`` nearest rows in the ``probes`` nearest cells (None: all cells)."""
        asked = queries.select(F.col(qid_col).cast("long").alias("id"), F.col(qvec_col).alias("vec")).where("vec is not null")
        if not self.cells:
            id_type = self.rows.schema[self.id_col].dataType.simpleString()
            return self.spark.createDataFrame([], f"qid long, rank int, `{self.id_col}` {id_type}, distance double")
        routed = _route(asked, self.centres, self.metric, probes or self.cells)
        rows = self.rows
        if where is not None:
            rows = rows.where(where if isinstance(where, Column) else retrieval.where_to_column(where))
        if (probes or self.cells) < self.cells:
            needed = [r[0] for r in routed.select("cell").distinct().limit(FILTERED_CELLS + 1).collect()]
            if len(needed) <= FILTERED_CELLS:
                rows = rows.where(F.col("_cell").isin(needed))
        records = rows.select(F.col("_cell").alias("cell"), F.col(self.id_col).alias("id"), F.col(self.vec_col).alias("vec"))
        key = F.col("cell") * (1 << 32) + F.col("part")
        side = tiles.packed(records, tiles.STORE_TILE_BYTES).join(self.parts, "cell")
        side = side.withColumn("part", F.pmod(F.xxhash64("tile"), "parts")).select(key.alias("key"), "ids", "vecs")
        # queries of one cell and part lie together and share tiles; those of a popular cell are cut by range
        copies = routed.join(self.parts, "cell").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        near = copies.select(key.alias("cell"), "id", "vec").repartitionByRange("cell", "id").sortWithinPartitions("cell")
        qtiles = tiles.packed(near, tiles.QUERY_TILE_BYTES).select(F.col("cell").alias("key"), F.col("tile").alias("q_tile"), F.col("ids").alias("q_ids"), F.col("vecs").alias("q_vecs"))
        hits = tiles.ranked(tiles.search(side.join(qtiles.hint("merge"), "key"), records.schema["id"].dataType, k, self.metric), k)
        return hits.withColumnRenamed("id", self.id_col)

    def probes_for(self, queries: DataFrame, k: int = retrieval.DEFAULT_K, recall: float = RECALL, qid_col: str = "qid", qvec_col: str = "embedding") -> int:
        """Fewest probes with the wished recall of the exact ``k`` nearest, over a bounded sample of queries.

        The exact hits of the sample are looked up in the index; what counts is
        the place of their cells in their query's order of cells.
        """
        asked = queries.select(F.col(qid_col).cast("long").alias("id"), F.col(qvec_col).alias("vec")).where("vec is not null").orderBy(F.xxhash64("id"), "id").limit(AUDIT)
        asked = self.spark.createDataFrame(asked.collect(), asked.schema)          # at most AUDIT rows
        store = self.rows.select(F.col(self.id_col).alias("id"), F.col(self.vec_col).alias("embedding"))
        hits = retrieval.knn(store, asked, k, self.metric, qid_col="id", qvec_col="vec")
        cells = self.rows.select(F.col(self.id_col).alias("id"), F.col("_cell").alias("cell"))
        order = _route(asked, self.centres, self.metric, self.cells).select(F.col("id").alias("qid"), "cell", "place")
        places = hits.join(cells, "id").join(order, ["qid", "cell"]).groupBy("place").count().orderBy("place").collect()
        total, seen = sum(r["count"] for r in places), 0
        for r in places:
            seen += r["count"]
            if seen >= recall * total:
                return r["place"] + 1
        return 1


def build_cells(store: DataFrame, path: str, id_col: str = "id", vec_col: str = "embedding", metric: str = "l2sq", cells: int | None = None) -> CellIndex:
    """Fit centres, assign every row with a vector, and write the index under ``path``."""
    if metric not in ("l2sq", "cosine"):
        raise ValueError(f"cells need l2sq or cosine, not {metric}")
    spark, path = store.sparkSession, path.rstrip("/")
    centres = fit_centres(store, id_col, vec_col, metric, cells)
    about = json.dumps({"id": id_col, "vec": vec_col, "metric": metric})
    spark.createDataFrame([(about,)], "value string").coalesce(1).write.text(f"{path}/about")
    spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "cell int, centre array<double>").coalesce(1).write.parquet(f"{path}/centres")
    rest = [c for c in store.columns if c != vec_col]
    assigned = store.where(F.col(vec_col).isNotNull()).select(F.struct(*rest).alias("id"), F.col(vec_col).alias("vec"))
    assigned = _route(assigned, centres, metric, 1).select(F.col("cell").cast("long").alias("_cell"), "id.*", F.col("vec").alias(vec_col))
    assigned.repartitionByRange("_cell", F.xxhash64(id_col)).sortWithinPartitions("_cell").write.parquet(f"{path}/rows")
    sizes = spark.read.parquet(f"{path}/rows").groupBy(F.col("_cell").alias("cell")).agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).cast("long").alias("parts"))
    sizes.coalesce(1).write.parquet(f"{path}/cells")
    return CellIndex(spark, path)
