"""Exact nearest neighbours of tiles of vectors.

A tile is one row that holds the ids and vectors of some hundreds of records or
queries.  Rows become tiles where they are read, without a shuffle.  A join then
brings query tiles and store tiles together, and each pair of tiles is one
matrix product.  A task keeps the best ``k`` of each query over all its pairs
and hands them on, so no (query, record) pair ever is a row.  What it keeps is
bounded: one query tile where the pairs come by query tile, else ``MAX_KEPT``
hits, beyond which it hands on what it has and starts anew.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# executors need not have this package installed: ship its task code by value
cloudpickle.register_pickle_by_value(__import__(__name__, fromlist=["_"]))

# --- fixed values -----------------------------------------------------------
QUERY_TILE_BYTES = 1 << 18    # vectors of a query tile (512 of 64 dimensions)
STORE_TILE_BYTES = 1 << 20    # vectors of a store tile
MAX_KEPT = 1 << 21            # hits that a task keeps at most
MAX_EXACT = 1 << 16           # pairs whose exact distances are computed at once
# ---------------------------------------------------------------------------

METRICS = ("l2sq", "ip", "cosine")


def vectors_of(column: pa.Array) -> np.ndarray:
    """Rows of an array column as a matrix of doubles; null components are NaN."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if len(lengths) and lengths.min() != lengths.max():
        raise ValueError(f"vectors of {lengths.min()} to {lengths.max()} components")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def to_bytes(matrix: np.ndarray, floats: bool) -> bytes:
    """A matrix of doubles as bytes; one that was made of floats as floats, half as many, and a byte that makes their number odd."""
    return b"f" + matrix.astype(np.float32).tobytes() if floats else matrix.tobytes()


def to_matrix(data: bytes, rows: int) -> np.ndarray:
    """The matrix of doubles that :func:`to_bytes` got."""
    values = np.frombuffer(data, np.float32, offset=1).astype(np.float64) if len(data) % 2 else np.frombuffer(data, np.float64)
    return values.reshape(rows, -1)


def _packer(max_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        held: list[tuple[pa.Array, np.ndarray]] = []
        rows, cell, floats = 0, None, False

        def tile() -> pa.RecordBatch:
            nonlocal held, rows, number
            ids = pa.concat_arrays([h[0] for h in held])
            data = np.concatenate([h[1] for h in held])
            out = pa.RecordBatch.from_arrays([
                pa.array([cell], pa.int64()), pa.array([(task << 32) + number], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([to_bytes(data, floats)], pa.binary()),
            ], names=["cell", "tile", "ids", "vecs"])
            held, rows, number = [], 0, number + 1
            return out

        for b in batches:
            if not b.num_rows:
                continue
            cells, vecs, floats = b.column(0).to_numpy(), vectors_of(b.column(2)), pa.types.is_float32(b.column(2).type.value_type)
            most = max(1, max_bytes // max(1, 8 * vecs.shape[1]))
            cuts = np.flatnonzero(np.diff(cells)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(cells)]):
                if rows and cell != int(cells[lo]):
                    yield tile()
                cell = int(cells[lo])
                while lo < hi:
                    take = min(hi - lo, most - rows)
                    held.append((b.column(1).slice(lo, take), vecs[lo:lo + take]))
                    rows, lo = rows + take, lo + take
                    if rows >= most:
                        yield tile()
        if rows:
            yield tile()
    return run


def packed(rows: DataFrame, max_bytes: int) -> DataFrame:
    """``(cell, id, vec)`` -> tiles ``(cell, tile, ids, vecs)``; rows of a cell that lie together share tiles."""
    schema = T.StructType([
        T.StructField("cell", T.LongType()), T.StructField("tile", T.LongType()),
        T.StructField("ids", T.ArrayType(rows.schema["id"].dataType)), T.StructField("vecs", T.BinaryType()),
    ])
    return rows.select(F.col("cell").cast("long"), "id", "vec").mapInArrow(_packer(max_bytes), schema)


def exact_distances(x: np.ndarray, y: np.ndarray, metric: str) -> np.ndarray:
    """Distance of each row of ``x`` to the same row of ``y``."""
    if metric == "l2sq":
        d = x - y
        return np.einsum("ij,ij->i", d, d)
    dots = np.einsum("ij,ij->i", x, y)
    if metric == "ip":
        return 1.0 - dots
    with np.errstate(invalid="ignore", divide="ignore"):
        return 1.0 - dots / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1))


def _rough(q: np.ndarray, s: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """All distances by one matrix product, and a bound of each query's rounding error."""
    dots = q @ s.T
    if metric == "l2sq":
        qq, ss = np.einsum("ij,ij->i", q, q), np.einsum("ij,ij->i", s, s)
        return qq[:, None] + ss[None, :] - 2.0 * dots, 1e-9 * (np.nanmax(ss, initial=0.0) + qq) + 1e-12
    if metric == "ip":
        return 1.0 - dots, 1e-9 * (1.0 + np.nanmax(np.abs(dots), axis=1, initial=0.0))
    with np.errstate(invalid="ignore", divide="ignore"):
        return 1.0 - dots / (np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(s, axis=1)[None, :]), np.full(len(q), 1e-9)


def _first(k: int, q: np.ndarray, ids: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` least of each query, ties by id."""
    order = np.lexsort((ids, d, q))
    q, ids, d = q[order], ids[order], d[order]
    keep = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[keep], ids[keep], d[keep]


def best_of_tiles(q: np.ndarray, s: np.ndarray, ids: np.ndarray, k: int, metric: str, known=None):
    """Query numbers, ids and exact distances of each query's ``k`` best among ``known`` and the store tile.

    The matrix product selects candidates within its error; only these get an
    exact distance.  Distances that are no number are never hits.
    """
    rough, error = _rough(q, s, metric)
    rough[np.isnan(rough)] = np.inf
    last = min(k, len(ids)) - 1
    limit = np.partition(rough, last, axis=1)[:, last]
    if known is not None:
        full = np.bincount(known[0], minlength=len(q)) >= k
        worst = np.full(len(q), -np.inf)
        np.maximum.at(worst, known[0], known[2])
        limit = np.where(full, np.minimum(limit, worst), limit)
    at, to = np.nonzero(rough <= (limit + 2.0 * error)[:, None])
    d = np.empty(len(at))
    for lo in range(0, len(at), MAX_EXACT):
        part = slice(lo, lo + MAX_EXACT)
        d[part] = exact_distances(q[at[part]], s[to[part]], metric)
    real = ~np.isnan(d)
    at, found, d = at[real], ids[to[real]], d[real]
    if known is not None:
        at, found, d = (np.concatenate(p) for p in zip(known, (at, found, d)))
    return _first(k, at, found, d)


def _search(k: int, metric: str, text_ids: bool, by_query: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list] = {}   # query tile -> its ids and best hits
        total = 0

        def hand_on() -> Iterator[pa.RecordBatch]:
            for qids, (at, ids, d) in kept.values():
                found = pa.array(ids.tolist(), pa.string()) if text_ids else pa.array(ids)
                yield pa.RecordBatch.from_arrays([pa.array(qids[at]), found, pa.array(d)], names=["qid", "id", "distance"])

        for b in batches:
            for r in range(b.num_rows):
                tile, qids, qvecs, ids, vecs = (b.column(c)[r] for c in range(5))
                qids = qids.values.to_numpy().copy()   # a view would keep the whole batch while the hits are kept
                ids = np.array(ids.as_py()) if text_ids else ids.values.to_numpy()
                q, s = to_matrix(qvecs.as_py(), len(qids)), to_matrix(vecs.as_py(), len(ids))
                before = kept.get(tile.as_py())
                if by_query and not before:   # the pairs of the query tile before are over
                    yield from hand_on()
                    kept, total = {}, 0
                hits = best_of_tiles(q, s, ids, k, metric, before and before[1])
                total += len(hits[0]) - (len(before[1][0]) if before else 0)
                kept[tile.as_py()] = [qids, hits]
                if total > MAX_KEPT:
                    yield from hand_on()
                    kept, total = {}, 0
        yield from hand_on()
    return run


def search(pairs: DataFrame, id_type: T.DataType, k: int, metric: str, by_query: bool = False) -> DataFrame:
    """Pairs of tiles ``(q_tile, q_ids, q_vecs, ids, vecs)`` -> candidates ``(qid, id, distance)``.

    ``by_query`` says that the pairs of a query tile come one after another.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric}")
    schema = T.StructType([T.StructField("qid", T.LongType()), T.StructField("id", id_type), T.StructField("distance", T.DoubleType())])
    columns = pairs.select("q_tile", "q_ids", "q_vecs", "ids", "vecs")
    return columns.mapInArrow(_search(k, metric, isinstance(id_type, T.StringType), by_query), schema)


def ranked(candidates: DataFrame, k: int, branches: int = 1) -> DataFrame:
    """The ``k`` best candidates of each query, ties by id.

    With many tasks the candidates of a query meet in ``branches`` groups first,
    so that no task ranks the hits of all tasks for a query at once.
    """
    order = [F.col("distance").asc(), F.col("id").asc()]

    def best(df: DataFrame, *keys: str) -> DataFrame:
        return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)

    if branches > 1:
        candidates = best(candidates.withColumn("branch", F.spark_partition_id() % branches), "qid", "branch").drop("rank", "branch")
    return best(candidates, "qid").select("qid", "rank", "id", "distance")
