"""Vector codes: product quantisation over a lexicographic trie of distinct parts.

A vector is cut into equal parts, and each part is named by the nearest entry of
its position's codebook.  Spark counts the distinct parts of each position once
(combined before the shuffle) and writes them in lexicographic order.  A round
of the codebooks then walks each sorted piece as a trie, depth first: parts that
begin with the same components share the distances to all entries accumulated
over these components, and a leaf takes the least of its distances and adds its
part, times its count, to the sums of that entry.  Only these sums (entries x
components, whatever the input) come to the driver.

The walk goes block by block through the sorted parts and carries the path to
the last leaf along, so its memory is bounded by the block.  At the end, every
batch of vectors walks the trie of its own distinct parts, without a shuffle.

Defined cases: vectors that are null or hold null or non-finite components are
dropped, before the first codebooks are taken.  Null ids come last when the
first entries are taken, and rows of one id go by their components.  Repeated
rows give repeated result rows.  Null labels are one label.  With fewer rows
than entries, a codebook has as many entries as there are rows.  An empty table
gives no rows.  Vectors of another length than the longest kept one, lengths that
the number of parts does not divide, and components of ``LARGEST`` or more
(integers, after scaling) raise an error, as sums would not be exact.  Extra
columns are not read.
"""

from __future__ import annotations

import hashlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.llm.base import in_small_batches, ship, stored

ship(__name__)

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
BLOCK = 4096           # leaves that are walked together
LARGEST = 1 << 27      # of scaled components: squared distances of 256 components stay exact in 64 bits


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and squared distance of each part (rows, best in lexicographic order).

    A row whose first ``s`` components equal those of the row before it starts
    from that row's distances accumulated over them.
    """
    rows, depth = parts.shape
    entry, least = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    if not rows or not depth:
        return entry, least
    shared = np.zeros(rows, np.int64)
    shared[1:] = np.cumprod(parts[1:] == parts[:-1], axis=1).sum(axis=1)
    path = np.zeros((depth, len(book)), np.int64)
    for lo in range(0, rows, BLOCK):
        block, same = parts[lo:lo + BLOCK], shared[lo:lo + BLOCK]
        above, place = np.zeros((1, len(book)), np.int64), np.zeros(len(block), np.int64)
        for j in range(depth):
            opens = same <= j                      # the row has a node of its own at this depth
            first = np.flatnonzero(opens)
            steps = block[first, j, None] - book[None, :, j]
            own = above[place[first]] + steps * steps
            above = np.concatenate([path[j:j + 1], own])
            place = np.cumsum(opens)               # 0: the node that the block before has left open
            path[j] = above[place[-1]]
        best = above.argmin(axis=1)
        entry[lo:lo + BLOCK] = best[place]
        least[lo:lo + BLOCK] = above[np.arange(len(above)), best][place]
    return entry, least


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _sums(books: np.ndarray):
    """Counts and component sums of each entry over the distinct parts of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, entries, width = books.shape
        counts, sums = np.zeros((places, entries), np.int64), np.zeros(books.shape, np.int64)
        for b in batches:
            place, parts = b.column(0).to_numpy(), _matrix(b.column(1), width)
            times = b.column(2).to_numpy()
            for p in np.unique(place):
                at = np.flatnonzero(place == p)
                entry, _ = nearest(parts[at], books[p])
                np.add.at(counts[p], entry, times[at])
                np.add.at(sums[p], entry, parts[at] * times[at, None])
        p, e = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(e), pa.array(counts[p, e]), pa.array(list(sums[p, e]), pa.list_(pa.int64()))], names=["place", "entry", "n", "sums"])
    return run


def _codes(books: np.ndarray):
    """Code and error of each vector, from the trie of a batch's distinct parts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, _, width = books.shape
        for b in batches:
            vectors = _matrix(b.column(2), places * width)
            code, error = np.zeros((len(vectors), places), np.uint8), np.zeros(len(vectors), np.int64)
            for p in range(places):
                parts = vectors[:, p * width:(p + 1) * width]
                order = np.lexsort(parts.T[::-1]) if width else np.arange(len(parts))
                entry, least = nearest(parts[order], books[p])
                code[order, p] = entry
                error[order] += least
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([c.tobytes().hex() for c in code], pa.string()), pa.array(error)], names=["id", "label", "code", "error"])
    return run


def _finite(vector: Column) -> Column:
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def scaled(rows: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int) -> DataFrame:
    """Kept rows as ``id``, ``label`` and ``q``, the vector in integers."""
    vector = F.col(f"`{vec_col}`").cast("array<double>")
    kept = rows.where(_finite(vector)).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), vector.alias("v"))
    whole = F.transform("v", lambda x: F.floor(x * scale).cast("long"))
    too_large = F.exists("v", lambda x: F.abs(x) * scale >= LARGEST)
    return kept.select("id", "label", F.when(~too_large, whole).otherwise(F.raise_error(F.lit(f"a component is not under {LARGEST} / {scale}")).cast("array<long>")).alias("q"))


def compress(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """``(id, label, code, error)`` per kept row, and the codebooks (parts x entries x components)."""
    kept = stored(scaled(in_small_batches(rows), id_col, vec_col, label_col, scale), "codes-scaled")
    first = [r["q"] for r in kept.orderBy(F.col("id").asc_nulls_last(), "q").limit(entries).select("q").collect()]
    schema = T.StructType([T.StructField("id", kept.schema["id"].dataType), T.StructField("label", kept.schema["label"].dataType), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if not first:
        return rows.sparkSession.createDataFrame([], schema), np.zeros((parts, 0, 0), np.int64)
    least, most = kept.agg(F.min(F.size("q")), F.max(F.size("q"))).first()
    if least != most or most % parts:
        raise ValueError(f"vectors of {least} to {most} components; {parts} equal parts are asked for")
    width = most // parts
    books = np.array(first, np.int64).reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    cut = F.array(*[F.slice("q", p * width + 1, width) for p in range(parts)])
    distinct = kept.select(F.posexplode(cut).alias("place", "part")).groupBy("place", "part").agg(F.count(F.lit(1)).alias("n"))
    distinct = stored(distinct.repartitionByRange("place", "part").sortWithinPartitions("place", "part"), "codes-parts")
    for _ in range(rounds):
        sums = distinct.mapInArrow(_sums(books), "place long, entry long, n long, sums array<long>")
        total = sums.groupBy("place", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[j]).alias(f"s{j}") for j in range(width)])
        for place, entry, n, *s in total.collect():
            books[place, entry] = [x // n for x in s]
    return stored(kept.mapInArrow(_codes(books), schema), "codes"), books


def op13_vector_codes(spark, sf_dir: str) -> DataFrame:
    """Codes of all vectors, with the errors of their labels and a digest of the codebooks."""
    codes, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    labels = codes.groupBy("label").agg(F.sum("error").alias("label_error"))
    out = codes.alias("c").join(labels.alias("l"), F.col("c.label").eqNullSafe(F.col("l.label")))
    return out.select(F.col("c.id").alias("vec_id"), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same codes by plain distances: each distinct part against each entry, in every round."""
    def assigned(r: int) -> str:
        return (f"a{r} AS (SELECT place, part, min(d * {entries} + entry) AS m FROM (SELECT x.place, x.part, b.entry, sum((x.x - b.c) * (x.x - b.c)) AS d "
                f"FROM xs x JOIN b{r} b ON b.place = x.place AND b.j = x.j GROUP BY ALL) GROUP BY ALL)")

    def moved(r: int) -> str:
        return (f"s{r} AS (SELECT x.place, CAST(a.m % {entries} AS BIGINT) AS entry, x.j, CAST(sum(x.x * x.n) AS BIGINT) AS s, CAST(sum(x.n) AS BIGINT) AS n "
                f"FROM xs x JOIN a{r} a ON a.place = x.place AND a.part = x.part GROUP BY ALL), "
                f"b{r + 1} AS (SELECT b.place, b.entry, b.j, CASE WHEN s.n IS NULL THEN b.c ELSE (s.s - ((s.s % s.n) + s.n) % s.n) // s.n END AS c "
                f"FROM b{r} b LEFT JOIN s{r} s ON s.place = b.place AND s.entry = b.entry AND s.j = b.j)")

    rounds_sql = ", ".join(f"{assigned(r)}, {moved(r)}" for r in range(rounds))
    return f"""
WITH kept AS (SELECT row_number() OVER () AS rid, vec_id, label, embedding FROM embeddings WHERE embedding IS NOT NULL AND NOT list_contains(list_transform(embedding, lambda x: coalesce(isfinite(x), false)), false)),
q AS (SELECT rid, vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS q, len(embedding) // {parts} AS w FROM kept),
cut AS (SELECT rid, vec_id, label, q, p.p AS place, q[p.p * w + 1:(p.p + 1) * w] AS part FROM q, range({parts}) p(p)),
kinds AS (SELECT place, part, count(*) AS n FROM cut GROUP BY ALL),
xs AS (SELECT place, part, n, unnest(part) AS x, generate_subscripts(part, 1) AS j FROM kinds),
firsts AS (SELECT rid, row_number() OVER (ORDER BY vec_id NULLS LAST, q) - 1 AS entry FROM q),
b0 AS (SELECT place, CAST(entry AS BIGINT) AS entry, generate_subscripts(part, 1) AS j, unnest(part) AS c FROM cut JOIN firsts USING (rid) WHERE entry < {entries}),
{rounds_sql}, {assigned(rounds)},
coded AS (SELECT c.rid, any_value(c.vec_id) AS vec_id, any_value(c.label) AS label, string_agg(lower(printf('%02x', CAST(a.m % {entries} AS BIGINT))), '' ORDER BY c.place) AS code, CAST(sum(a.m // {entries}) AS BIGINT) AS error
  FROM cut c JOIN a{rounds} a ON a.place = c.place AND a.part = c.part GROUP BY c.rid),
books AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY place, entry, j)) AS digest FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256 FROM coded, books
"""


SQL = _sql()
