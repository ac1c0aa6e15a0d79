"""SimHash near-duplicates by a self-join of a binary trie.

Fingerprints (64 bits of hashed word shingles) are linked when at most
``max_bits`` bits differ.  The distinct fingerprints form a binary trie.  The
join walks pairs of nodes of equal depth together, adds up the bits in which
they differ, and drops a pair as soon as the budget is exceeded; this finds
every link and never compares all pairs.

Spark spreads the walk: quantiles cut the sorted fingerprints into ranges, so
a crowd of similar fingerprints is cut as finely as its size asks for.  A first
walk of each fingerprint over the ranges (whole subtrees at a time) sends it to
the ranges that hold anything within the budget, to the right of its own only.
Each range then joins its own trie with the trie of its visitors and returns a
spanning forest of the links, never the links themselves.  Components of the
forests come from :mod:`folio.llm.components`.

Exact copies share a fingerprint and count once in all this.

Defined cases: null, empty and blank texts have fingerprint zero, linked like any
other.  Repeated rows give repeated result rows.  A null id is never a
component id; a component of null ids only has a null component id.  An empty
table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

from itertools import accumulate
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.base import in_small_batches, ship, stored, unused
from folio.llm.components import components

ship(__name__)

SHINGLE = 3
MAX_BITS = 2
RANGE_ROWS = 8192          # distinct fingerprints of a range, up to MAX_RANGES ranges
LEAST_RANGES = 128         # for parallel work on small inputs, of 64 fingerprints or more each
MAX_RANGES = 1 << 16       # bounds the table of cut points
SMALL_PAIR = 64            # node pairs with at most so many fingerprint pairs are compared directly
CHUNK = 1 << 21


def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit SimHash of the shingles of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six blanks only
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    begins = [0] + ends
    digest = xxhash.xxh64_intdigest
    hashes = [digest(line[b:e - 1], 42) for b, e in zip(begins, ends[shingle - 1:] or ends[-1:])]
    bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    over = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(over, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(fps.view(np.int64))], names=["id", "copy", "fp"])
    return run


def _expand(alo, ahi, blo, bhi) -> tuple[np.ndarray, np.ndarray]:
    """All index pairs of the given boxes."""
    na, nb = ahi - alo, bhi - blo
    total = na * nb
    box = np.repeat(np.arange(len(total)), total)
    k = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
    return alo[box] + k // nb[box], blo[box] + k % nb[box]


def trie_pairs(a: np.ndarray, b: np.ndarray, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sorted, distinct uint64 arrays that differ in at most ``budget`` bits.

    A node is a run of an array whose members share the leading bits; a state
    is a pair of nodes of the same depth with the bits spent so far.
    """
    if not len(a) or not len(b):
        return
    alo, ahi = np.array([0]), np.array([len(a)])
    blo, bhi = np.array([0]), np.array([len(b)])
    spent = np.array([0])
    for depth in range(64):
        boxes = (ahi - alo) * (bhi - blo)
        small = (boxes <= SMALL_PAIR) | (depth == 64)
        done = np.flatnonzero(small)
        for part in np.array_split(done, max(1, boxes[done].sum() // CHUNK + 1)):
            if len(part):
                i, j = _expand(alo[part], ahi[part], blo[part], bhi[part])
                ok = np.bitwise_count(a[i] ^ b[j]) <= budget
                yield i[ok], j[ok]
        alo, ahi, blo, bhi, spent = (x[~small] for x in (alo, ahi, blo, bhi, spent))
        if not len(alo):
            return
        bit = np.uint64(1) << np.uint64(63 - depth)
        above = ~((bit << np.uint64(1)) - np.uint64(1)) if depth else np.uint64(0)
        amid = np.clip(np.searchsorted(a, (a[alo] & above) | bit), alo, ahi)
        bmid = np.clip(np.searchsorted(b, (b[blo] & above) | bit), blo, bhi)
        steps = [(alo, amid, blo, bmid, 0), (amid, ahi, bmid, bhi, 0), (alo, amid, bmid, bhi, 1), (amid, ahi, blo, bmid, 1)]
        kept = [[], [], [], [], []]
        for lo1, hi1, lo2, hi2, cost in steps:
            go = (hi1 > lo1) & (hi2 > lo2) & (spent + cost <= budget)
            for out, x in zip(kept, (lo1, hi1, lo2, hi2, spent + cost)):
                out.append(x[go])
        alo, ahi, blo, bhi, spent = map(np.concatenate, kept)
    for i, j in zip(alo, blo):  # single fingerprints of full depth
        yield np.array([i]), np.array([j])


def _route(cuts: np.ndarray, budget: int):
    """Send each fingerprint to its own range and to later ranges that may hold a neighbour."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            own = np.searchsorted(cuts, fps, side="right")
            who, node, spent = np.arange(len(fps)), np.zeros(len(fps), np.uint64), np.zeros(len(fps), np.int8)
            found = []
            for depth in range(65):
                last = node | (np.uint64((1 << (64 - depth)) - 1))
                lo, hi = np.searchsorted(cuts, node, side="right"), np.searchsorted(cuts, last, side="right")
                one = lo == hi
                found.append(np.stack([who[one], lo[one]]))
                more = ~one & (hi >= own[who])
                who, node, spent = who[more], node[more], spent[more]
                if depth == 64 or not len(who):
                    break
                bit = np.uint64(1) << np.uint64(63 - depth)
                same = node | (fps[who] & bit)
                can = spent < budget
                who = np.concatenate([who, who[can]])
                node = np.concatenate([same, same[can] ^ bit])
                spent = np.concatenate([spent, spent[can] + 1])
            pairs = np.concatenate(found, axis=1)
            pairs = np.unique(pairs[:, pairs[1] >= own[pairs[0]]], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[1].astype(np.int32)), pa.array(fps[pairs[0]].view(np.int64))], names=["range", "fp"])
    return run


def _unite(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``parent`` (an array of least-known roots) after joining all pairs."""
    while True:
        ri, rj = parent[i], parent[j]
        differ = ri != rj
        if not differ.any():
            return parent
        i, j, ri, rj = i[differ], j[differ], ri[differ], rj[differ]
        np.minimum.at(parent, np.maximum(ri, rj), np.minimum(ri, rj))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up


def _join_range(cuts: np.ndarray, budget: int):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        every = np.sort(pdf["fp"].to_numpy().view(np.uint64))
        mine = np.flatnonzero(np.searchsorted(cuts, every, side="right") == key[0])
        parent = np.arange(len(every))
        for i, j in trie_pairs(every[mine], every, budget):
            parent = _unite(parent, mine[i], j)
        child = np.flatnonzero(parent != np.arange(len(every)))
        return pd.DataFrame({"u": every[child].view(np.int64), "v": every[parent[child]].view(np.int64)})
    return run


def links(fps: DataFrame, budget: int = MAX_BITS) -> DataFrame:
    """Edges ``(u, v)`` that connect the linked ones of distinct fingerprints ``fp``."""
    n = fps.count()
    ranges = min(MAX_RANGES, max(-(-n // RANGE_ROWS), min(LEAST_RANGES, n // 64)), max(n, 1))
    cuts = np.empty(0, np.uint64)
    if ranges > 1:
        flipped = F.expr("fp ^ -9223372036854775808")  # unsigned order as signed order
        at = [i / ranges for i in range(1, ranges)]
        got = fps.agg(F.percentile_approx(flipped, at, max(10000, 4 * ranges))).first()[0]
        cuts = np.unique(np.array(got, np.int64).view(np.uint64) ^ np.uint64(1 << 63))
    routed = fps.select("fp").mapInArrow(_route(cuts, budget), "range int, fp long")
    return routed.groupBy("range").applyInPandas(_join_range(cuts, budget), "u long, v long")


def _rows(docs: DataFrame, id_col: str, text: str, shingle: int) -> DataFrame:
    """``(id, copy, fp)`` per row; ``copy`` tells the texts of one id apart."""
    body = F.col(f"`{text}`")
    rows = in_small_batches(docs).select(F.col(f"`{id_col}`").cast("long").alias("id"), body.alias("text"), _copy(body).alias("copy"))
    return stored(rows.mapInArrow(_fingerprints(shingle), "id long, copy long, fp long"), "simhash-rows")


def _copy(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def _rooted(rows: DataFrame, max_bits: int) -> DataFrame:
    """``(fp, least, root)`` of the distinct fingerprints: the least id, and the number of the component."""
    fps = stored(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    roots = components(links(fps, max_bits))
    return fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: id, ``fp`` (long), ``component_id`` (least id reachable)."""
    rows = _rows(docs, id_col, text, shingle)
    rooted = _rooted(rows, max_bits)
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.join(ids, "root").select("fp", "component_id")
    return rows.join(labels, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: the one with the least id (rows without an id come last).

    Rows go because of their component, never because of their id: rows that share
    an id and not a component all stay.  Of several texts of the least id one
    stays, and of wholly equal rows one.
    """
    rows = _rows(docs, id_col, text, shingle)
    kinds = rows.groupBy("id", "copy", "fp").agg(F.count(F.lit(1)).alias("n"))
    own = F.struct(F.col("id").isNull().alias("lone"), "id", "copy", "fp")
    kinds = stored(kinds.join(_rooted(rows, max_bits).select("fp", "root"), "fp").withColumn("own", own), "simhash-kinds")
    first = kinds.groupBy("root").agg(F.min("own").alias("first"))
    judged = stored(kinds.join(first, "root").select("id", "copy", "n", (F.col("own") != F.col("first")).alias("goes")), "simhash-judged")
    k_, c_, i_, t_ = unused(docs, "key", "copy", "gone_id", "gone_copy")
    keyed = docs.withColumn(k_, F.col(f"`{id_col}`").cast("long")).withColumn(c_, _copy(F.col(f"`{text}`")))
    same = F.col(k_).eqNullSafe(F.col(i_)) & (F.col(c_) == F.col(t_))
    out = keyed.join(judged.where("goes").select(F.col("id").alias(i_), F.col("copy").alias(t_)), same, "left_anti")
    repeated = judged.where("not goes and n > 1").select(F.col("id").alias(i_), F.col("copy").alias(t_))
    if repeated.limit(1).count():
        # the rows of one id and text, of which any one stays
        again = keyed.join(repeated, same, "left_semi").dropDuplicates([k_, c_])
        out = out.join(repeated, same, "left_anti").unionByName(again)
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def op1_simhash(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
