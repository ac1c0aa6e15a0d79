"""Nearest-neighbour retrieval over the chunk store.

Exact k-NN without a cross join: queries and records become tiles (see
:mod:`folio.operators.tiles`), and pairs of tiles are searched by matrix
products on the executors.  The size of the queries is counted first.  Up to
the session's broadcast bound the planner broadcasts the query tiles, and the
store stays where it is; beyond it, query tiles and store tiles are dealt into
groups, and each pair of groups is searched together.  The number of pairs
follows the cluster's cores, so with about as many groups on either side each
tile is copied, and each query has candidates, some times the square root of
the cores; only store groups of a bounded size can make it more.  A pair's
tiles come by query tile, and a task holds the best hits of one at a time.  No
query passes through the driver.  ``row_number() <= k`` merges at most ``k``
candidates of each query and store group, in two steps where there are many.

Metadata filters (F2) become a Column applied to the store *before*
ranking, so they reach the Parquet scan and k results survive.
"""

from __future__ import annotations

import math
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.text import token_count
from folio.operators import tiles
from folio.operators.chunking import pack

# --- fixed values -----------------------------------------------------------
DEFAULT_K = 10          # library search
QUESTION_K = 5          # question answering
NO_TITLE = "No Title"
MAX_QUERY_BYTES = tiles.QUERY_TILE_BYTES   # vectors of a query tile
STORE_GROUP_BYTES = 1 << 26                # vectors of a group of store tiles, which the join holds
TASKS_PER_CORE = 3                         # pairs of groups
# ---------------------------------------------------------------------------

_OPS = {
    "$eq": lambda c, v: c == v, "$ne": lambda c, v: ~c.eqNullSafe(v), "$gt": lambda c, v: c > v,
    "$gte": lambda c, v: c >= v, "$lt": lambda c, v: c < v, "$lte": lambda c, v: c <= v,
    "$in": lambda c, v: c.isin(list(v)), "$nin": lambda c, v: ~F.coalesce(c.isin(list(v)), F.lit(False)),
}


def where_to_column(where: dict[str, Any]) -> Column:
    """metadata filter dict (``$eq $ne $gt $gte $lt $lte $in $nin $and $or``) -> Column.

    A missing value differs from every value; an empty filter keeps all rows."""
    parts = []
    for key, cond in where.items():
        if key in ("$and", "$or"):
            subs = [where_to_column(w) for w in cond]
            acc = subs[0]
            for s in subs[1:]:
                acc = (acc & s) if key == "$and" else (acc | s)
            parts.append(acc)
        elif isinstance(cond, dict):
            for op, val in cond.items():
                parts.append(_OPS[op](F.col(key), val))
        else:
            parts.append(F.col(key) == cond)
    out = F.lit(True)
    for p in parts:
        out = out & p
    return out


def knn(store: DataFrame, queries: DataFrame, k: int = DEFAULT_K, metric: str = "l2sq",
        where: dict | Column | None = None, id_col: str = "id", vec_col: str = "embedding",
        qid_col: str = "qid", qvec_col: str = "embedding", max_query_bytes: int = MAX_QUERY_BYTES) -> DataFrame:
    """F1 (+F2): the ``k`` nearest store records of every query, ties by id.

    Returns ``(qid, rank, id, distance)``; ``rank`` is 1-based.
    """
    return _knn(store, queries, k, metric, where, id_col, vec_col, qid_col, qvec_col, max_query_bytes)


def knn_hydrated(store: DataFrame, queries: DataFrame, cols: list[str], k: int = DEFAULT_K, metric: str = "l2sq",
                 where: dict | Column | None = None, id_col: str = "id", vec_col: str = "embedding",
                 qid_col: str = "qid", qvec_col: str = "embedding") -> DataFrame:
    """F1 + F3: ranked hits joined back to the record columns (late materialisation).

    The planner picks the join by measured sizes.
    """
    return hydrate(knn(store, queries, k, metric, where, id_col, vec_col, qid_col, qvec_col), store, cols, id_col)


def _knn(store, queries, k, metric, where, id_col, vec_col, qid_col, qvec_col, max_query_bytes):
    spark = store.sparkSession
    if where is not None:
        store = store.where(where if isinstance(where, Column) else where_to_column(where))
    records = store.select(F.lit(0).alias("cell"), F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).where("vec is not null")
    asked = queries.select(F.lit(0).alias("cell"), F.col(qid_col).cast("long").alias("id"), F.col(qvec_col).alias("vec")).where("vec is not null")
    number, width = asked.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    qtiles = tiles.packed(asked, max_query_bytes).select(F.col("cell").alias("q_cell"), F.col("tile").alias("q_tile"), F.col("ids").alias("q_ids"), F.col("vecs").alias("q_vecs"))
    stiles = tiles.packed(records, tiles.STORE_TILE_BYTES)
    if 8 * number * (width or 0) <= broadcast_bytes(spark):
        # measured: the store stays where it is
        pairs, groups = stiles.join(F.broadcast(qtiles), F.col("cell") == F.col("q_cell")), 1
    else:
        groups, q_groups = _groups(spark, 8 * records.count() * (width or 0))
        side = _dealt(stiles, "tile", groups).withColumn("q_group", F.explode(F.sequence(F.lit(0), F.lit(q_groups - 1)))).withColumn("part", F.col("q_group") * groups + F.col("group"))
        copies = _dealt(qtiles, "q_tile", q_groups).withColumn("s_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("part", F.col("group") * groups + F.col("s_group"))
        # the join goes through the left side once and holds a key's rows of the right one; the planner's guess of the sides plays no part
        pairs = copies.select("part", "q_tile", "q_ids", "q_vecs").hint("merge").join(side.select("part", "ids", "vecs"), "part")
    found = tiles.search(pairs, records.schema["id"].dataType, k, metric, by_query=groups > 1)
    hits = tiles.ranked(found, k, int(groups ** 0.5) if groups > 64 else 1)
    return hits.withColumnRenamed("id", id_col)


def _groups(spark, store_bytes: int) -> tuple[int, int]:
    """Numbers of store groups and query groups: as many pairs as the cores need, more only for a store whose groups would be too large."""
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism   # not the shuffle partitions, which a session may raise with its input
    groups = max(2, math.ceil(tasks ** 0.5), math.ceil(store_bytes / STORE_GROUP_BYTES))
    return groups, max(math.ceil(tasks ** 0.5), math.ceil(tasks / groups))


def _dealt(rows: DataFrame, tile: str, groups: int) -> DataFrame:
    return rows.withColumn("group", F.pmod(F.xxhash64(tile), F.lit(groups)).cast("int"))


def broadcast_bytes(spark) -> int:
    """The session's bound of what may be broadcast."""
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def hydrate(hits: DataFrame, store: DataFrame, cols: list[str], id_col: str = "id") -> DataFrame:
    """join the ranked ids back to the record columns (late materialisation).

    Inner join: every hit came from the store.  (A left join could only
    broadcast the store side.)
    """
    side = store.select(id_col, *cols)
    return hits.join(side, id_col, "inner")


def report(hits: DataFrame, title_col: str = "title") -> DataFrame:
    """title (default "No Title") and a similarity score ``exp(-distance)``."""
    return hits.select(
        "qid", "rank",
        F.coalesce(F.col(title_col), F.lit(NO_TITLE)).alias("title"),
        F.round(F.exp(-F.col("distance")), 4).alias("score"),
    )


MAX_TURNS = 1 << 16


def question_id() -> Column:
    """number of a question from its conversation and turn; a turn or number beyond its range is an error."""
    conv, turn = F.col("conv_id"), F.col("turn")
    fits = (turn >= 0) & (turn < MAX_TURNS) & (F.abs(conv) < (1 << 62) // MAX_TURNS)
    number = (conv * MAX_TURNS + turn).cast("long")
    return F.when(F.coalesce(fits, F.lit(True)), number).otherwise(F.raise_error(F.lit("no question number for this conv_id and turn")).cast("long")).alias("qid")


def clean_questions(questions: DataFrame, text: str = "question") -> DataFrame:
    """questions trimmed; blank ones skipped."""
    from folio.functions.text import py_strip
    return questions.withColumn(text, py_strip(F.col(text))).where(F.col(text) != "")


def context_pack(hits: DataFrame, budget: int, text: str = "document", sep: str = "\n\n",
                 tokens_col: str | None = None) -> DataFrame:
    """the ranked hit texts of each question packed greedily under ``budget`` tokens.

    A group holds at most k hits, so collecting it per question is bounded.
    ``tokens_col`` names a token count stored with the record (counted once
    per record instead of once per hit).
    """
    tok = F.col(tokens_col) if tokens_col else token_count(F.col(text))
    per_q = hits.groupBy("qid").agg(
        F.sort_array(F.collect_list(F.struct(F.col("rank").alias("r"), F.col(text).alias("text"),
                                             tok.alias("tok")))).alias("_hits")
    )
    return per_q.select(
        "qid", F.posexplode(pack(F.col("_hits"), budget, sep)).alias("pack_no", "_p")
    ).select(
        "qid", F.col("pack_no").cast("int").alias("pack_no"), F.col("_p.n").cast("int").alias("n_hits"),
        F.col("_p.tok").cast("int").alias("tokens"), F.col("_p.text").alias("context"),
    )
