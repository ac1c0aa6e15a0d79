"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.base import stored


def _mark(edges: DataFrame):
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``(u, v)`` edges of longs -> ``(node, root)`` for each node that is not its own root.

    The root is the least node of a component.  Each round points the larger
    neighbours of a node at its least neighbour, then the smaller ones; the
    rounds end when nothing changes.  A hub's rows only meet in a minimum
    (combined before the shuffle) and in a join whose other side has one row
    for the hub, which adaptive execution can split.
    """
    e = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct(), "edges")
    mark = _mark(e)
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        e = stored(small.where("u > v").distinct(), "edges")
        now = _mark(e)
        if now == mark:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now
