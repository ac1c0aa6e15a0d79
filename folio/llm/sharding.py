"""Sharding by balanced label propagation.

Rows that share a group (equal texts by default) are linked.  All rows start
in a shard given by a hash.  Linked rows then move to where their group is:

* Groups of an eighth of a shard or more (so at most eight times as many as
  shards) are placed first, largest first: whole where a shard has room, the
  fullest such shard first, and otherwise over as few shards as have the room.
* For all others, rounds of Spark joins over the table of (group, shard) counts
  move the rows of a group to the shard, of those with room, that has most of
  it (to another with room, if none of them has).  Quotas come from a shards x shards table of wanted moves.  Linked rows may
  fill a shard, as rows without links can give way.  The rounds end when no
  move is left, or when ``PATIENCE`` rounds on end moved nothing, as no
  shard that a group wants has room.

At the end the counts are levelled to differ by one at most: rows without links
move first, then groups that were propagated, one after the other.
:func:`cut_edges` reports the share of linked pairs that were cut.

No task holds a group.  Groups above 1/``HOT`` of all rows (so at most ``HOT``)
are found by a broadcast of their hashes and not by a shuffle on the key, and
rows are numbered by buckets of about ``BUCKET_ROWS`` rows and offsets of buckets.

Defined cases: a null text has no bytes (size 8, checksum 0) and is linked with
empty texts.  Rows are told apart by a row number of their own, so repeated
rows and null ids each get a place.  An empty table gives no rows.  Groups are
told apart by a 64-bit hash of the key; a collision would only draw two groups to
one shard.  Only the payload columns are carried, under any names but ``shard`` and
``slot``, which the result adds.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.base import stored

SHARDS = 24
PARTS_OF_SHARD = 8
HOT = 4096
PATIENCE = 3
BUCKET_ROWS = 4096
MAX_BUCKETS = 4096
PLACED, LINKED, ALONE = 0, 1, 2


def _quotas(moves: np.ndarray, counts: np.ndarray, rooms: np.ndarray) -> np.ndarray:
    """Share of the moves into each shard that keeps every shard within its room."""
    wanted_in, share = moves.sum(axis=0), np.ones(len(counts))
    for _ in range(50):
        leaving = (moves * share[None, :]).sum(axis=1)
        room = np.maximum(rooms - counts + leaving, 0)
        share = np.where(wanted_in > 0, np.clip(room / np.maximum(wanted_in, 1), 0, 1), 1.0)
    return share


def _place(sizes: list[tuple[int, int]], rooms: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(group, first row, row after the last, shard) for groups (group, rows); ``rooms`` shrinks."""
    out = []
    for gid, n in sorted(sizes, key=lambda g: (-g[1], g[0])):
        at = 0
        while at < n:
            fits = np.flatnonzero(rooms >= n - at)
            j = int(fits[np.argmin(rooms[fits])]) if len(fits) else int(np.argmax(rooms))
            take = int(min(n - at, rooms[j]))
            out.append((gid, at, at + take, j))
            rooms[j] -= take
            at += take
    return out


def _small_table(like: DataFrame, rows: list[tuple], **columns: str) -> DataFrame:
    """A table of a bounded list of rows, without a Python worker."""
    structs = [F.struct(*[F.lit(v).cast(t).alias(c) for v, (c, t) in zip(r, columns.items())]) for r in rows]
    return like.sparkSession.range(1).select(F.inline(F.array(*structs)))


def _propagate(hist: DataFrame, shards: int, rooms: np.ndarray) -> DataFrame:
    """``hist`` (gid, home, count, shard: where its rows of ``home`` are) after the rounds."""
    turn, idle, has_room = 0, 0, rooms > 0
    while True:
        now = hist.groupBy("gid", "shard").agg(F.sum("count").alias("count"))
        open_ = F.get(F.lit([bool(x) for x in has_room]), F.col("shard"))
        best = F.max_by("shard", F.struct(open_, "count", F.xxhash64("gid", "shard")))
        if has_room.any():  # a cut group none of whose shards has room goes to one that has
            other = F.get(F.lit([int(j) for j in np.flatnonzero(has_room)]), F.pmod(F.xxhash64("gid", F.lit(turn)), F.lit(int(has_room.sum()))).cast("int"))
            best = F.when(F.max(open_) | (F.count(F.lit(1)) == 1), best).otherwise(other)
        target = now.groupBy("gid").agg(best.alias("target"))
        aimed = stored(hist.join(target, "gid"), "shard-target")
        wanted = aimed.groupBy("shard", "target").agg(F.sum("count").alias("n"))
        moves, counts = np.zeros((shards, shards)), np.zeros(shards)
        for r in wanted.collect():  # at most shards x shards rows
            counts[r["shard"]] += r["n"]
            if r["shard"] != r["target"]:
                moves[r["shard"], r["target"]] = r["n"]
        share = _quotas(moves, counts, rooms)
        has_room = counts < rooms
        if not moves.any() or not (moves * share[None, :]).any():
            return hist
        drawn = F.pmod(F.xxhash64("gid", F.lit(turn)), F.lit(1 << 20)) / float(1 << 20)
        goes = (F.col("shard") != F.col("target")) & (drawn < F.get(F.lit(share), F.col("target")))
        hist = stored(aimed.select("gid", "home", "count", F.when(goes, F.col("target")).otherwise(F.col("shard")).alias("shard"),
                                   goes.alias("moved")), "shard-round")
        idle = 0 if hist.where("moved").limit(1).count() else idle + 1
        hist, turn = hist.drop("moved"), turn + 1
        if idle == PATIENCE:
            return hist


def _numbered(rows: DataFrame, group: list[str], bucket: Column, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``name``: 0-based place in its group, by buckets of the group."""
    rows = rows.withColumn("bucket", bucket)
    before = Window.partitionBy(*group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(*group, "bucket").count().select(
        *group, "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    own = Window.partitionBy(*group, "bucket").orderBy(*order)
    return rows.withColumn("rn", F.row_number().over(own)).join(offsets, [*group, "bucket"]).withColumn(
        name, F.col("offset") + F.col("rn") - 1).drop("rn", "offset", "bucket")


def _pieces(n: Column) -> Column:
    """Buckets of a group of ``n`` rows."""
    return F.least(F.lit(MAX_BUCKETS), F.ceil(n / F.lit(BUCKET_ROWS)))


def _level(rows: DataFrame, quota: np.ndarray, total: int) -> DataFrame:
    """Shard and slot of every ``rows`` (rid, gid, n, tier, shard), with ``quota`` rows a shard.

    A shard's rows are numbered by tier, and what lies beyond its quota moves.
    Rows of one group lie beside each other, so few groups are cut.
    """
    shards = len(quota)
    buckets = min(MAX_BUCKETS, max(1, total // (shards * BUCKET_ROWS)))
    piece = F.pmod(F.xxhash64("rid", F.lit("piece")), _pieces(F.col("n")))
    mark = F.when(F.col("tier") == LINKED, F.xxhash64("gid", piece)).otherwise(F.xxhash64("rid", F.lit("bucket")))
    bucket = F.col("tier") * F.lit(buckets) + F.pmod(mark, F.lit(buckets))
    rows = stored(_numbered(rows, ["shard"], bucket, ["gid", "rid"], "pos").drop("gid", "n", "tier"), "shard-position")
    counts = np.zeros(shards, dtype=np.int64)
    for r in rows.groupBy("shard").count().collect():
        counts[r["shard"]] = r["count"]
    over, short = np.maximum(counts - quota, 0), np.maximum(quota - counts, 0)
    first_out = np.concatenate([[0], np.cumsum(over)[:-1]]).astype(np.int64)
    filled = np.concatenate([[0], np.cumsum(short)]).astype(np.int64)
    at = lambda table, j: F.get(F.lit(table), j)
    moved = F.col("pos") >= at(quota, F.col("shard"))
    place = at(first_out, F.col("shard")) + F.col("pos") - at(quota, F.col("shard"))
    rows = rows.withColumn("place", F.when(moved, place)).withColumn(
        "to", F.when(moved, F.size(F.filter(F.lit(filled[1:]), lambda x: x <= F.col("place")))))
    slot = F.when(moved, at(counts, F.col("to")) + F.col("place") - at(filled, F.col("to"))).otherwise(F.col("pos"))
    return rows.withColumn("slot", slot.cast("bigint")).withColumn("shard", F.coalesce(F.col("to"), F.col("shard")).cast("int")).drop("place", "to", "pos")


def _linked(base: DataFrame, total: int) -> tuple[DataFrame, DataFrame]:
    """(gid, n) of all groups of two rows or more, and ``base`` with ``n`` (null: a row without links)."""
    groups = stored(base.groupBy("gid").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shard-groups")
    hot = groups.where(F.col("n") > total / HOT)  # fewer than HOT rows
    found = base.join(F.broadcast(hot), "gid", "left")
    rest = found.where("n IS NULL").drop("n").join(groups.where(F.col("n") <= total / HOT), "gid", "left")
    return groups, stored(found.where("n IS NOT NULL").select("rid", "gid", "shard", "n").unionAll(rest.select("rid", "gid", "shard", "n")), "shard-linked")


def shard(docs: DataFrame, key: list[Column], payload: list[Column], shards: int = SHARDS) -> DataFrame:
    """Payload columns of every row with ``shard`` and ``slot``.

    Rows with equal ``key`` are linked.  Counts of the shards differ by one at
    most; slots of a shard run from 0 without gaps.
    """
    base = docs.select(F.struct(*payload).alias("row"), F.xxhash64(*key).alias("gid")).withColumn("rid", F.monotonically_increasing_id())
    base = stored(base.withColumn("shard", F.pmod(F.xxhash64("rid"), F.lit(shards)).cast("int")), "shard-base")
    total = base.count()
    quota = np.array([total // shards + (j < total % shards) for j in range(shards)], dtype=np.int64)
    groups, rows = _linked(base.select("rid", "gid", "shard"), total)

    rooms, least = quota.copy(), max(2.0, total / shards / PARTS_OF_SHARD)
    large = [(r["gid"], r["n"]) for r in groups.where(F.col("n") >= least).collect()]  # at most PARTS_OF_SHARD x shards rows
    placed = [rows.where("n IS NULL").select("rid", "gid", "n", F.lit(ALONE).alias("tier"), "shard")]
    if large:
        spans = F.broadcast(_small_table(rows, _place(large, rooms), gid="bigint", lo="bigint", hi="bigint", to="int"))
        at = _numbered(rows.where(F.col("n") >= least), ["gid"], F.pmod(F.xxhash64("rid", F.lit("part")), _pieces(F.col("n"))), ["rid"], "at")
        placed.append(at.join(spans, "gid").where("at >= lo AND at < hi").select(
            "rid", "gid", "n", F.lit(PLACED).alias("tier"), F.col("to").alias("shard")))

    small = rows.where(F.col("n") < least).withColumnRenamed("shard", "home")
    hist = stored(small.groupBy("gid", "home").count().withColumn("shard", F.col("home")), "shard-hist")
    hist = _propagate(hist, shards, rooms)
    placed.append(small.join(hist, ["gid", "home"]).select("rid", "gid", "n", F.lit(LINKED).alias("tier"), "shard"))
    every = placed[0]
    for p in placed[1:]:
        every = every.unionAll(p)
    return base.select("row", "rid").join(_level(every, quota, total), "rid").select("row.*", "shard", "slot")


def cut_edges(sharded: DataFrame, key: list[Column]) -> DataFrame:
    """One row: ``pairs`` of linked rows, those ``cut`` (in two shards) and their ``share`` (null without pairs)."""
    in_shard = sharded.groupBy(F.xxhash64(*key).alias("gid"), "shard").agg(F.count(F.lit(1)).cast("double").alias("n"))
    in_group = in_shard.groupBy("gid").agg(F.sum("n").alias("n"), F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("whole"))
    sums = in_group.agg(F.coalesce(F.sum(F.col("n") * (F.col("n") - 1) / 2), F.lit(0.0)).alias("pairs"), F.coalesce(F.sum("whole"), F.lit(0.0)).alias("whole"))
    return sums.select("pairs", (F.col("pairs") - F.col("whole")).alias("cut"),
                       F.when(F.col("pairs") > 0, 1 - F.col("whole") / F.col("pairs")).alias("share"))


def op2_sharding(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    size, crc = (F.octet_length("text") + 8).cast("bigint"), F.crc32(F.col("text").cast("binary"))
    out = shard(docs, [F.xxhash64("text"), crc, size], [F.col("doc_id"), size.alias("size"), crc.alias("text_crc32")])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
