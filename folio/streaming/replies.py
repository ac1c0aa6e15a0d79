"""E6 over streams: model requests meet their replies, or time out (with G1).

Requests and replies are two streams.  They meet in a left outer join on
(request, part) within ``wait`` of the request; watermarks on both sides let
Spark drop state that cannot match any more, and a request without a reply in
time comes out once, without a body.  Every settled part goes to a table of its
own, one folder per epoch, so a replayed epoch overwrites only itself.  A request
whose parts are all settled is enriched as in the batch job
(:func:`folio.operators.enrich.enrich`; a part without a reply takes the
fallback), and its summary and topics are put into the records of its article:
only store files that hold such an article are written anew.

The earliest reply of a part counts.  A reply that comes too late changes nothing.
An unanswered request settles once later events move both watermarks beyond its
time-out, as in any stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.operators import enrich as E
from folio.sources.store import ChunkStore

REQUEST_SCHEMA = "request_id string, part int, parts int, route string, requested_at timestamp"
REPLY_SCHEMA = "request_id string, part int, body string, replied_at timestamp"
SETTLED_SCHEMA = "request_id string, part int, parts int, route string, body string, replied_at timestamp, epoch long"
WAIT = "10 minutes"     # from a request to its last useful reply
DELAY = "1 minute"      # by which events may arrive out of order


def settled(requests: DataFrame, replies: DataFrame, wait: str = WAIT, delay: str = DELAY) -> DataFrame:
    """Each request part with its replies in time, or once with a null body."""
    asked = requests.withWatermark("requested_at", delay)
    given = replies.select(F.col("request_id").alias("_id"), F.col("part").alias("_part"), "body", "replied_at").withWatermark("replied_at", delay)
    in_time = F.col("replied_at").between(F.col("requested_at"), F.col("requested_at") + F.expr(f"interval {wait}"))
    both = asked.join(given, (F.col("request_id") == F.col("_id")) & (F.col("part") == F.col("_part")) & in_time, "left_outer")
    return both.select("request_id", "part", "parts", "route", "body", "replied_at")


def finished(rows: DataFrame) -> DataFrame:
    """``(request_id, route, summary, topics)`` of requests whose parts are all settled."""
    once = rows.groupBy("request_id", "part", "parts", "route").agg(F.min_by("body", F.struct("replied_at", "body")).alias("body"))
    whole = once.groupBy("request_id").agg(F.count(F.lit(1)).alias("_n"), F.max("parts").alias("_parts")).where("_n = _parts").select("request_id")
    once = once.join(whole, "request_id", "left_semi")
    return E.enrich(once.select("request_id", "part", "parts", "route"), once.where("body is not null").select("request_id", "part", "body"))


def settle_batch(store: ChunkStore, root: str, vacuum: bool = False):
    """``foreachBatch`` body: keep the settled parts, enrich what is complete, annotate the store (``vacuum``: and remove its old files)."""
    def fn(batch: DataFrame, epoch_id: int) -> None:
        spark, path = store.spark, f"{root}/settled"
        batch.withColumn("epoch", F.lit(epoch_id).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(path)
        rows = spark.read.schema(SETTLED_SCHEMA).parquet(path)
        ids = rows.where(F.col("epoch") == epoch_id).select("request_id").distinct()
        done = finished(rows.join(ids, "request_id", "left_semi"))
        store.annotate(done.select(F.col("request_id").alias("article_id"), "summary", "topics"))
        if vacuum:
            store.vacuum()
    return fn


def _stream(spark: SparkSession, folder: str, schema: str, files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def run_replies(store: ChunkStore, requests: str, replies: str, root: str, wait: str = WAIT, delay: str = DELAY,
                files_per_trigger: int | None = None, vacuum: bool = False) -> DataFrame:
    """Run both streams over what is in the folders ``requests`` and ``replies`` now; the settled parts so far.

    ``root`` holds the checkpoint and the settled parts; a later run goes on there.
    ``vacuum`` is for a store without other readers: each batch leaves the files of its last version only.
    """
    spark = store.spark
    spark.createDataFrame([], T.StructType.fromDDL(SETTLED_SCHEMA)).write.mode("append").partitionBy("epoch").parquet(f"{root}/settled")
    joined = settled(_stream(spark, requests, REQUEST_SCHEMA, files_per_trigger), _stream(spark, replies, REPLY_SCHEMA, files_per_trigger), wait, delay)
    query = (
        joined.writeStream.foreachBatch(settle_batch(store, root, vacuum))
        .option("checkpointLocation", f"{root}/_checkpoint").outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(SETTLED_SCHEMA).parquet(f"{root}/settled")
