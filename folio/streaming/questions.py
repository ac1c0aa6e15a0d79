"""Answering a stream of questions against a static store.

Each micro-batch of questions (text + vector) is cleaned (F5) and ranked
against the store with the exact k-NN of :mod:`folio.operators.retrieval`;
the hits are written to a results folder, one partition per epoch, so a
replayed epoch overwrites only itself.  The k-NN step bounds its own
broadcast (query blocks), so any micro-batch size is safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators import retrieval as Q
from folio.session import work_dir
from folio.streaming.ingest import table_path

HIT_SCHEMA = "qid bigint, rank int, id bigint, distance double, question string, epoch int"
CONV_SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def answer_batch(store: DataFrame, vectors: DataFrame, out_path: str, k: int):
    def fn(batch: DataFrame, epoch_id: int) -> None:
        qs = batch.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
        qs = Q.clean_questions(qs).join(vectors, "conv_id").select(Q.question_id(), "question", "embedding")
        hits = Q.knn(store, qs, k=k)
        out = hits.join(qs.select("qid", "question"), "qid").withColumn("epoch", F.lit(epoch_id))
        # an epoch replayed after a failure overwrites its own partition only
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(out_path)
    return fn


def run_questions_from_table(spark: SparkSession, sf_dir: str, k: int = Q.QUESTION_K) -> DataFrame:
    """The registered query: stream ``conversations`` questions, rank against ``embeddings``."""
    root = work_dir(spark, "stream-questions")
    spark.createDataFrame([], HIT_SCHEMA).write.partitionBy("epoch").parquet(f"{root}/hits")   # a run may have no hit
    emb = spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")
    store = emb.select(F.col("vec_id").alias("id"), "embedding")
    vectors = emb.select(F.col("vec_id").alias("conv_id"), "embedding")
    stream = spark.readStream.schema(CONV_SCHEMA).option("pathGlobFilter", "*.parquet").parquet(table_path(sf_dir, "conversations"))
    query = (
        stream.writeStream.foreachBatch(answer_batch(store, vectors, f"{root}/hits", k))
        .option("checkpointLocation", f"{root}/_checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(HIT_SCHEMA).parquet(f"{root}/hits").select(
        "qid", "question", "rank", "id", F.round("distance", 6).alias("distance"))
