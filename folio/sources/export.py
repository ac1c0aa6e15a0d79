"""C7 sink: a table written to one folder for each name (a URL, a title, a domain), under a safe key.

Different names can have one key (``a/b`` and ``a:b``), and long names do not fit
into a folder's name.  The table ``<path>/keys`` says which folder a name has: the
first name of a key has the key itself, any other one the key and a hash of the
name.  A name keeps its folder in later runs, so a run replaces the folders of
the names that it writes and leaves all others as they are (dynamic overwrite);
running it again gives the same files' worth of rows.

A folder's files hold at most ``max_rows`` rows, and the rows of a name that makes
up much of the table are written by several tasks.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions.text import file_key

# --- fixed values -----------------------------------------------------------
LONGEST_KEY = 80        # characters; escaped and in UTF-8 such a key stays within the 255 bytes of a folder's name
MAX_ROWS = 1_000_000
# ---------------------------------------------------------------------------


def _folder_key(name: Column) -> Column:
    key = file_key(name)
    plain = F.regexp_like(key, F.lit(r"\A[\x20-\x7E]*\z")) & (F.length(key) <= LONGEST_KEY)
    short = F.concat(F.regexp_replace(F.substring(key, 1, 40), r"[^\x20-\x7E]", "_"), F.lit("~"), F.substring(F.sha2(name, 256), 1, 16))
    return F.when(plain, key).otherwise(short)


def export_keys(spark: SparkSession, path: str) -> DataFrame:
    """``(name, file_key)`` of everything exported to ``path`` so far."""
    try:
        return spark.read.schema("name string, file_key string").parquet(f"{path.rstrip('/')}/keys")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "name string, file_key string")


def export(df: DataFrame, path: str, name: str, max_rows: int = MAX_ROWS) -> DataFrame:
    """Write ``df`` by the safe key of the column ``name`` (null as the empty name); returns the rows exported so far.

    The result has the columns of ``df`` and ``file_key``.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    named = df.withColumn("_name", F.coalesce(F.col(name).cast("string"), F.lit("")))
    known = export_keys(spark, path)
    fresh = named.select("_name").distinct().join(known, F.col("_name") == F.col("name"), "left_anti").withColumn("key", _folder_key(F.col("_name")))
    taken = known.select(F.col("file_key").alias("key")).distinct()
    first = fresh.join(taken, "key", "left_anti").groupBy("key").agg(F.min("_name").alias("_first"))
    own = F.col("_name").eqNullSafe(F.col("_first"))
    other = F.concat("key", F.lit("~"), F.substring(F.sha2("_name", 256), 1, 16))
    fresh = fresh.join(first, "key", "left").select(F.col("_name").alias("name"), F.when(own, F.col("key")).otherwise(other).alias("file_key"))
    fresh.write.mode("append").parquet(f"{path}/keys")
    keys = export_keys(spark, path).withColumnRenamed("name", "_name")
    rows = named.join(keys, "_name").drop("_name").hint("rebalance", F.col("file_key"))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", max_rows)
    writer.partitionBy("file_key").parquet(f"{path}/data")
    return read_export(df, path)


def read_export(like: DataFrame, path: str) -> DataFrame:
    """The exported rows, with the columns of ``like`` and ``file_key``."""
    schema = like.schema.add("file_key", "string")
    return like.sparkSession.read.schema(schema).parquet(f"{path.rstrip('/')}/data")
