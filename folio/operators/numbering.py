"""Row numbers inside groups that stay balanced when one group is huge.

``row_number() OVER (PARTITION BY g ORDER BY o)`` sends a whole group to one
task.  Here the rows are range-partitioned on ``(g, o)`` instead, so a group
holding a third of all rows is split over many partitions.  Each partition
numbers its rows locally (its rows are sorted, so one streaming pass with
pandas' ``cumcount`` per batch carry-over), and a group that continues from
earlier partitions gets the count of its rows there added as an offset.

Only the first group of a partition can continue from an earlier partition,
so the offset table has at most one row per partition; the planner may
broadcast it by its size.
"""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark import cloudpickle

from folio.session import work_dir

# executors need not have this package installed: ship its task code by value
cloudpickle.register_pickle_by_value(__import__(__name__, fromlist=["_"]))


def _local_numbers(group_col: str):
    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last_group = None
        carried = 0
        for pdf in batches:
            if pdf.empty:
                yield pdf.assign(_local_rn=pd.Series([], dtype="int64"))
                continue
            rn = pdf.groupby(group_col, sort=False, dropna=False).cumcount().astype("int64") + 1
            if last_group is not None:
                same = pdf[group_col] == last_group
                rn = rn.where(~same, rn + carried)
            last_group = pdf[group_col].iloc[-1]
            carried = int(rn.iloc[-1])
            yield pdf.assign(_local_rn=rn)
    return fn


def group_row_number(df: DataFrame, group_col: str, order_col: str, out: str = "rn",
                     num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based position of each row inside its group by ``order_col``.

    ``(group_col, order_col)`` must be unique (ties would make numbers
    arbitrary, exactly as with ``row_number``).
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        df.repartitionByRange(n, F.col(group_col), F.col(order_col))
        .sortWithinPartitions(group_col, order_col)
        .withColumn("_pid", F.spark_partition_id())
    )
    schema = T.StructType(ranged.schema.fields + [T.StructField("_local_rn", T.LongType())])
    # Written once: numbers and offsets must come from one and the same cut into
    # partitions, and range partitioning cuts anew (by a sample) in every plan.
    path = work_dir(spark, "row-numbers")
    ranged.mapInPandas(_local_numbers(group_col), schema).write.parquet(path)
    local = spark.read.schema(schema).parquet(path)
    # rows of each (partition, group); only groups seen in earlier partitions need an offset
    per_part = local.groupBy("_pid", group_col).agg(F.max("_local_rn").alias("_n"))
    w = Window.partitionBy(group_col).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        per_part.withColumn("_offset", F.coalesce(F.sum("_n").over(w), F.lit(0)))
        .where(F.col("_offset") > 0)
        .select("_pid", group_col, "_offset")
    )
    return (
        local.join(offsets, ["_pid", group_col], "left")
        .withColumn(out, (F.col("_local_rn") + F.coalesce(F.col("_offset"), F.lit(0))).cast("int"))
        .drop("_pid", "_local_rn", "_offset")
    )
