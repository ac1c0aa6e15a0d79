"""Helpers shared by the training-text operators."""

from __future__ import annotations

import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.session import ensure_checkpoint_dir

#: The characters between words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\f\r"
BLANK_CLASS = r"[\x20\x09-\x0D]"


def ship(module: str) -> None:
    """Send the task code of ``module`` by value, so executors need not have the package."""
    cloudpickle.register_pickle_by_value(__import__(module, fromlist=["_"]))


#: Bounds of an Arrow batch: with long texts, 10,000 rows (Spark's default) take hundreds of MB of a Python worker.
BATCH_ROWS = 1000
BATCH_BYTES = "8m"


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session whose Arrow batches are at most of the bounds above.

    This lowers two settings of the session, and never raises the first.
    """
    conf = df.sparkSession.conf
    if not 0 < int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df


def shared_path(df: DataFrame, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(df.sparkSession)}/folio-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    This cuts the lineage at a place that survives lost executors, and the
    planner knows the size of what it reads, so a broadcast is chosen by
    size and never forced.
    """
    path = shared_path(df, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text: longest runs without a blank; none for a null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK_CLASS + "+"), lambda w: w != "")


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have (in any case)."""
    have = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in have:
            name = "_" + name
        have.add(name.lower())
        out.append(name)
    return out
