"""Reports built on the small helpers of the reference.

The helpers format one value; here each one is re-aimed at a whole table:
a data-quality audit, batch numbering, a corpus size report and an
active-time report.  All aggregates are algebraic (count, sum, min, max), so
Spark combines them map-side and a hot key costs one row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.functions import urls as U
from folio.functions.text import WS, human_duration, human_size, is_email
from folio.operators.common import computed
from folio.operators.numbering import group_row_number


def email_audit(docs: DataFrame, group: str = "source", text: str = "text") -> DataFrame:
    """Whitespace-separated tokens holding '@', valid vs invalid per group.

    Tokens are counted inside their row, so nothing is exploded and a group
    without candidates has a row of zeros.
    """
    found = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(rf"[^{WS}]*@[^{WS}]*"), 0)
    rows = computed(docs.select(group, text), _found=found)
    counted = rows.select(group, F.size("_found").alias("_n"), F.size(F.filter("_found", is_email)).alias("_ok"))
    return counted.groupBy(group).agg(
        F.sum("_n").alias("candidates"),
        F.sum("_ok").alias("valid"),
        F.sum(F.col("_n") - F.col("_ok")).alias("invalid"),
    )


def batch_assign(df: DataFrame, group: str, order: str, size: int) -> DataFrame:
    """Consecutive batches of ``size`` rows inside each group, in ``order``.

    Uses :func:`group_row_number`, so a dominant group is spread over many
    tasks instead of one window partition.
    """
    numbered = group_row_number(df, group, order, out="_rn")
    return numbered.withColumn("batch_no", F.floor((F.col("_rn") - 1) / F.lit(size)).cast("int")).withColumn(
        "batch_pos", ((F.col("_rn") - 1) % F.lit(size)).cast("int")
    ).drop("_rn")


def size_report(pages: DataFrame) -> DataFrame:
    """Pages and UTF-8 bytes per domain, with a human-readable size."""
    return (
        pages.select(U.netloc(F.col("url")).alias("domain"), F.octet_length("html").alias("_bytes"))
        .groupBy("domain")
        .agg(F.count(F.lit(1)).cast("bigint").alias("pages"), F.sum("_bytes").cast("bigint").alias("bytes"))
        .withColumn("size", human_size(F.col("bytes")))
    )


def duration_report(events: DataFrame, key: str = "user_id", ts: str = "ts") -> DataFrame:
    """First-to-last activity span per key, in seconds and human-readable."""
    span = (
        events.groupBy(key)
        .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count(F.lit(1)).cast("bigint").alias("events"))
        .withColumn("_us", F.expr("timestampdiff(MICROSECOND, _first, _last)"))
        .withColumn("seconds", F.col("_us").cast("double") / F.lit(1e6))
    )
    return span.select(key, "events", "seconds", human_duration(F.col("seconds")).alias("active"))
