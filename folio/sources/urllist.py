"""A1 source: URL list files (one URL per line, comments and blanks allowed).

``spark.read.text`` reads the lines.  ``pos`` numbers them over all files, by
file and then by place in the file, so that a run can report its results in
input order (A17).  No line is shuffled for that: each split of a file counts
its own lines, the counts (one row per split) are added up in order, and a line
adds its place within its split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.operators.pages import url_list_scan


def read_url_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(source_file, line_no, pos, value)``: ``line_no`` counts within the file, ``pos`` over all files in order of their paths; both from 0."""
    # a task reads the splits dealt to it one after another, and its ids follow its rows
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"), "value")
    splits = lines.groupBy("source_file", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    files = splits.groupBy("source_file").agg(F.sum("_n").alias("_lines"))
    before = Window.orderBy("source_file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("source_file", F.coalesce(F.sum("_lines").over(before), F.lit(0)).alias("_files"))
    before = Window.partitionBy("source_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("source_file", "_start", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_splits"))
    at = F.col("_splits") + F.col("_id") - F.col("_first")
    numbered = lines.join(splits.join(files, "source_file"), ["source_file", "_start"])
    return numbered.select("source_file", at.alias("line_no"), (F.col("_files") + at).alias("pos"), "value")


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """``(line_no, url)``: lines that start with ``http`` and are valid URLs once stripped."""
    return url_list_scan(read_url_lines(spark, path))


def read_url_run(spark: SparkSession, path: str) -> DataFrame:
    """``(pos, url)`` of the valid lines of all files, numbered in input order."""
    return url_list_scan(read_url_lines(spark, path), line_no="pos")
